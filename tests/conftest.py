import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, app="tidemark-tests")
    # Tests run where no shared checkpoint folder is configured: take a
    # private one only when the session has none.
    from tidemark.session import checkpoint_root
    if not checkpoint_root(s) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield s


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


SNAPSHOT_SCHEMA = ("customer_id string, name string, email string, company string, "
                   "plan_id string, region string, segment string, signup_date date, "
                   "snapshot_date date")


def snapshots(spark, rows):
    """rows: (customer_id, day, plan, region, segment[, email])"""
    full = []
    for r in rows:
        cid, day, plan, region, segment = r[:5]
        email = r[5] if len(r) > 5 else f"{cid}@example.com"
        full.append((cid, f"name {cid}", email, "Co", plan, region, segment,
                     d("2026-01-01"), d(day)))
    return spark.createDataFrame(full, SNAPSHOT_SCHEMA)


def plan_text(df) -> str:
    """The physical plan as `explain()` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
