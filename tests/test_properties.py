"""Property tests: the Spark operators against a plain-Python brute force
of the same SQL semantics, on random small histories."""
import datetime as dt

from conftest import SNAPSHOT_SCHEMA
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.temporal import temporal_join
from tidemark.plans import marts, staging

BASE = dt.date(2026, 1, 1)
ATTR = st.sampled_from(["A", "B", None])


@st.composite
def histories(draw):
    """Per customer: a sorted set of distinct snapshot days (gaps allowed,
    spread over several months) with tracked attributes."""
    rows = []
    for cid in ("C1", "C2", "C3")[: draw(st.integers(1, 3))]:
        days = sorted(draw(st.sets(st.integers(0, 150), min_size=1, max_size=8)))
        for day in days:
            rows.append((cid, BASE + dt.timedelta(days=day),
                         draw(st.sampled_from(["P1", "P2", None])), draw(ATTR), draw(ATTR)))
    return rows


def _ne(a, b):
    """SQL `a != b`: None when either side is NULL."""
    return None if a is None or b is None else a != b


def brute_scd(rows):
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    out = []
    for cid, rs in by_key.items():
        rs.sort(key=lambda r: r[1])
        version, groups, prev = 0, {}, None
        for r in rs:
            if prev is None or prev[2] is None:
                flag = 1
            else:
                flag = 1 if any(_ne(r[i], prev[i]) is True for i in (2, 3, 4)) else 0
            version += flag
            g = groups.setdefault((r[2], r[3], r[4], version), [r[1], r[1]])
            g[0], g[1] = min(g[0], r[1]), max(g[1], r[1])
            prev = r
        hist = sorted(((v, f, a) for a, (f, _l) in groups.items() for v in [a[3]]),
                      key=lambda x: (x[0], x[1]))
        for i, (v, f, a) in enumerate(hist):
            nxt = hist[i + 1][1] if i + 1 < len(hist) else None
            out.append((cid, a[0], a[1], a[2], v, f,
                        None if nxt is None else nxt - dt.timedelta(days=1), nxt is None))
    return sorted(out, key=repr)


def to_df(spark, rows):
    full = [(cid, "n", "e", "co", p, r, s, BASE, day) for cid, day, p, r, s in rows]
    return spark.createDataFrame(full, SNAPSHOT_SCHEMA)


SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


@SETTINGS
@given(rows=histories())
def test_scd_matches_brute_force(spark, rows):
    scd = marts.int_customer_scd(marts.int_customer_history(to_df(spark, rows)))
    got = sorted(((r.customer_id, r.plan_id, r.region, r.segment, r.version_id, r.valid_from,
                   r.valid_to, r.is_current) for r in scd.collect()), key=repr)
    assert got == brute_scd(rows)


@st.composite
def facts(draw):
    n = draw(st.integers(1, 25))
    out = []
    for i in range(n):
        cid = draw(st.sampled_from(["C1", "C2", "C3", "C9", None]))
        day = draw(st.one_of(st.none(), st.integers(-20, 260)))
        out.append((f"I{i}", cid, "P", None if day is None else BASE + dt.timedelta(days=day),
                    "1", "paid"))
    return out


@SETTINGS
@given(rows=histories(), invoices=facts())
def test_temporal_join_matches_brute_force(spark, rows, invoices):
    scd = marts.int_customer_scd(marts.int_customer_history(to_df(spark, rows)))
    inv = staging.stg_invoices(spark.createDataFrame(
        invoices, "invoice_id string, customer_id string, plan_id string, invoice_date date, "
                  "amount string, status string"))
    versions = [(r.customer_id, r.customer_key, r.valid_from, r.valid_to) for r in scd.collect()]
    expected = []
    for iid, cid, _p, d, _a, _s in invoices:
        hits = [k for c, k, f, t in versions
                if cid is not None and d is not None and c == cid and f <= d and (t is None or d <= t)]
        expected += [(iid, k) for k in hits] or [(iid, None)]
    for exclusive in (True, False):
        got = temporal_join(inv, scd, "customer_id", "invoice_date", ["customer_key"],
                            exclusive=exclusive).collect()
        assert sorted(((r.invoice_id, r.customer_key) for r in got), key=repr) == \
            sorted(expected, key=repr)
