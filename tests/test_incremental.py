"""The dimension merged day by day against the full rebuild, and the sweep in slices
against the sweep of whole keys."""
import random
import tempfile

import pytest
from conftest import d, snapshots
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.scd import WIDE, close_ranges, snapshot_versions
from tidemark.plans import marts
from tidemark.plans.incremental import IncrementalDimension


def full(df):
    return marts.int_customer_scd(marts.int_customer_history(df, keep_helpers=True))


def rows_of(df):
    return sorted(map(repr, df.collect()))


def histories(seed, days=6):
    """A -> B -> A, NULL attributes, NULL ids, missing days, keys that come and go,
    copies, carried changes."""
    rng, rows = random.Random(seed), []
    for cid in ["a", "b", "c", "e", None, None]:
        for n in range(1, days + 1):
            if rng.random() < 0.3:
                continue
            row = (cid, f"2026-03-{n:02d}", rng.choice(["p", "q", None]), rng.choice(["eu", "us"]),
                   rng.choice(["SMB", None]), rng.choice(["x@e", "y@e"]) if rng.random() < 0.5 else "x@e")
            rows += [row] * rng.choice([1, 1, 2])
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_day_by_day_is_the_full_rebuild(spark, seed):
    rows = histories(seed)
    kept = IncrementalDimension(spark, tempfile.mkdtemp(prefix="tidemark-inc-"), wide_rows=None)
    order = [1, 2, 4, 3, 6, 5] if seed else [1, 2, 3, 4, 5, 6]    # some days come late
    given = []
    for n in order:
        new = [r for r in rows if r[1] == f"2026-03-{n:02d}"]
        if not new:
            continue
        given += new
        kept.advance(snapshots(spark, new), snapshots(spark, given))
    whole = snapshots(spark, given)
    history = snapshot_versions(whole, "customer_id", marts.CUSTOMER_TRACKED, marts.CUSTOMER_CARRIED,
                                keep_helpers=True).drop(WIDE)
    assert rows_of(kept.islands().select(*sorted(history.columns))) == rows_of(
        history.select(*sorted(history.columns)))
    assert rows_of(kept.dimension()) == rows_of(full(whole))


def test_days_together_and_a_broken_step(spark):
    rows = histories(11)
    kept = IncrementalDimension(spark, tempfile.mkdtemp(prefix="tidemark-inc-"), wide_rows=None)
    first, second = ([r for r in rows if (r[1] <= "2026-03-03") == early] for early in (True, False))
    kept.advance(snapshots(spark, first), snapshots(spark, first))
    before = rows_of(kept.dimension())
    broken = snapshots(spark, second).withColumn("region", F.raise_error(F.lit("half a file")).cast("string"))
    with pytest.raises(Exception, match="half a file"):
        kept.advance(broken, snapshots(spark, rows))
    assert rows_of(kept.dimension()) == before == rows_of(full(snapshots(spark, first)))
    kept.advance(snapshots(spark, second), snapshots(spark, rows))
    assert rows_of(kept.dimension()) == rows_of(full(snapshots(spark, rows)))


def test_a_step_does_not_read_the_history(spark):
    folder = tempfile.mkdtemp(prefix="tidemark-inc-")
    kept = IncrementalDimension(spark, folder, wide_rows=None)
    for n in (1, 2, 3):
        day = snapshots(spark, [("a", f"2026-03-0{n}", f"p{n}", "eu", "SMB")])
        kept.advance(day, spark.range(1).select(F.raise_error(F.lit("read")).alias("customer_id")))
    got = [(r.version_id, r.valid_from, r.valid_to) for r in kept.dimension().orderBy("version_id").collect()]
    assert got == [(1, d("2026-03-01"), d("2026-03-01")), (2, d("2026-03-02"), d("2026-03-02")),
                   (3, d("2026-03-03"), None)]


@pytest.mark.parametrize("seed", range(3))
def test_sweep_in_slices_is_the_sweep(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), rng.randint(1, 12), f"2026-01-{rng.randint(1, 12):02d}",
             rng.choice([None] + [f"2026-01-{k:02d}" for k in range(1, 20)])) for _ in range(rng.choice([8, 25, 60]))]
    dim = spark.createDataFrame(rows, "customer_id string, version_id int, f string, t string").select(
        "customer_id", "version_id", F.col("f").cast("date").alias("valid_from"), F.col("t").cast("date").alias("valid_to"))
    whole = quality.assert_no_scd_overlap(dim, wide_rows=None)
    assert rows_of(quality.assert_no_scd_overlap(dim, wide_rows=0)) == rows_of(whole)
    assert rows_of(quality.assert_no_scd_overlap(dim, wide_rows=30)) == rows_of(whole)


def test_a_hot_key_is_many_tasks(spark):
    """Sorted windows hold a day of the key, or one row per day."""
    from conftest import plan_text
    dim = spark.range(4000).selectExpr("'hot' AS customer_id", "id AS version_id",
                                       "date_add(date'2026-01-01', cast(id % 400 as int)) AS valid_from",
                                       "date_add(date'2026-01-01', cast(id % 400 as int)) AS valid_to")
    out = quality.assert_no_scd_overlap(dim, wide_rows=100)
    assert out.count() == 3600
    plan = plan_text(out)
    assert "_slice" in plan and "Window" in plan


def test_orphans_are_counted_by_key_first(spark):
    from conftest import plan_text
    child = spark.createDataFrame([("a",)] * 50 + [("x",)] * 30 + [(None,)] * 5 + [("y",)], "k string")
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    found = quality.expect_relationships(child, "k", parent, "k", "m")
    assert tuple(found.first())[3:] == (31, 31)
    assert "partial_count" in plan_text(found)
    assert quality.expect_relationships(child.limit(0), "k", parent, "k", "m").first().failures == 0
