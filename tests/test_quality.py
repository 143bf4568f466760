"""Health checks (the reference's seven cases) and expectations."""
import math

from conftest import d, snapshots

from tidemark.operators import quality
from tidemark.plans import marts

COUNTS = "snapshot_date string, row_count bigint"


def zscore(spark, counts, threshold=2.0):
    df = spark.createDataFrame(sorted(counts.items()), COUNTS)
    scored = quality.volume_zscore(df, "snapshot_date", threshold)
    return scored, quality.volume_summary(scored).collect()[0]


def days(n=14, value=500):
    return {f"2026-08-{i:02d}": value for i in range(1, n + 1)}


def test_stable_days_no_anomaly(spark):
    _, s = zscore(spark, days())
    assert s.volume_status == "ok" and s.n_anomalies == 0
    assert (s.n_days_checked, s.mean_count, s.std_count) == (14, 500.0, 0.0)


def test_dropped_day_is_flagged(spark):
    c = days(); c["2026-08-07"] = 50
    scored, s = zscore(spark, c)
    assert s.volume_status == "alert"
    flagged = [r.snapshot_date for r in scored.where("is_anomaly").collect()]
    assert "2026-08-07" in flagged


def test_leave_one_out_does_not_mask_the_anomaly(spark):
    c = days(); c["2026-08-07"] = 0
    scored, _ = zscore(spark, c)
    z = scored.where("snapshot_date = '2026-08-07'").collect()[0].z_score
    assert abs(z) > 5 and z == -999.0


def test_threshold_is_configurable(spark):
    # mean 200, variance 14; the last day is 2.7 deviations below
    base = [194, 206, 197, 203, 200, 196, 204, 199, 201, 195, 205, 202, 198]
    c = {f"2026-08-{i:02d}": v for i, v in zip(range(1, 14), base)}
    c["2026-08-14"] = 190
    assert zscore(spark, c, 1.0)[1].volume_status == "alert"
    assert zscore(spark, c, 5.0)[1].volume_status == "ok"
    # agrees with the population std of the other days
    scored, _ = zscore(spark, c)
    z = scored.where("snapshot_date = '2026-08-14'").collect()[0].z_score
    others = base
    mean = sum(others) / len(others)
    std = math.sqrt(sum((v - mean) ** 2 for v in others) / len(others))
    assert abs(z - (190 - mean) / std) < 1e-12


def test_one_day_only_has_no_baseline(spark):
    scored, s = zscore(spark, {"2026-08-01": 500})
    r = scored.collect()[0]
    assert r.z_score is None and not r.is_anomaly and s.volume_status == "ok"


def test_no_days(spark):
    df = spark.createDataFrame([], COUNTS)
    s = quality.volume_summary(quality.volume_zscore(df)).collect()[0]
    assert (s.n_days_checked, s.mean_count, s.std_count, s.volume_status) == (0, 0.0, 0.0, "ok")


def rate(spark, total, q, threshold=0.05):
    from pyspark.sql import functions as F
    return spark.range(1).select(*quality.quarantine_rate(F.lit(total), F.lit(q), threshold)).collect()[0]


def test_quarantine_rate_ok_warn_zero(spark):
    r = rate(spark, 1000, 20)
    assert r.rate_status == "ok" and r.quarantine_rate == 0.02
    r = rate(spark, 1000, 80)
    assert r.rate_status == "warn" and r.quarantine_rate == 0.08
    r = rate(spark, 0, 0)
    assert r.rate_status == "ok" and r.quarantine_rate == 0.0
    assert rate(spark, 32, 1).quarantine_rate == 0.0313   # 0.03125 half-up


def test_overlap_check_reports_one_pair(spark):
    dim = spark.createDataFrame(
        [("C1", 1, d("2026-08-01"), d("2026-08-10")), ("C1", 2, d("2026-08-05"), None),
         ("C2", 1, d("2026-08-01"), d("2026-08-04")), ("C2", 2, d("2026-08-05"), None)],
        "customer_id string, version_id bigint, valid_from date, valid_to date")
    out = quality.assert_no_scd_overlap(dim).collect()
    assert len(out) == 1 and out[0].customer_id == "C1"
    assert (out[0].version_a, out[0].version_b) == (1, 2)


def test_relationships_ignore_null_child_keys(spark):
    child = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    assert quality.expect_relationships(child, "k", parent, "k", "m").collect()[0].failures == 0
    parent2 = spark.createDataFrame([("a",)], "k string")
    assert quality.expect_relationships(child, "k", parent2, "k", "m").collect()[0].failures == 1


def test_not_null_and_accepted_values(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("z", None), ("z", 3)], "s string, n int")
    nn = {r.column_name: r.failures for r in quality.expect_not_null(df, ["s", "n"], "m").collect()}
    assert nn == {"s": 1, "n": 1}
    av = quality.expect_accepted_values(df, "s", ["a"], "m").collect()[0]
    assert (av.failures, av.failing_rows) == (1, 2)


def test_unique_sees_failing_driver_data(spark):
    from conftest import SF_CHECK
    from tidemark.sources.testviews import table
    li = table(spark, SF_CHECK, "lineitem")
    r = quality.expect_unique(li, ["l_orderkey", "l_linenumber"], "lineitem").collect()[0]
    distinct = li.select("l_orderkey", "l_linenumber").distinct().count()
    assert distinct == 45832 and r.failures > 0
    assert r.failing_rows - r.failures == li.count() - distinct


def test_health_report_nested_shape(spark):
    rows = [("C1", f"2026-08-{i:02d}", "A", "EU", "SMB") for i in range(1, 6)]
    snaps = snapshots(spark, rows)
    dim = marts.int_customer_scd(marts.int_customer_history(snaps))
    empty = spark.createDataFrame([], "invoice_id string")
    rep = quality.health_report_nested(snaps, empty, empty).collect()[0].asDict(recursive=True)
    assert rep["crm_snapshot_volume"]["status"] == "ok"
    assert rep["crm_snapshot_volume"]["anomalies"] == []
    assert rep["invoice_quarantine_rate"]["quarantine_rate"] == 0.0
    assert rep["overall_status"] == "ok"
    assert dim.count() == 1


def test_calendar_filled_counts_expose_a_missing_day(spark):
    rows = [("C1", f"2026-08-{i:02d}", "A", "EU", "SMB") for i in range(1, 15) if i != 7]
    rows += [("C2", f"2026-08-{i:02d}", "A", "EU", "SMB") for i in range(1, 15) if i != 7]
    snaps = snapshots(spark, rows)
    plain = quality.volume_zscore(quality.daily_counts(snaps, "snapshot_date"))
    assert plain.count() == 13 and plain.where("is_anomaly").count() == 0
    filled = quality.volume_zscore(quality.daily_counts(snaps, "snapshot_date", fill_calendar=True))
    out = {r.snapshot_date: r for r in filled.collect()}
    assert len(out) == 14 and out[d("2026-08-07")].row_count == 0
    assert out[d("2026-08-07")].is_anomaly and out[d("2026-08-07")].z_score == -999.0


def overlap_rows(spark, rows):
    df = spark.createDataFrame(rows, "customer_id string, version_id long, valid_from date,"
                                     " valid_to date")
    return sorted((r.customer_id, r.version_a, r.version_b)
                  for r in quality.assert_no_scd_overlap(df).collect())


def test_every_overlapping_version_is_named(spark):
    rows = [("C", 1, d("2026-01-01"), d("2026-01-31")), ("C", 2, d("2026-01-05"), d("2026-01-06")),
            ("C", 3, d("2026-01-10"), d("2026-01-12"))]
    assert overlap_rows(spark, rows) == [("C", 1, 2), ("C", 1, 3)]


def test_rows_of_one_version_do_not_overlap(spark):
    rows = [("C", 1, d("2026-01-01"), d("2026-01-31")), ("C", 1, d("2026-01-05"), None)]
    assert overlap_rows(spark, rows) == []
    rows += [("C", 2, d("2026-01-20"), None)]
    assert overlap_rows(spark, rows) == [("C", 1, 2)]


def test_overlaps_are_those_of_all_pairs(spark):
    import random
    rng = random.Random(8)
    rows = []
    for key in range(120):
        for _ in range(rng.randint(1, 7)):
            start = rng.randint(1, 25)
            end = rng.choice([None, start + rng.randint(0, 6), start + rng.randint(0, 6)])
            rows.append((f"K{key}", rng.randint(1, 3), d(f"2026-01-{start:02d}"),
                         None if end is None else d(f"2026-01-{min(end, 31):02d}")))

    def end(r):
        return r[3] or d("9999-12-31")

    def order(r):
        return (r[2], r[1], end(r))

    want = {}
    for b in rows:
        hit = any(a[0] == b[0] and a[1] != b[1] and a[2] <= end(b) and b[2] <= end(a)
                  and order(a) < order(b) for a in rows)
        want[b[0]] = want.get(b[0], 0) + hit
    got = {}
    for key, _, _ in overlap_rows(spark, rows):
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in want.items() if n}
