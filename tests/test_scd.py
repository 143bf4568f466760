"""Snapshots -> SCD2 on literal rows (the edge cases of the build plan)."""
from conftest import d, plan_text, snapshots

from tidemark.operators import quality
from tidemark.plans import marts


def scd(spark, rows, null_safe=False):
    hist = marts.int_customer_history(snapshots(spark, rows), null_safe=null_safe)
    return marts.int_customer_scd(hist).orderBy("customer_id", "version_id", "valid_from").collect()


def test_no_change_is_one_open_current_version(spark):
    out = scd(spark, [("C1", f"2026-08-0{i}", "A", "EU", "SMB") for i in (1, 2, 3)])
    assert len(out) == 1
    v = out[0]
    assert (v.version_id, v.valid_from, v.valid_to, v.is_current) == (1, d("2026-08-01"), None, True)
    assert v.customer_key == "C1-1"


def test_a_b_a_gives_three_versions_closed_by_next_start(spark):
    out = scd(spark, [("C1", "2026-08-01", "A", "EU", "SMB"),
                      ("C1", "2026-08-02", "B", "EU", "SMB"),
                      ("C1", "2026-08-03", "A", "EU", "SMB")])
    assert [r.plan_id for r in out] == ["A", "B", "A"]
    assert [r.version_id for r in out] == [1, 2, 3]
    assert out[0].valid_to == d("2026-08-01") and out[1].valid_to == d("2026-08-02")
    assert out[2].valid_to is None and out[2].is_current
    assert [r.is_current for r in out] == [False, False, True]


def test_gap_is_bridged(spark):
    out = scd(spark, [("C1", "2026-08-01", "A", "EU", "SMB"),
                      ("C1", "2026-08-02", "A", "EU", "SMB"),
                      ("C1", "2026-08-05", "A", "EU", "SMB")])
    assert len(out) == 1 and out[0].valid_from == d("2026-08-01")
    hist = marts.int_customer_history(snapshots(spark, [
        ("C1", "2026-08-01", "A", "EU", "SMB"), ("C1", "2026-08-02", "A", "EU", "SMB"),
        ("C1", "2026-08-05", "A", "EU", "SMB")])).collect()
    assert hist[0].last_seen_date == d("2026-08-05")


def test_gap_with_change_closes_day_before_new_start(spark):
    out = scd(spark, [("C1", "2026-08-01", "A", "EU", "SMB"),
                      ("C1", "2026-08-02", "A", "EU", "SMB"),
                      ("C1", "2026-08-05", "B", "EU", "SMB")])
    assert out[0].plan_id == "A" and out[0].valid_to == d("2026-08-04")
    assert out[1].plan_id == "B" and out[1].valid_from == d("2026-08-05")


def test_customer_leaving_the_crm_stays_current(spark):
    rows = [("C1", f"2026-08-0{i}", "A", "EU", "SMB") for i in (1, 2, 3)]
    rows += [("C2", f"2026-08-{i:02d}", "A", "EU", "SMB") for i in range(1, 11)]
    out = [r for r in scd(spark, rows) if r.customer_id == "C1"]
    assert len(out) == 1 and out[0].is_current and out[0].valid_to is None


def test_tracked_null_reference_rule_and_null_safe(spark):
    rows = [("C1", "2026-08-01", "A", "X", "SMB"),
            ("C1", "2026-08-02", "A", None, "SMB"),
            ("C1", "2026-08-03", "A", None, "SMB")]
    out = scd(spark, rows)
    # reference rule: the change to NULL compares as unknown -> no new
    # version, but the NULL rows group apart: two rows share version 1
    assert len(out) == 2 and {r.version_id for r in out} == {1}
    safe = scd(spark, rows, null_safe=True)
    assert [r.version_id for r in safe] == [1, 2]
    assert [r.region for r in safe] == ["X", None]


def test_plan_null_opens_a_version_every_day(spark):
    rows = [("C1", f"2026-08-0{i}", None, "EU", "SMB") for i in (1, 2, 3)]
    out = scd(spark, rows)
    assert [r.version_id for r in out] == [1, 2, 3]
    assert len(scd(spark, rows, null_safe=True)) == 1


def test_untracked_change_splits_rows_with_same_key(spark):
    rows = [("C1", "2026-08-01", "A", "EU", "SMB", "old@x"),
            ("C1", "2026-08-02", "A", "EU", "SMB", "new@x")]
    hist = marts.int_customer_history(snapshots(spark, rows))
    dim = marts.int_customer_scd(hist)
    out = dim.collect()
    assert len(out) == 2 and {r.customer_key for r in out} == {"C1-1"}
    check = quality.expect_unique(dim, "customer_key", "dim_customer").collect()[0]
    assert check.failures == 1 and check.failing_rows == 2
    safe = marts.int_customer_scd(marts.int_customer_history(snapshots(spark, rows),
                                                             null_safe=True)).collect()
    assert len(safe) == 1 and safe[0].email == "new@x"


def test_one_exchange_serves_the_whole_window_chain(spark):
    from tidemark.operators.scd import IDENTITY, WIDE, close_ranges, snapshot_versions
    rows = [("C1", "2026-08-01", "A", "EU", "SMB"), ("C1", "2026-08-02", "B", "EU", "SMB")]
    snaps = snapshots(spark, rows)
    plain = close_ranges(snapshot_versions(snaps, "customer_id", ["plan_id", "region", "segment"],
                                           ["name"], collapse_copies=False, keep_helpers=True).drop(WIDE),
                         "customer_id", identity=IDENTITY)
    plan = plan_text(plain)
    assert plan.count("Exchange hashpartitioning") == 1, plan
    # with copies collapsed: one more exchange, after a map-side partial distinct
    plan = plan_text(marts.int_customer_scd(marts.int_customer_history(snaps, keep_helpers=True).drop(WIDE)))
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert "partial_" in plan or "HashAggregate" in plan


def test_null_key_rows_are_spread_and_grouped_by_record(spark):
    """Rows without a customer id: each record keeps its own history, and a
    large NULL group does not form one window partition."""
    rows = [("C1", f"2026-08-{i:02d}", "A", "EU", "SMB") for i in (1, 2, 3)]
    rows += [(None, f"2026-08-{i:02d}", "A", "EU", "SMB", f"p{j}@x") for i in (1, 2, 3)
             for j in range(40)]
    rows += [(None, "2026-08-04", "B", "EU", "SMB", "p0@x")]
    hist = marts.int_customer_history(snapshots(spark, rows), keep_helpers=True)
    plan = plan_text(marts.int_customer_scd(hist))
    assert "_record_identity" in plan.split("Exchange hashpartitioning", 1)[1].split("\n")[0]
    out = marts.int_customer_scd(hist).where("customer_id IS NULL").collect()
    assert len(out) == 41   # 40 records, one of which changed plan once
    p0 = sorted((r.valid_from, r.plan_id, r.valid_to) for r in out if r.email == "p0@x")
    assert p0 == [(d("2026-08-01"), "A", d("2026-08-03")), (d("2026-08-04"), "B", None)]
    assert all(r.customer_key is None for r in out)
    from tidemark.operators import quality
    assert quality.assert_no_scd_overlap(marts.int_customer_scd(hist)).count() == 0


def test_copies_do_not_change_versions(spark):
    rows = [("C1", "2026-08-01", "A", "EU", "SMB"), ("C1", "2026-08-02", "B", "EU", "SMB"),
            ("C1", "2026-08-03", "B", "EU", "SMB"), ("C2", "2026-08-01", "A", "EU", "SMB")]
    once = scd(spark, rows)
    many = scd(spark, rows * 50)
    assert [tuple(r) for r in once] == [tuple(r) for r in many]
    assert len(once) == 3


def test_many_records_without_id_have_one_version_each(spark):
    from pyspark.sql import functions as F
    days = spark.range(3).select(F.expr("date_add(date'2026-08-01', cast(id as int))").alias(
        "snapshot_date"))
    records = spark.range(5000).select(
        F.lit(None).cast("string").alias("customer_id"), F.concat(F.lit("n"), "id").alias("name"),
        F.concat(F.lit("e"), "id").alias("email"), F.lit("Co").alias("company"),
        F.lit("A").alias("plan_id"), F.lit("EU").alias("region"), F.lit("SMB").alias("segment"),
        F.lit(d("2026-01-01")).alias("signup_date"))
    snaps = records.join(F.broadcast(days))
    for partitions in (3, 16):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            for wide_rows in (None, 1000):
                scd = marts.int_customer_scd(marts.int_customer_history(
                    snaps, wide_rows=wide_rows, keep_helpers=True))
                assert scd.agg(F.count("*"), F.count_if("is_current"),
                               F.count_if(F.col("valid_to") < F.col("valid_from"))).first()[:] == (
                    5000, 5000, 0)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)


def placeholder_rows():
    import random
    rng = random.Random(4)
    rows = []
    for day in range(1, 9):
        rows += [("UNKNOWN", f"2026-08-{day:02d}", rng.choice(["A", "B", None]),
                  rng.choice(["EU", "US", None]), rng.choice(["SMB", "ENT"]),
                  f"r{rng.randint(0, 30)}@x") for _ in range(40 if day != 4 else 0)]
        rows += [(f"C{i}", f"2026-08-{day:02d}", "AB"[(i + day) // 3 % 2], "EU", "SMB")
                 for i in range(20)]
        rows += [(None, f"2026-08-{day:02d}", rng.choice("AB"), "EU", "SMB", "same@x")
                 for _ in range(9)]
    return rows


def test_wide_keys_in_two_levels_have_the_same_versions(spark):
    snaps = snapshots(spark, placeholder_rows())
    for null_safe in (False, True):
        def build(wide_rows):
            return marts.int_customer_scd(marts.int_customer_history(
                snaps, null_safe=null_safe, wide_rows=wide_rows, keep_helpers=True))
        plain, split = build(None).collect(), build(2).collect()
        assert sorted(map(repr, plain)) == sorted(map(repr, split))
        assert len(plain) > 200


def test_no_task_holds_a_wide_key(spark):
    """Rows of the placeholder id are numbered within its days: what is chained
    by the id alone is one row per day."""
    snaps = snapshots(spark, placeholder_rows())
    hist = marts.int_customer_history(snaps, wide_rows=10, keep_helpers=True)
    plan = plan_text(hist)
    rows_by_day = [x for x in plan.split("Exchange ") if x.startswith(
        "hashpartitioning(customer_id") and "snapshot_date" in x.split(")")[0]]
    assert rows_by_day, plan


def test_rows_of_one_day_follow_in_a_fixed_order(spark):
    rows = [("C1", "2026-08-01", p, "EU", "SMB") for p in "CAB"]
    one = marts.int_customer_scd(marts.int_customer_history(snapshots(spark, rows))).collect()
    two = marts.int_customer_scd(marts.int_customer_history(
        snapshots(spark, rows[::-1]).repartition(3))).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, two))
    assert [r.plan_id for r in sorted(one, key=lambda r: r.version_id)] == ["A", "B", "C"]
