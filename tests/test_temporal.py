"""Temporal join, quarantine classification, and the join forms agreeing."""
import re

from conftest import SF_CHECK, d, plan_text, snapshots

from tidemark.operators.temporal import temporal_join
from tidemark.plans import marts, staging
from tidemark.plans.pipeline import Warehouse

INV = "invoice_id string, customer_id string, plan_id string, invoice_date date, amount string, status string"


def dim(spark):
    rows = [("C1", "2026-08-01", "A", "EU", "SMB"), ("C1", "2026-08-02", "A", "EU", "SMB"),
            ("C1", "2026-08-05", "B", "EU", "SMB"), ("C1", "2026-08-06", "B", "EU", "SMB")]
    return marts.int_customer_scd(marts.int_customer_history(snapshots(spark, rows)))


def invoices(spark, rows):
    return staging.stg_invoices(spark.createDataFrame(rows, INV))


def test_boundaries_resolve_to_own_then_next_version(spark):
    # version 1: 08-01 .. 08-04, version 2: 08-05 .. open
    inv = invoices(spark, [("I1", "C1", "P", d("2026-08-01"), "1", "paid"),
                           ("I2", "C1", "P", d("2026-08-04"), "1", "paid"),
                           ("I3", "C1", "P", d("2026-08-05"), "1", "paid"),
                           ("I4", "C1", "P", d("2027-03-09"), "1", "paid")])
    out = {r.invoice_id: r.customer_key for r in marts.int_invoice_resolved(inv, dim(spark)).collect()}
    assert out == {"I1": "C1-1", "I2": "C1-1", "I3": "C1-2", "I4": "C1-2"}


def test_unresolved_reasons(spark):
    inv = invoices(spark, [("I1", "C1", "P", d("2026-07-31"), "1", "paid"),
                           ("I2", "C9", "P", d("2026-08-03"), "1", "paid"),
                           ("I3", None, "P", d("2026-08-03"), "1", "paid"),
                           ("I4", "C1", "P", None, "1", "paid")])
    resolved = marts.int_invoice_resolved(inv, dim(spark))
    assert marts.fact_invoice(resolved).count() == 0
    rej = {r.invoice_id: r.rejection_reason
           for r in marts.fact_invoice_rejected(resolved, dim(spark)).collect()}
    assert rej == {"I1": "invoice_predates_scd_coverage", "I2": "orphan_customer_id",
                   "I3": "orphan_customer_id", "I4": "invoice_predates_scd_coverage"}


def test_long_history_spanning_months(spark):
    rows = [("C1", f"2026-{m:02d}-{day:02d}", "A" if m % 2 else "B", "EU", "SMB")
            for m in range(1, 7) for day in (3, 20)]
    scd = marts.int_customer_scd(marts.int_customer_history(snapshots(spark, rows)))
    inv = invoices(spark, [(f"I{m}-{day}", "C1", "P", d(f"2026-{m:02d}-{day:02d}"), "1", "paid")
                           for m in range(1, 10) for day in (1, 2, 15, 28)])
    a = temporal_join(inv, scd, "customer_id", "invoice_date", ["customer_key"])
    b = temporal_join(inv, scd, "customer_id", "invoice_date", ["customer_key"], exclusive=False)
    ka = sorted((r.invoice_id, r.customer_key) for r in a.collect())
    kb = sorted((r.invoice_id, r.customer_key) for r in b.collect())
    assert ka == kb
    assert len(ka) == 36 and dict(ka)["I1-1"] is None


def test_join_forms_agree_on_driver_tables(spark):
    wh = Warehouse.from_testdata(spark, SF_CHECK)
    inv, scd = wh.stg_invoices, wh.int_customer_scd
    key = ["invoice_id", "customer_key"]
    a = temporal_join(inv, scd, "customer_id", "invoice_date", ["customer_key"]).select(key)
    b = temporal_join(inv, scd, "customer_id", "invoice_date", ["customer_key"],
                      exclusive=False).select(key)
    assert a.count() == b.count() == 15000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_range_join_is_an_equi_join_not_a_nested_loop(spark):
    wh = Warehouse.from_testdata(spark, SF_CHECK)
    plan = plan_text(wh.int_invoice_resolved)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Generate" not in plan.split("Exchange hashpartitioning(customer_id")[0]


def partitioned_by(plan):
    """The column names inside every hashpartitioning(...) of a plan."""
    return [re.sub(r"#\d+L?", "", x).split(", ")[:-1]
            for x in re.findall(r"hashpartitioning\(([^()]*)\)", plan)]


def test_facts_meet_the_dimension_by_key_and_day_and_null_rows_stay_out(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(f"N{i}", None, "P", d("2026-08-03"), "1", "paid") for i in range(5000)]
        rows += [(f"D{i}", "C1", "P", None, "1", "paid") for i in range(5000)]
        rows += [("I1", "C1", "P", d("2026-08-02"), "1", "paid")]
        inv = spark.createDataFrame(rows, INV)
        joined = temporal_join(inv, dim(spark), "customer_id", "invoice_date", ["customer_key"])
        plan = plan_text(joined)
        keys = partitioned_by(plan)
        assert ["customer_id", "invoice_date"] in keys
        assert ["customer_id"] not in [k for k in keys if "invoice_id" in k]
        # what is joined has a key and a date; the other rows are united with it
        below = plan[plan.index("SortMergeJoin"):]
        assert "isnotnull(customer_id" in below and "isnotnull(invoice_date" in below
        assert plan.index("Union") < plan.index("SortMergeJoin")
        out = joined.collect()
        assert len(out) == 10001
        assert [(r.invoice_id, r.customer_key) for r in out if r.customer_key] == [("I1", "C1-1")]
        assert temporal_join(inv, dim(spark), "customer_id", "invoice_date", ["customer_key"],
                             how="inner").count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_long_open_version_is_not_expanded(spark):
    from pyspark.sql import functions as F
    versions = spark.range(3000).select(
        F.col("id").cast("string").alias("customer_id"), F.lit("k").alias("customer_key"),
        F.lit(d("2016-01-01")).alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    inv = invoices(spark, [("I1", "7", "P", d("2026-08-02"), "1", "paid")])
    joined = temporal_join(inv, versions, "customer_id", "invoice_date", ["customer_key"])
    assert "explode" not in plan_text(joined) and joined.first().customer_key == "k"
