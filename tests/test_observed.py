"""Counts that writing jobs observe, and reports from one resolution, against the
separate queries."""
import tempfile

from conftest import SF_SMALL, plan_text
from pyspark.sql import functions as F

from tidemark import catalog
from tidemark.operators import quality
from tidemark.operators.temporal import classify_unresolved, temporal_join
from tidemark.plans import checks, marts, reports
from tidemark.plans.pipeline import Warehouse, run
from tidemark.sources import testviews


def test_observed_results_are_those_of_the_queries(spark):
    out = tempfile.mkdtemp(prefix="tidemark-observed-")
    paths = run(spark, testviews.load_sources(spark, SF_SMALL), out, gate=False)
    assert not any("_checks_by_model" in p for p in paths)
    got = sorted(map(tuple, spark.read.parquet(paths["_checks"]).collect()))
    want = sorted(map(tuple, checks.all_checks(Warehouse.from_testdata(spark, SF_SMALL)).select(
        "check_name", "model", "column_name", "failures", "failing_rows", "passed").collect()))
    assert got == want and len(got) == 32 and sum(not r[-1] for r in got) == 2
    rec = spark.read.parquet(paths["_reconciliation"]).collect()
    assert rec == catalog.QUERIES["invoice_reconciliation"](spark, SF_SMALL).collect()
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    assert rec == reports.invoice_reconciliation(wh.sources["invoices"], wh.stg_invoices, wh.fact_invoice,
                                                 wh.fact_invoice_rejected).collect()
    summary = spark.read.parquet(paths["_load_summary"])
    assert sorted(summary.collect()) == sorted(catalog.QUERIES["load_summary"](spark, SF_SMALL).collect())


def test_a_run_over_empty_sources(spark):
    empty = {n: df.limit(0) for n, df in testviews.load_sources(spark, SF_SMALL).items()}
    paths = run(spark, empty, tempfile.mkdtemp(prefix="tidemark-empty-"),
                calendar=("2024-01-01", "2024-01-02"))
    rec = spark.read.parquet(paths["_reconciliation"]).first()
    assert tuple(rec)[:8] == (0,) * 8 and rec.balanced
    assert spark.read.parquet(paths["_checks"]).where("not passed").count() == 0


def test_rates_are_those_of_the_marts(spark):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    assert quality.resolved_quarantine_rate(wh.int_invoice_resolved).collect() == \
        quality.quarantine_rate_report(wh.fact_invoice, wh.fact_invoice_rejected).collect()
    assert catalog.QUERIES["dq_health_report"](spark, SF_SMALL).collect() == quality.health_report(
        wh.sources["crm_customers"], wh.fact_invoice, wh.fact_invoice_rejected).collect()


def test_one_version_chain_in_each_report(spark):
    for name in ("dq_quarantine_rate", "dq_health_report", "invoice_reconciliation"):
        plan = plan_text(catalog.QUERIES[name](spark, SF_SMALL))
        assert plan.count("Window [lag(") == 1, name


def test_known_keys_come_with_the_join(spark):
    dim = spark.createDataFrame(
        [("a", "2024-01-05", "2024-01-09", 1), ("a", "2024-01-10", None, 2), ("b", None, None, 3)],
        "id string, valid_from string, valid_to string, v int").select(
        "id", F.col("valid_from").cast("date"), F.col("valid_to").cast("date"), "v")
    facts = spark.createDataFrame(
        [(n, i, d) for n, (i, d) in enumerate([("a", "2024-01-07"), ("a", "2024-01-01"), ("a", None), ("b", "2024-01-07"),
                                               ("c", "2024-01-07"), (None, "2024-01-07"), (None, None), ("a", "2024-02-01"),
                                               ("a", "2024-01-01")])],
        "n int, id string, day string").select("n", "id", F.col("day").cast("date"))
    got = {r.n: (r.v, r.k) for r in temporal_join(facts, dim, "id", "day", ["v"], known="k").collect()}
    assert got == {0: (1, True), 1: (None, True), 2: (None, True), 3: (None, True), 4: (None, False),
                   5: (None, False), 6: (None, False), 7: (2, True), 8: (None, True)}
    plain = temporal_join(facts, dim, "id", "day", ["v"])
    reasons = {r.n: r.rejection_reason for r in classify_unresolved(
        plain.where("v is null").drop("v"), dim, "id").collect()}
    assert {n: r == "invoice_predates_scd_coverage" for n, r in reasons.items()} == \
        {n: k for n, (v, k) in got.items() if v is None}


def test_routes_are_the_two_marts(spark):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    routes = marts.invoice_routes(wh.stg_invoices, wh.int_customer_scd)
    assert routes.count() == wh.stg_invoices.count()
    facts = {tuple(r) for r in wh.fact_invoice.select("invoice_id", "customer_key").collect()}
    assert {tuple(r) for r in routes.where("route is null").select("invoice_id", "customer_key").collect()} == facts
    rejected = {tuple(r) for r in wh.fact_invoice_rejected.select("invoice_id", "rejection_reason").collect()}
    assert {tuple(r) for r in routes.where("route is not null").select("invoice_id", "route").collect()} == rejected
