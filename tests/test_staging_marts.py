"""Staging rules and mart edge cases on literal rows."""
import datetime as dt
from decimal import Decimal

from conftest import d, snapshots

from tidemark.plans import marts, staging

INV = "invoice_id string, customer_id string, plan_id string, invoice_date date, amount string, status string"
PLANS = "plan_id string, plan_name string, monthly_price string, tier string"
EVENTS = "event_id string, customer_id string, event_type string, event_timestamp string, feature_used string"


def test_amount_parsing_and_flags(spark):
    amounts = ["", "n/a", "-1", "0", "123456789.5", "12.345", None]
    rows = [(f"I{i}", "C1", "P", d("2026-08-01"), a, "paid") for i, a in enumerate(amounts)]
    out = {r.invoice_id: (r.amount, r.has_bad_amount)
           for r in staging.stg_invoices(spark.createDataFrame(rows, INV)).collect()}
    assert out["I0"] == (None, True)
    assert out["I1"] == (None, True)
    assert out["I2"] == (Decimal("-1.00"), True)
    assert out["I3"] == (Decimal("0.00"), False)
    assert out["I4"] == (None, True)           # overflows decimal(10,2)
    assert out["I5"] == (Decimal("12.35"), False)
    assert out["I6"] == (None, True)


def test_duplicates_that_differ_keep_the_total_order_survivor(spark):
    rows = [("I1", "C1", "P", d("2026-08-01"), "5.00", "paid"),
            ("I1", "C1", "P", d("2026-08-01"), "", "paid"),
            ("I2", "C2", "P", d("2026-08-01"), "7", "paid"),
            ("I2", "C1", "P", d("2026-08-03"), "9", "paid")]
    df = spark.createDataFrame(rows, INV)
    for _ in range(2):   # input order does not matter
        out = {r.invoice_id: r for r in staging.stg_invoices(df).collect()}
        assert out["I1"].amount is None and out["I1"].has_bad_amount  # '' < '5.00'
        assert out["I2"].customer_id == "C1"                         # customer_id first
        df = df.orderBy("amount", ascending=False)


def _dim(spark):
    rows = [("C1", "2026-08-01", "PLAN-1", "EU", "SMB"), ("C1", "2026-08-02", "PLAN-1", "EU", "SMB")]
    return marts.int_customer_scd(marts.int_customer_history(snapshots(spark, rows)))


def test_flagged_is_not_paid_and_unknown_plan_drops_from_mrr(spark):
    inv = staging.stg_invoices(spark.createDataFrame([
        ("I1", "C1", "PLAN-1", d("2026-08-01"), "-1", "paid"),
        ("I2", "C1", "PLAN-9", d("2026-08-02"), "10", "paid"),
        ("I3", "C1", "PLAN-1", d("2026-08-02"), "20.50", "paid"),
        ("I4", "C1", "PLAN-1", d("2026-08-02"), "30", "failed")], INV))
    dim = _dim(spark)
    fact = marts.fact_invoice(marts.int_invoice_resolved(inv, dim))
    status = {r.invoice_id: r.status_clean for r in fact.collect()}
    assert status == {"I1": "flagged_for_review", "I2": "paid", "I3": "paid", "I4": "failed"}
    plans = staging.stg_plans(spark.createDataFrame([("PLAN-1", "One", "29", "starter")], PLANS))
    mrr = marts.mrr_monthly(fact, marts.dim_plan(plans), marts.dim_customer(dim)).collect()
    assert len(mrr) == 1
    r = mrr[0]
    assert (r.invoice_month, r.plan_name, r.segment, r.paying_customers) == \
        (d("2026-08-01"), "One", "SMB", 1)
    assert r.mrr == Decimal("20.50") and r.arpu == 20.5


def test_arpu_rounds_half_up_exactly(spark):
    inv = staging.stg_invoices(spark.createDataFrame([
        ("I1", "C1", "PLAN-1", d("2026-08-01"), "0.01", "paid"),
        ("I2", "C2", "PLAN-1", d("2026-08-01"), "0.00", "paid")], INV))
    rows = [("C1", "2026-08-01", "PLAN-1", "EU", "SMB"), ("C2", "2026-08-01", "PLAN-1", "EU", "SMB")]
    dim = marts.int_customer_scd(marts.int_customer_history(snapshots(spark, rows)))
    fact = marts.fact_invoice(marts.int_invoice_resolved(inv, dim))
    plans = staging.stg_plans(spark.createDataFrame([("PLAN-1", "One", "29", "starter")], PLANS))
    r = marts.mrr_monthly(fact, marts.dim_plan(plans), marts.dim_customer(dim)).collect()[0]
    assert r.paying_customers == 2 and r.arpu == 0.01   # 0.005 -> 0.01


def test_usage_without_matching_event_types_counts_zero(spark):
    ev = staging.stg_usage_events(spark.createDataFrame([
        ("E1", "C1", "export", "2026-08-01T10:00:00", "api"),
        ("E2", "C1", "export", "2026-08-01T11:00:00", "api"),
        ("E3", "C9", "login", "2026-08-01T11:00:00", "api")], EVENTS))
    out = marts.fact_usage_daily(ev, _dim(spark)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.customer_key, r.event_date, r.event_count, r.distinct_event_types,
            r.login_count, r.api_call_count) == ("C1-1", d("2026-08-01"), 2, 1, 0, 0)


def test_event_timestamp_iso_t_parses(spark):
    ev = staging.stg_usage_events(spark.createDataFrame(
        [("E1", "C1", "login", "2026-08-16T23:59:59", "api")], EVENTS)).collect()[0]
    assert ev.event_timestamp == dt.datetime(2026, 8, 16, 23, 59, 59)
    assert ev.event_date == d("2026-08-16")


def test_dim_date_weekend_and_names(spark):
    cal = {r.date_day: r for r in marts.dim_date(spark, "2026-08-14", "2026-08-17").collect()}
    assert len(cal) == 4
    sun = cal[d("2026-08-16")]
    assert (sun.day_of_week, sun.is_weekend, sun.day_name, sun.month_name) == (0, True, "Sunday", "August")
    assert cal[d("2026-08-15")].is_weekend and not cal[d("2026-08-17")].is_weekend
    assert cal[d("2026-08-17")].day_of_week == 1
