"""Intermediate models and the star schema.

Where a mart aggregates after a join, the facts are aggregated to the grain
of the join first (map-side partial aggregation included), so a customer with
millions of events or invoices enters the join as a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import day_of_week_sunday0, half_up_div, month_start
from tidemark.operators.scd import IDENTITY, WIDE, close_ranges, snapshot_versions
from tidemark.operators.temporal import ORPHAN, UNCOVERED, classify_unresolved, temporal_join

# SCD2 attribute roles of the CRM snapshot.
CUSTOMER_TRACKED = ["plan_id", "region", "segment"]
CUSTOMER_CARRIED = ["name", "email", "company", "signup_date"]
# Fixed value: the status of an invoice whose amount is bad.
FLAGGED = "flagged_for_review"
SCD_COLUMNS = ["customer_key", "customer_id", "name", "email", "company", "plan_id",
               "region", "segment", "signup_date", "version_id", "valid_from",
               "valid_to", "is_current"]


def int_customer_history(stg_customers: DataFrame, null_safe: bool = False,
                         wide_rows: int | None = None, keep_helpers: bool = False) -> DataFrame:
    return snapshot_versions(stg_customers, "customer_id", CUSTOMER_TRACKED,
                             CUSTOMER_CARRIED, "snapshot_date", null_safe=null_safe,
                             wide_rows=wide_rows, keep_helpers=keep_helpers)


def int_customer_scd(history: DataFrame) -> DataFrame:
    """Closes the ranges. Given a history built with `keep_helpers=True` the
    whole chain stays on one exchange (a plain history works too)."""
    return close_ranges(history, "customer_id",
                        identity=IDENTITY if IDENTITY in history.columns else None,
                        wide=WIDE if WIDE in history.columns else None).select(*SCD_COLUMNS)


def int_invoice_resolved(stg_invoices: DataFrame, scd: DataFrame,
                         exclusive: bool = True) -> DataFrame:
    return temporal_join(stg_invoices, scd, "customer_id", "invoice_date",
                         ["customer_key"], how="left", exclusive=exclusive).select(
        "invoice_id", "customer_id", "plan_id", "invoice_date", "amount", "status",
        "has_bad_amount", "customer_key")


def invoice_routes(stg_invoices: DataFrame, scd: DataFrame) -> DataFrame:
    """Every invoice with where it goes: `route` is NULL for the fact table, else
    the reason of its rejection. One pass over the invoices and one version chain
    resolve and classify them."""
    routed = temporal_join(stg_invoices, scd, "customer_id", "invoice_date", ["customer_key"],
                           known="known_customer")
    reason = F.when(F.col("customer_key").isNotNull(), F.lit(None)).when(
        F.col("known_customer"), F.lit(UNCOVERED)).otherwise(F.lit(ORPHAN))
    return routed.withColumn("route", reason).drop("known_customer")


def dim_customer(scd: DataFrame) -> DataFrame:
    return scd.select(*SCD_COLUMNS)


def dim_plan(stg_plans: DataFrame) -> DataFrame:
    return stg_plans.select("plan_id", "plan_name", "monthly_price", "tier")


def dim_date(spark: SparkSession, start: str | Column, end: str | Column) -> DataFrame:
    """One row per day of [start, end]: calendar parts, names, weekend flag."""
    s = F.lit(start).cast("date") if isinstance(start, str) else start.cast("date")
    e = F.lit(end).cast("date") if isinstance(end, str) else end.cast("date")
    days = spark.range(1).select(
        F.explode(F.sequence(s, e, F.expr("interval 1 day"))).alias("d"))
    dow = day_of_week_sunday0("d")
    return days.select(
        F.col("d").alias("date_day"),
        F.year("d").cast("bigint").alias("year"),
        F.month("d").cast("bigint").alias("month"),
        F.dayofmonth("d").cast("bigint").alias("day"),
        dow.alias("day_of_week"),
        F.date_format("d", "EEEE").alias("day_name"),
        F.date_format("d", "MMMM").alias("month_name"),
        F.when(dow.isin(0, 6), True).otherwise(False).alias("is_weekend"),
    )


def calendar_bounds(stg_customers: DataFrame, days_before: int = 7,
                    days_after: int = 3) -> tuple[Column, Column]:
    """The pipeline window: first snapshot day minus a buffer for late
    invoices, last snapshot day plus a few days (scalar subqueries)."""
    bounds = stg_customers.agg(F.min("snapshot_date").alias("lo"),
                               F.max("snapshot_date").alias("hi"))
    return (bounds.select(F.date_sub("lo", days_before)).scalar(),
            bounds.select(F.date_add("hi", days_after)).scalar())


def fact_invoice(resolved: DataFrame) -> DataFrame:
    status_clean = F.when(F.col("has_bad_amount"), F.lit(FLAGGED)) \
                    .otherwise(F.col("status"))
    return resolved.where(F.col("customer_key").isNotNull()).select(
        "invoice_id", "customer_key", "customer_id", "plan_id", "invoice_date",
        "amount", "status", status_clean.alias("status_clean"), "has_bad_amount")


def fact_invoice_rejected(resolved: DataFrame, scd: DataFrame) -> DataFrame:
    """Unresolved invoices with a reason. `scd` supplies the known customer
    ids: the dimension, or the snapshots it was built from."""
    unresolved = resolved.where(F.col("customer_key").isNull()).select(
        "invoice_id", "customer_id", "plan_id", "invoice_date", "amount", "status")
    return classify_unresolved(unresolved, scd, "customer_id")


def fact_usage_daily(stg_usage_events: DataFrame, scd: DataFrame,
                     exclusive: bool = True) -> DataFrame:
    """Events per customer-version-day. The event day fixes the version, so
    events are first counted per (customer, day) and only those daily rows
    are joined to the dimension; events with no version are left out."""
    et = F.col("event_type")
    daily = stg_usage_events.groupBy("customer_id", "event_date").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct(et).alias("distinct_event_types"),
        F.count_if(et == "login").alias("login_count"),
        F.count_if(et == "api_call").alias("api_call_count"))
    joined = temporal_join(daily, scd, "customer_id", "event_date", ["customer_key"],
                           how="inner", exclusive=exclusive)
    return joined.select("customer_id", "customer_key", "event_date", "event_count",
                         "distinct_event_types", "login_count", "api_call_count")


def mrr_monthly(fact: DataFrame, plans: DataFrame, customers: DataFrame) -> DataFrame:
    """Paid invoices by invoice month, plan and the segment of the customer
    version valid at invoice date. Unknown plans drop out (inner join)."""
    month = month_start("invoice_date").alias("invoice_month")
    per_key = (fact.where(F.col("status_clean") == "paid")
               .groupBy("customer_key", "customer_id", month, "plan_id")
               .agg(F.sum("amount").alias("amount")))
    joined = (per_key
              .join(plans.select("plan_id", "plan_name", "tier"), "plan_id")
              .join(customers.select("customer_key", "segment"), "customer_key"))
    return _mrr(joined)


def _mrr(joined: DataFrame) -> DataFrame:
    agg = joined.groupBy("invoice_month", "plan_name", "tier", "segment").agg(
        F.count_distinct("customer_id").alias("paying_customers"),
        F.sum("amount").cast("decimal(38,2)").alias("mrr"))
    return (agg.withColumn("arpu", half_up_div(F.col("mrr"), F.col("paying_customers"), 2))
               .orderBy("invoice_month", "tier"))


def mrr_from_invoices(stg_invoices: DataFrame, plans: DataFrame, scd: DataFrame,
                      exclusive: bool = True) -> DataFrame:
    """`mrr_monthly` straight from the typed invoices, with the SCD2 chain in the
    plan once: the segments of all rows that share a customer key travel with
    the version through the temporal join, instead of a second join with the
    dimension by that key. (Rows share a key where a change that opens no
    version split them; each of them counts.)"""
    by_key = Window.partitionBy("customer_id", "version_id")
    versions = scd.select("customer_id", "customer_key", "version_id", "valid_from", "valid_to",
                          F.collect_list(F.struct("segment")).over(by_key).alias("segments"))
    paid = stg_invoices.where(~F.col("has_bad_amount") & (F.col("status") == "paid"))
    month = month_start("invoice_date").alias("invoice_month")
    resolved = temporal_join(paid, versions, "customer_id", "invoice_date", ["segments"],
                             how="inner", exclusive=exclusive)
    per_key = resolved.groupBy("customer_id", month, "plan_id", "segments").agg(
        F.sum("amount").alias("amount"))
    joined = per_key.join(plans.select("plan_id", "plan_name", "tier"), "plan_id").withColumn(
        "segment", F.explode("segments.segment"))
    return _mrr(joined)
