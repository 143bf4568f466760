"""Staging: type, deduplicate and flag the four sources. Nothing is dropped
here except exact re-deliveries of an invoice id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import is_bad_amount, tolerant_decimal
from tidemark.operators.dedup import dedup_first

# Survivor order for repeated invoice ids: customer id first (the documented
# rule), then every other raw column, which makes the choice total.
INVOICE_DEDUP_ORDER = ["customer_id", "invoice_date", "amount", "status", "plan_id"]


def stg_plans(plans: DataFrame) -> DataFrame:
    return plans.select(
        "plan_id", "plan_name",
        F.col("monthly_price").cast("decimal(10,2)").alias("monthly_price"),
        "tier")


def stg_customers(crm_customers: DataFrame) -> DataFrame:
    return crm_customers.select(
        "customer_id", "name", "email", "company", "plan_id", "region", "segment",
        F.col("signup_date").cast("date").alias("signup_date"),
        F.col("snapshot_date").cast("date").alias("snapshot_date"))


def stg_invoices(invoices: DataFrame) -> DataFrame:
    survivors = dedup_first(invoices, ["invoice_id"], INVOICE_DEDUP_ORDER)
    amount = tolerant_decimal("amount", 10, 2)
    return (survivors
            .select("invoice_id", "customer_id", "plan_id",
                    F.col("invoice_date").cast("date").alias("invoice_date"),
                    amount.alias("amount"), "status")
            .withColumn("has_bad_amount", is_bad_amount("amount")))


def stg_usage_events(usage_events: DataFrame) -> DataFrame:
    ts = F.col("event_timestamp").cast("timestamp_ntz")
    return usage_events.select(
        "event_id", "customer_id", "event_type",
        ts.alias("event_timestamp"),
        ts.cast("date").alias("event_date"),
        "feature_used")
