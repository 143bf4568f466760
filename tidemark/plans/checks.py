"""The warehouse's declared data tests, run as Spark jobs.

Declarations are data (below); each `*_checks` function turns them into one
DataFrame of results with the common check schema. `models` is anything
indexable by model name: a `Warehouse`, or a dict of written marts layered
over one (see `pipeline.run`).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import quality

# The declared expectations of the warehouse.
UNIQUE = [("stg_plans", "plan_id"), ("stg_invoices", "invoice_id"),
          ("stg_usage_events", "event_id"), ("dim_customer", "customer_key"),
          ("dim_plan", "plan_id"), ("dim_date", "date_day"), ("fact_invoice", "invoice_id")]
NOT_NULL = {
    "stg_plans": ["plan_id"],
    "stg_customers": ["customer_id", "snapshot_date"],
    "stg_invoices": ["invoice_id"],
    "stg_usage_events": ["event_id"],
    "dim_customer": ["customer_key", "customer_id", "valid_from"],
    "dim_plan": ["plan_id"],
    "dim_date": ["date_day"],
    "fact_invoice": ["invoice_id", "customer_key"],
    "fact_invoice_rejected": ["invoice_id"],
    "fact_usage_daily": ["customer_key"],
    "mrr_monthly": ["mrr"],
}
ACCEPTED_VALUES = [
    ("dim_customer", "segment", ["SMB", "Mid-Market", "Enterprise"]),
    ("dim_plan", "tier", ["starter", "growth", "scale", "enterprise"]),
    ("fact_invoice", "status_clean", ["paid", "failed", "refunded", "flagged_for_review"]),
    ("fact_invoice_rejected", "rejection_reason",
     ["orphan_customer_id", "invoice_predates_scd_coverage"]),
]
STAGING = [m for m in NOT_NULL if m.startswith("stg_")]
RELATIONSHIPS = [("fact_invoice", "customer_key", "dim_customer", "customer_key"),
                 ("fact_invoice", "plan_id", "dim_plan", "plan_id"),
                 ("fact_usage_daily", "customer_key", "dim_customer", "customer_key")]


def unique_checks(models: Mapping[str, DataFrame], only=None) -> DataFrame:
    return quality.union_all([quality.expect_unique(models[m], c, m) for m, c in UNIQUE
                              if only is None or m in only])


def declared_row_checks(model: str) -> quality.RowChecks:
    """All row-level tests of one model: not_null, accepted_values and the two
    row-level singular ones."""
    counts = {("not_null", c): F.col(c).isNull() for c in NOT_NULL.get(model, [])}
    if model == "fact_invoice":
        counts["assert_paid_non_negative", ""] = quality.paid_negative()
        counts["assert_fact_resolved", ""] = F.col("customer_key").isNull()
    accepted = {c: values for m, c, values in ACCEPTED_VALUES if m == model}
    return quality.RowChecks(model, counts, accepted)


def row_checks(models: Mapping[str, DataFrame], model: str) -> DataFrame:
    """The row-level tests in one aggregate over the model."""
    declared = declared_row_checks(model)
    return quality.row_level_checks(models[model], model, declared.counts, declared.accepted)


def not_null_checks(models: Mapping[str, DataFrame]) -> DataFrame:
    return quality.union_all([quality.expect_not_null(models[m], cols, m)
                              for m, cols in NOT_NULL.items()])


def accepted_values_checks(models: Mapping[str, DataFrame]) -> DataFrame:
    return quality.union_all([quality.expect_accepted_values(models[m], c, vals, m)
                              for m, c, vals in ACCEPTED_VALUES])


def relationship_checks(models: Mapping[str, DataFrame], only=None) -> DataFrame:
    return quality.union_all([
        quality.expect_relationships(models[m], c, models[pm], pf, m)
        for m, c, pm, pf in RELATIONSHIPS if only is None or m in only])


def overlap_check(models: Mapping[str, DataFrame]) -> DataFrame:
    rows = quality.assert_no_scd_overlap(models["dim_customer"])
    return rows.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("assert_no_scd_overlap").alias("check_name"), F.lit("dim_customer").alias("model"),
        F.lit("").alias("column_name"), F.col("n").alias("failures"),
        F.col("n").alias("failing_rows"))


def model_checks(model: str | None, models: Mapping[str, DataFrame]) -> DataFrame:
    """The declared tests of one mart, or (None) of the staging models, with a
    `passed` flag. Row-level tests share one scan of their model; uniqueness,
    relationships and the overlap check each need a shuffle of their own."""
    names = [model] if model else STAGING
    frames = [row_checks(models, m) for m in names if m in NOT_NULL]
    frames += _shuffled_checks(models, names)
    return quality.union_all(frames).withColumn("passed", F.col("failures") == 0)


def _shuffled_checks(models: Mapping[str, DataFrame], names: list[str]) -> list[DataFrame]:
    frames = []
    if any(m in names for m, _ in UNIQUE):
        frames.append(unique_checks(models, names))
    if any(r[0] in names for r in RELATIONSHIPS):
        frames.append(relationship_checks(models, names))
    if "dim_customer" in names:
        frames.append(overlap_check(models))
    return frames


def other_checks(model: str, models: Mapping[str, DataFrame]) -> DataFrame | None:
    """The tests of a mart that are not row-level; None if there are none."""
    frames = _shuffled_checks(models, [model])
    return quality.union_all(frames) if frames else None


def all_checks(models: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared test (29 generic + 3 singular) with a `passed` flag."""
    marts = [m for m in NOT_NULL if not m.startswith("stg_")]
    return quality.union_all([model_checks(m, models) for m in (None, *marts)])
