"""Reports over the built warehouse: where every invoice went, why rows were
rejected, revenue by plan and segment, how much the dimension changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scd import change_summary
from tidemark.operators.temporal import ORPHAN, UNCOVERED


def _n(df: DataFrame):
    return df.select(F.count(F.lit(1))).scalar()


def invoice_reconciliation(raw: DataFrame, deduped: DataFrame, fact: DataFrame,
                           rejected: DataFrame) -> DataFrame:
    """One row of stage counts, raw -> deduplicated -> resolved (of which
    flagged) + rejected (by reason), and whether nothing was lost:
    deduplicated = resolved + rejected."""
    reasons = rejected.agg(
        F.count(F.lit(1)).alias("rejected_rows"),
        F.count_if(F.col("rejection_reason") == "orphan_customer_id").alias("orphan_rows"),
        F.count_if(F.col("rejection_reason") == "invoice_predates_scd_coverage")
         .alias("predates_rows"))
    raw_n, dedup_n = _n(raw), _n(deduped)
    resolved = fact.agg(
        F.count(F.lit(1)).alias("resolved_rows"),
        F.count_if(F.col("status_clean") == "flagged_for_review").alias("flagged_rows"))
    res_n = resolved.select("resolved_rows").scalar()
    flag_n = resolved.select("flagged_rows").scalar()
    return reasons.select(*reconciliation(raw_n, dedup_n, res_n, flag_n, *map(F.col, (
        "rejected_rows", "orphan_rows", "predates_rows"))))


def reconciliation(raw: Column, deduplicated: Column, resolved: Column, flagged: Column,
                   rejected: Column, orphan: Column, predates: Column) -> list[Column]:
    """The columns of the reconciliation, from its counts."""
    return [raw.alias("raw_rows"), deduplicated.alias("deduplicated_rows"),
            (raw - deduplicated).alias("duplicates_collapsed"),
            resolved.alias("resolved_rows"), flagged.alias("flagged_rows"),
            rejected.alias("rejected_rows"), orphan.alias("orphan_rows"),
            predates.alias("predates_rows"),
            (deduplicated == resolved + rejected).alias("balanced")]


def routed_reconciliation(raw: DataFrame, routes: DataFrame) -> DataFrame:
    """`invoice_reconciliation` from the routed invoices: one aggregate over one
    resolution, beside the count of raw rows. An invoice of a reason that is not
    listed would be missing from the balance."""
    resolved = F.col("route").isNull() & F.col("customer_key").isNotNull()
    counts = routes.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(resolved).alias("resolved"),
        F.count_if(resolved & F.coalesce(F.col("has_bad_amount"), F.lit(False))).alias("flagged"),
        F.count_if(F.col("route") == ORPHAN).alias("orphan"),
        F.count_if(F.col("route") == UNCOVERED).alias("predates"))
    return counts.select(*reconciliation(
        _n(raw), F.col("n"), F.col("resolved"), F.col("flagged"),
        F.col("orphan") + F.col("predates"), F.col("orphan"), F.col("predates")))


def rejection_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("row_count"))


def mrr_by_plan_segment(mrr: DataFrame) -> DataFrame:
    return (mrr.select("plan_name", "segment", "mrr", "paying_customers")
               .orderBy("plan_name", "segment"))


def scd_change_summary(scd: DataFrame, snapshots: DataFrame) -> DataFrame:
    return change_summary(scd, snapshots, "customer_id", "snapshot_date")
