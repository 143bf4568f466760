"""Source profiles: measurements of raw extracts that tell whether the
messiness the pipeline is built to absorb is present, and how much."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of
from tidemark.operators.dedup import dedup_first
from tidemark.operators.quality import unmatched_rows


def snapshot_rows(snapshots: DataFrame, day: str = "snapshot_date") -> DataFrame:
    """Rows per snapshot day."""
    return (snapshots.groupBy(F.col(day).cast("date").alias(day))
            .agg(F.count(F.lit(1)).alias("row_count")))


def daily_changes(snapshots: DataFrame, key: str, tracked: list[str],
                  day: str = "snapshot_date") -> DataFrame:
    """Per day: keys present on that day and the day before, and how many of
    them carry a different tracked tuple (NULL = NULL counts as equal).

    An equi join on (key, day) against the previous day's rows: no window
    over a key's whole history. One row per (key, day) is kept first, so the
    join is one-to-one even if a day was delivered twice.
    """
    # a NULL key never pairs with anything: keep it out of both shuffles
    rows = snapshots.where(F.col(key).isNotNull())
    one = dedup_first(
        rows.select(key, F.col(day).cast("date").alias(day), *tracked), [key, day], tracked)
    prev = one.select(F.col(key).alias("_pk"), F.date_add(day, 1).alias("_pd"),
                      *[F.col(c).alias(f"_p_{c}") for c in tracked])
    joined = one.join(prev, (F.col(key) == F.col("_pk")) & (F.col(day) == F.col("_pd")))
    changed = any_of([~F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in tracked])
    return joined.groupBy(day).agg(F.count(F.lit(1)).alias("customers_compared"),
                                   F.count_if(changed).alias("customers_changed"))


def _known_keys(snapshots: DataFrame, key: str) -> DataFrame:
    return snapshots.select(F.col(key).alias("_known")).where(F.col("_known").isNotNull()).distinct()


def _unknown_count(rows: DataFrame, snapshots: DataFrame, key: str):
    """Rows whose key is in no snapshot (scalar). NULL keys are unknown by
    definition and are counted without entering the anti join."""
    nulls = rows.select(F.count_if(F.col(key).isNull())).scalar()
    unmatched = unmatched_rows(rows, key, _known_keys(snapshots, key), "_known")
    return nulls + unmatched.select("n").scalar()


def invoice_profile(invoices: DataFrame, snapshots: DataFrame,
                    key: str = "customer_id", day: str = "snapshot_date") -> DataFrame:
    """One row: rows, distinct ids, repeated ids (rows - distinct), orphan rows
    (customer in no snapshot), bad text amounts (empty or a negative number;
    other unparsable text is not counted here) and rows dated before the
    first snapshot day."""
    amount = F.col("amount").cast("string")
    negative = amount.rlike(r"^-[0-9.]+$") & (amount.try_cast("double") < 0)
    bad = amount.isNull() | (amount == "") | F.coalesce(negative, F.lit(False))
    first_day = snapshots.select(F.min(F.col(day).cast("date"))).scalar()
    orphans = _unknown_count(invoices, snapshots, key)
    stats = invoices.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_distinct("invoice_id").alias("distinct_ids"),
        F.count_if(bad).alias("bad_amount_rows"),
        F.count_if(F.col("invoice_date").cast("date") < first_day).alias("pre_window_rows"))
    return stats.select(
        "raw_rows", "distinct_ids",
        (F.col("raw_rows") - F.col("distinct_ids")).alias("duplicate_ids"),
        orphans.alias("orphan_rows"), "bad_amount_rows", "pre_window_rows")


def event_profile(events: DataFrame, snapshots: DataFrame, key: str = "customer_id") -> DataFrame:
    """One row: events, events whose customer is in no snapshot, all known?"""
    unknown = _unknown_count(events, snapshots, key)
    return events.agg(F.count(F.lit(1)).alias("event_rows")).select(
        "event_rows", unknown.alias("unknown_customer_rows"),
        (unknown == 0).alias("all_known"))


def plan_profile(plans: DataFrame, key: str = "plan_id") -> DataFrame:
    """One row: plans, distinct ids, rows with an empty or NULL value, and
    whether the reference table is complete (no such row, ids unique)."""
    empty = any_of([F.col(c).isNull() | (F.col(c).cast("string") == "") for c in plans.columns])
    stats = plans.agg(F.count(F.lit(1)).alias("plan_rows"),
                      F.count_distinct(key).alias("distinct_plan_ids"),
                      F.count_if(empty).alias("rows_with_missing"))
    complete = (F.col("rows_with_missing") == 0) & (F.col("plan_rows") == F.col("distinct_plan_ids"))
    return stats.select("plan_rows", "distinct_plan_ids", "rows_with_missing",
                        complete.alias("complete"))

