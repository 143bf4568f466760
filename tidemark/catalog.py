"""Registry of named queries: name -> f(spark, sf_dir) -> DataFrame.

Each query builds the warehouse lazily over the driver's tables in `sf_dir`
and returns one relation; nothing is collected.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import profile, quality
from tidemark.operators.dedup import dedup_first
from tidemark.operators.scd import IDENTITY, WIDE, close_ranges, snapshot_versions
from tidemark.operators.temporal import temporal_join
from tidemark.plans import checks, marts, reports
from tidemark.plans.incremental import IncrementalDimension
from tidemark.plans.pipeline import MODELS, Warehouse
from tidemark.session import run_folder
from tidemark.sources import extracts, testviews
from tidemark.sources.tables import TableStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.from_testdata(spark, sf_dir)


def _shared_wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    """For queries over many models: the dimension and the resolved invoices are
    written once under the checkpoint folder instead of planned again for each."""
    return Warehouse.from_testdata(spark, sf_dir, materialize=True)


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _model_query(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _wh(spark, sf_dir).model(name)
    q.__name__ = name
    return q


for _m in MODELS:
    QUERIES[_m] = _model_query(_m)


@register("load_summary")
def load_summary(spark, sf_dir):
    return extracts.load_summary(testviews.load_sources(spark, sf_dir))


# ------------------------------------------------------------ expectations
@register("expect_unique")
def expect_unique(spark, sf_dir):
    frames = [checks.unique_checks(_shared_wh(spark, sf_dir))]
    lineitem = testviews.table(spark, sf_dir, "lineitem")
    frames.append(quality.expect_unique(lineitem, ["l_orderkey", "l_linenumber"], "lineitem"))
    return quality.union_all(frames)


@register("expect_not_null")
def expect_not_null(spark, sf_dir):
    return checks.not_null_checks(_shared_wh(spark, sf_dir))


@register("expect_accepted_values")
def expect_accepted_values(spark, sf_dir):
    return checks.accepted_values_checks(_wh(spark, sf_dir))


@register("expect_relationships")
def expect_relationships(spark, sf_dir):
    return checks.relationship_checks(_shared_wh(spark, sf_dir))


@register("assert_no_scd_overlap")
def assert_no_scd_overlap(spark, sf_dir):
    return quality.assert_no_scd_overlap(_wh(spark, sf_dir).dim_customer)


@register("assert_paid_non_negative")
def assert_paid_non_negative(spark, sf_dir):
    return quality.assert_paid_non_negative(_wh(spark, sf_dir).fact_invoice)


@register("assert_fact_resolved")
def assert_fact_resolved(spark, sf_dir):
    return quality.assert_fact_resolved(_wh(spark, sf_dir).fact_invoice)


# ---------------------------------------------- the same checks where they fail
@register("scd_overlaps")
def scd_overlaps(spark, sf_dir):
    """A dimension with overlaps by rule: an order is a version of its customer
    that lasts up to 39 days, or (one in 97) stays open."""
    orders = testviews.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    ends = F.when(F.col("o_orderkey") % 97 != 0,
                  F.date_add(day, (F.col("o_orderkey") % 40).cast("int")))
    return quality.assert_no_scd_overlap(orders.select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("version_id"),
        day.alias("valid_from"), ends.alias("valid_to")))


@register("paid_negative_invoices")
def paid_negative_invoices(spark, sf_dir):
    """The invariant on invoices whose bad amounts are not yet flagged."""
    raw = _wh(spark, sf_dir).stg_invoices
    return quality.assert_paid_non_negative(raw.withColumn("status_clean", F.col("status")))


@register("unresolved_invoices")
def unresolved_invoices(spark, sf_dir):
    """The invariant before rejected invoices are taken out."""
    return quality.assert_fact_resolved(_wh(spark, sf_dir).int_invoice_resolved)


# ------------------------------------------------------------ CSV
def _csv_records(spark, sf_dir):
    """`documents` as standard CSV records: one in 50 lacks its last field, one
    in 50 has a field too many."""
    docs = testviews.table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", "source", "n_chars")
    fields = [F.coalesce(F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'),
                                                        F.lit('""')), F.lit('"')), F.lit(""))
              for c in docs.columns]
    whole, short = F.concat_ws(",", *fields), F.concat_ws(",", *fields[:-1])
    rest = F.col("doc_id") % 50
    record = F.when(rest == 7, short).when(rest == 9, F.concat(whole, F.lit(',"x"'))).otherwise(
        whole)
    schema = extracts.with_malformed(docs.schema)
    return docs.select(F.from_csv(record, schema.simpleString()[7:-1].replace(":", " "),
                                  extracts.CSV_OPTIONS).alias("r")).select("r.*")


@register("csv_documents")
def csv_documents(spark, sf_dir):
    """The records that fit, read with the options of every extract."""
    return extracts.good_rows(_csv_records(spark, sf_dir), "documents", "reject")


@register("csv_split_documents")
def csv_split_documents(spark, sf_dir):
    """`documents` written as CSV files with quoted line ends and read back, all
    as text, by as many tasks as the files have splits."""
    docs = testviews.table(spark, sf_dir, "documents").select(
        *[F.col(c).cast("string") for c in ("doc_id", "text", "lang", "source", "n_chars")])
    folder = f"{run_folder(spark, uuid.uuid4().hex)}/documents-csv"
    extracts.write_csv(docs, folder)
    read = extracts.read_extract(spark, f"{folder}/*.csv", docs.schema)
    return extracts.good_rows(read, "documents")


@register("csv_rejects")
def csv_rejects(spark, sf_dir):
    return extracts.rejects({"documents": _csv_records(spark, sf_dir)})


# ------------------------------------------------------------ health checks
def _snapshot_counts(spark, sf_dir):
    raw = testviews.load_sources(spark, sf_dir)["crm_customers"]
    return quality.daily_counts(raw, "snapshot_date")


@register("dq_volume_zscore")
def dq_volume_zscore(spark, sf_dir):
    return quality.volume_zscore(_snapshot_counts(spark, sf_dir), "snapshot_date")


@register("dq_volume_summary")
def dq_volume_summary(spark, sf_dir):
    return quality.volume_summary(
        quality.volume_zscore(_snapshot_counts(spark, sf_dir), "snapshot_date"))


@register("dq_quarantine_rate")
def dq_quarantine_rate(spark, sf_dir):
    return quality.resolved_quarantine_rate(_wh(spark, sf_dir).int_invoice_resolved)


@register("dq_health_report")
def dq_health_report(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return quality.rated_health_report(
        wh.sources["crm_customers"], quality.resolved_quarantine_rate(wh.int_invoice_resolved))


# ------------------------------------------------------------ reports
@register("invoice_reconciliation")
def invoice_reconciliation(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return reports.routed_reconciliation(
        wh.sources["invoices"], marts.invoice_routes(wh.stg_invoices, wh.int_customer_scd))


@register("reports_by_name")
def reports_by_name(spark, sf_dir):
    """Revenue by plan and segment, and the rejections, from tables that were
    overwritten and are read by name."""
    wh = _shared_wh(spark, sf_dir)
    store = TableStore(spark, "tidemark_reports")
    for name in ("mrr_monthly", "fact_invoice_rejected"):
        store.overwrite(name, wh.model(name))
    revenue = reports.mrr_by_plan_segment(spark.table("tidemark_reports.mrr_monthly")).select(
        F.concat_ws("/", "plan_name", "segment").alias("item"), F.col("mrr").alias("amount"),
        F.col("paying_customers").alias("row_count"))
    rejected = reports.rejection_counts(spark.table("tidemark_reports.fact_invoice_rejected")).select(
        F.col("rejection_reason").alias("item"), F.lit(None).cast("decimal(38,2)").alias("amount"),
        "row_count")
    return revenue.unionByName(rejected)


@register("rejection_counts")
def rejection_counts(spark, sf_dir):
    return reports.rejection_counts(_wh(spark, sf_dir).fact_invoice_rejected)


@register("mrr_by_plan_segment")
def mrr_by_plan_segment(spark, sf_dir):
    return reports.mrr_by_plan_segment(_wh(spark, sf_dir).mrr_monthly)


@register("scd_change_summary")
def scd_change_summary(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return reports.scd_change_summary(wh.int_customer_scd, wh.stg_customers)


# ------------------------------------------------------------ source profiles
@register("profile_snapshot_rows")
def profile_snapshot_rows(spark, sf_dir):
    return profile.snapshot_rows(testviews.load_sources(spark, sf_dir)["crm_customers"])


@register("profile_daily_changes")
def profile_daily_changes(spark, sf_dir):
    crm = testviews.load_sources(spark, sf_dir)["crm_customers"]
    return profile.daily_changes(crm, "customer_id", ["plan_id", "region", "segment"])


@register("profile_invoices")
def profile_invoices(spark, sf_dir):
    src = testviews.load_sources(spark, sf_dir)
    return profile.invoice_profile(src["invoices"], src["crm_customers"])


@register("profile_events")
def profile_events(spark, sf_dir):
    src = testviews.load_sources(spark, sf_dir)
    return profile.event_profile(src["usage_events"], src["crm_customers"])


@register("profile_plans")
def profile_plans(spark, sf_dir):
    return profile.plan_profile(testviews.load_sources(spark, sf_dir)["plans"])


# ------------------------------------------------------------ the operators on other tables
@register("dedup_lineitem")
def dedup_lineitem(spark, sf_dir):
    """One row per (l_orderkey, l_linenumber), first by all other columns."""
    return dedup_first(testviews.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("scd_from_orders")
def scd_from_orders(spark, sf_dir):
    """Order priority of each customer as an SCD2 over order days. Several
    orders on one day are reduced to the one with the highest order key."""
    orders = testviews.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("order_day"))
    daily = dedup_first(orders, ["o_custkey", "order_day"],
                        [F.col("o_orderkey").desc_nulls_last()])
    # one row per (customer, day) already: no copies to collapse
    history = snapshot_versions(daily, "o_custkey", ["o_orderpriority"], [], "order_day",
                                collapse_copies=False, keep_helpers=True).drop(WIDE)
    return close_ranges(history, "o_custkey", key_name="version_key", identity=IDENTITY)


@register("scd_incremental")
def scd_incremental(spark, sf_dir):
    """The customer dimension built from all snapshot days but the last three, which
    are then merged in one by one; the second of them after the third, so late."""
    crm = _wh(spark, sf_dir).stg_customers
    days = [r[0] for r in crm.select("snapshot_date").distinct().orderBy(
        F.desc_nulls_last("snapshot_date")).limit(3).collect()]
    held = F.coalesce(F.col("snapshot_date").isin(days), F.lit(False))
    kept = IncrementalDimension(spark, run_folder(spark, uuid.uuid4().hex))
    given = crm.where(~held)
    kept.advance(given, given)
    for day in [days[2], days[0], days[1]] if len(days) == 3 else days[::-1]:
        rows = crm.where(F.col("snapshot_date") == day)
        given = given.unionByName(rows)
        kept.advance(rows, given)
    return kept.dimension()


@register("scd_null_ids")
def scd_null_ids(spark, sf_dir):
    """The customer dimension of snapshots in which one id in ten is missing."""
    crm = _wh(spark, sf_dir).stg_customers
    lost = crm.withColumn("customer_id", F.when(F.col("customer_id") % 10 != 4,
                                                F.col("customer_id")))
    return marts.int_customer_scd(marts.int_customer_history(lost, keep_helpers=True))


@register("scd_two_levels")
def scd_two_levels(spark, sf_dir):
    """The customer dimension with every key on the path of placeholder ids: rows
    numbered within (key, day), days chained by their first and last rows."""
    return marts.int_customer_scd(marts.int_customer_history(
        _wh(spark, sf_dir).stg_customers, wide_rows=0, keep_helpers=True))


@register("lineitem_versions")
def lineitem_versions(spark, sf_dir):
    """Every line item with the customer's order priority as of its ship date,
    over years of versions."""
    lines = testviews.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_day"))
    orders = testviews.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    facts = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        "l_orderkey", "l_linenumber", "o_custkey", "ship_day")
    return temporal_join(facts, scd_from_orders(spark, sf_dir).withColumnRenamed(
        "o_orderpriority", "priority"), "o_custkey", "ship_day", ["version_key", "priority"]
    ).withColumnRenamed("priority", "o_orderpriority")


@register("volume_events")
def volume_events(spark, sf_dir):
    events = testviews.table(spark, sf_dir, "events")
    counts = quality.daily_counts(events, "event_day", F.to_date("ts"))
    return quality.volume_zscore(counts, "event_day")
