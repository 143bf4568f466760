"""The driver's TPC-H-like tables seen as the four source extracts.

Each source is a DataFrame expression over the given Parquet tables, so its
size grows with the scale factor. Ids stay bigint here (strings in real CSV
extracts); every operator takes either. The mapping is fixed by the test plan:

* plans          <- region
* crm_customers  <- customer joined to nation, one row per distinct event day
* invoices       <- orders, with orphans, pre-coverage dates, bad amounts and
                    duplicated ids injected by rule
* usage_events   <- events
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the mapping.
SIGNUP_DATE = "2023-06-01"
ORPHAN_OFFSET = 1_000_000
INVOICE_START = "2024-01-01"
LATE_INVOICE_START = "2023-12-20"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fl(x: Column) -> Column:
    return F.floor(x).cast("int")


def _dealt(rows: DataFrame) -> DataFrame:
    """`rows` dealt evenly over `spark.sql.shuffle.partitions` tasks, whatever their
    values, for a step that makes many rows of each. The number is given: AQE would
    merge partitions by the bytes of the few rows before that step."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def plans_from(region: DataFrame) -> DataFrame:
    k = F.col("r_regionkey")
    return region.select(
        F.concat(F.lit("PLAN-"), k.cast("string")).alias("plan_id"),
        F.col("r_name").alias("plan_name"),
        (F.lit(100) * (k + 1)).alias("monthly_price"),
        F.lower("r_name").alias("tier"),
    )


def crm_customers_from(customer: DataFrame, nation: DataFrame, events: DataFrame) -> DataFrame:
    # The snapshot calendar is the set of distinct event days: bounded by the
    # number of calendar days, not by data volume, so it is computed once as a
    # scalar subquery and exploded per customer (no cross join). A file of customers
    # is few tasks but becomes a row per customer and day: the customers are dealt out
    # first. That is before the join with nation, not after it: AQE would take the few
    # bytes dealt out for the size of the snapshots and broadcast them.
    days = events.select(F.array_sort(F.collect_set(F.to_date("ts")))).scalar()
    c = F.col("c_custkey")
    day_no = F.dayofmonth("snapshot_date")
    plan_shift = F.when(c % 3 == 0, _fl((c * 7 + day_no) / F.lit(11.0))).otherwise(0)
    region_shift = F.when(c % 7 == 1, _fl((c + day_no) / F.lit(13.0))).otherwise(0)
    switched = (c % 5 == 2) & (_fl((c + day_no) / F.lit(9.0)) % 2 == 1)
    left_out = ((c % 10 == 9) & (day_no < 8)) | ((c % 13 == 5) & day_no.isin(14, 15))
    return (
        _dealt(customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
        .join(nation.select("n_nationkey", "n_name", "n_regionkey"),
              F.col("c_nationkey") == F.col("n_nationkey"))
        .select("*", F.explode(days).alias("snapshot_date"))
        .where(~left_out)
        .select(
            c.alias("customer_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("company"),
            F.concat(F.lit("PLAN-"), ((c + plan_shift) % 5).cast("string")).alias("plan_id"),
            F.concat(F.lit("REGION-"),
                     ((F.col("n_regionkey") + region_shift) % 5).cast("string")).alias("region"),
            F.when(switched, F.lit("SWITCHED")).otherwise(F.col("c_mktsegment")).alias("segment"),
            F.lit(SIGNUP_DATE).cast("date").alias("signup_date"),
            F.col("snapshot_date"),
        )
    )


def invoices_from(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("string")
    base = orders.select(
        k.alias("invoice_id"),
        F.when(k % 67 == 0, F.col("o_custkey") + ORPHAN_OFFSET)
         .otherwise(F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit("PLAN-"), (F.col("o_custkey") % 5).cast("string")).alias("plan_id"),
        F.when(k % 50 == 3, F.date_add(F.lit(LATE_INVOICE_START).cast("date"), (k % 7).cast("int")))
         .otherwise(F.date_add(F.lit(INVOICE_START).cast("date"), (k % 30).cast("int")))
         .alias("invoice_date"),
        F.when(k % 53 == 0, F.lit(""))
         .when(k % 61 == 0, F.lit("n/a"))
         .when(k % 59 == 0, F.concat(F.lit("-"), price))
         .otherwise(price).alias("amount"),
        F.when(F.col("o_orderstatus") != "P", F.lit("paid"))
         .when(k % 2 == 0, F.lit("failed"))
         .otherwise(F.lit("refunded")).alias("status"),
    )
    # Re-submitted billing records: the same ids delivered twice.
    return base.unionByName(base.where(F.col("invoice_id") % 50 == 7))


def usage_events_from(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    return events.select(
        eid,
        F.when(eid % 97 == 0, F.col("user_id") + ORPHAN_OFFSET)
         .otherwise(F.col("user_id")).alias("customer_id"),
        F.when(F.col("event_type") == "view", F.lit("login"))
         .when(F.col("event_type") == "click", F.lit("api_call"))
         .otherwise(F.col("event_type")).alias("event_type"),
        F.col("ts").alias("event_timestamp"),
        F.col("props").alias("feature_used"),
    )


def load_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four sources over the driver tables found in `sf_dir`."""
    t = lambda name: table(spark, sf_dir, name)
    events = t("events")
    return {
        "plans": plans_from(t("region")),
        "crm_customers": crm_customers_from(t("customer"), t("nation"), events),
        "invoices": invoices_from(t("orders")),
        "usage_events": usage_events_from(events),
    }
