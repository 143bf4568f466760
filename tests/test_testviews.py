"""The source views: customers are dealt out before they become a row per day."""
import datetime as dt

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from tidemark.operators import profile
from tidemark.plans import marts, staging
from tidemark.sources import testviews

CUSTOMERS, DAYS, PARTS = 640, 20, 8


@pytest.fixture
def source_tables(spark, tmp_path):
    """customer, nation and events as one file each; `same`: all customers are alike."""
    def written(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    def build(same=False):
        return (
            written("customer", [(7, "Customer#7", 1, "AUTO") if same
                                 else (i, f"Customer#{i}", i % 2, "AUTO") for i in range(CUSTOMERS)],
                    "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
            written("nation", [(0, "PERU", 1), (1, "CHINA", 2)],
                    "n_nationkey int, n_name string, n_regionkey int"),
            written("events", [(dt.datetime(2024, 1, 1 + i % DAYS),) for i in range(90)],
                    "ts timestamp"))
    return build


@pytest.mark.parametrize("same", [False, True])
def test_customers_of_one_file_are_dealt_out_before_they_become_snapshots(source_tables, same):
    crm = testviews.crm_customers_from(*source_tables(same))
    held = [r["count"] for r in crm.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert len(held) == PARTS
    assert max(held) <= 2 * CUSTOMERS * DAYS / PARTS
    assert sum(held) > CUSTOMERS * DAYS / 2


def test_null_customers_are_dealt_out_and_kept(source_tables):
    customer, nation, events = source_tables()
    crm = testviews.crm_customers_from(
        customer.withColumn("c_custkey", F.lit(None).cast("long")), nation, events)
    held = [r["count"] for r in crm.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert len(held) == PARTS
    kept = [i for i in range(1, DAYS + 1) if i >= 8 and i not in (14, 15)]
    assert sum(held) == CUSTOMERS * len(kept)


@pytest.mark.parametrize("build", [
    lambda crm: profile.daily_changes(crm, "customer_id", ["plan_id", "region", "segment"]),
    lambda crm: marts.int_customer_scd(marts.int_customer_history(
        staging.stg_customers(crm), keep_helpers=True))])
def test_customers_are_dealt_out_below_the_explode_of_each_chain(source_tables, build):
    plan = plan_text(build(testviews.crm_customers_from(*source_tables())))
    below = plan.split("Generate explode", 1)[1].split("Generate explode", 1)[0]
    assert f"RoundRobinPartitioning({PARTS})" in below, plan


def test_daily_changes_does_not_broadcast_the_snapshots(spark, source_tables):
    """AQE knows the bytes of the customers dealt out, not yet those of their days."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        changes = profile.daily_changes(testviews.crm_customers_from(*source_tables()),
                                        "customer_id", ["plan_id", "region", "segment"])
        assert len(changes.collect()) == DAYS - 1
        final = plan_text(changes).split("Initial Plan")[0]
        assert "SortMergeJoin" in final, final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
