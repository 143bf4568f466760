"""A key holding a third of the rows: results stay exact, copies collapse,
and the temporal join's hot partition is split by AQE."""
import datetime as dt

import pytest
from conftest import plan_text, snapshots
from pyspark.sql import functions as F

from tidemark.operators.temporal import temporal_join
from tidemark.plans import marts, staging

INV = ("invoice_id string, customer_id string, plan_id string, invoice_date date, "
       "amount string, status string")
EVENTS = "event_id string, customer_id string, event_type string, event_timestamp string, feature_used string"

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_thresholds(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _snapshots(spark, copies):
    rows = [(f"C{c}", f"2026-08-{day:02d}", "A" if (day // 10 + c) % 2 else "B", "EU", "SMB")
            for c in range(20) for day in range(1, 31)]
    hot = [("HOT", f"2026-08-{day:02d}", "A" if day < 15 else "B", "EU", "SMB")
           for day in range(1, 31)]
    return snapshots(spark, rows + hot * copies)


def _invoices(spark):
    rows = [(f"H{i}", "HOT", "P", dt.date(2026, 8, 1 + i % 30), "1", "paid") for i in range(30000)]
    rows += [(f"N{i}", None, "P", dt.date(2026, 8, 1 + i % 30), "1", "paid") for i in range(10000)]
    rows += [(f"O{i}", f"C{i % 20}", "P", dt.date(2026, 7 + i % 3, 1 + i % 28), "1", "paid")
             for i in range(50000)]
    return staging.stg_invoices(spark.createDataFrame(rows, INV))


def test_copies_of_a_hot_key_collapse_to_the_same_dimension(spark):
    once = marts.int_customer_scd(marts.int_customer_history(_snapshots(spark, 1)))
    many = marts.int_customer_scd(marts.int_customer_history(_snapshots(spark, 50)))
    assert once.exceptAll(many).count() == 0 and many.exceptAll(once).count() == 0
    assert many.where("customer_id = 'HOT'").count() == 2


def test_hot_key_temporal_join_is_exact_and_split(spark, small_thresholds):
    scd = marts.int_customer_scd(marts.int_customer_history(_snapshots(spark, 50)))
    inv = _invoices(spark)
    resolved = marts.int_invoice_resolved(inv, scd)
    rows = resolved.collect()
    assert len(rows) == 90000
    # facts meet their versions by customer and day: no partition has the customer
    plan = plan_text(resolved)
    assert "hashpartitioning(customer_id" in plan and "invoice_date" in plan.split(
        "hashpartitioning(customer_id", 1)[1].split(")")[0]
    brute = temporal_join(inv, scd, "customer_id", "invoice_date", ["customer_key"],
                          exclusive=False).select("invoice_id", "customer_key")
    got = spark.createDataFrame([(r.invoice_id, r.customer_key) for r in rows],
                                "invoice_id string, customer_key string")
    assert got.exceptAll(brute).count() == 0 and brute.exceptAll(got).count() == 0
    keys = {r.invoice_id: r.customer_key for r in rows}
    assert keys["H0"] == "HOT-1" and keys["H14"] == "HOT-2" and keys["N0"] is None


def test_hot_customer_events_are_aggregated_before_the_join(spark):
    scd = marts.int_customer_scd(marts.int_customer_history(_snapshots(spark, 1)))
    ev = [(f"E{i}", "HOT", "login" if i % 3 else "export", f"2026-08-{1 + i % 30:02d}T10:00:00", "x")
          for i in range(30000)]
    ev += [(f"F{i}", f"C{i % 20}", "api_call", f"2026-08-{1 + i % 30:02d}T10:00:00", "x")
           for i in range(60000)]
    events = staging.stg_usage_events(spark.createDataFrame(ev, EVENTS))
    daily = marts.fact_usage_daily(events, scd)
    plan = plan_text(daily)
    join_at = plan.find("Join")
    assert "partial_count" in plan[join_at:], plan   # counting happens below the join
    hot = daily.where("customer_id = 'HOT'").agg(F.sum("event_count"), F.sum("login_count")).collect()[0]
    assert tuple(hot) == (30000, 20000)
    assert daily.where("customer_id = 'HOT'").count() == 30
