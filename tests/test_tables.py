"""Tables by name: one whole run for every reader, tables overwritten in one step."""
import tempfile
import threading

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_pipeline import clean_sources

from tidemark.plans import reports
from tidemark.plans.pipeline import ChecksFailed, run
from tidemark.sources import testviews
from tidemark.sources.tables import TableStore, table_name


@pytest.fixture()
def store(spark, request):
    folder = tempfile.mkdtemp(prefix="tidemark-store-")
    return TableStore(spark, f"st_{request.node.name[:20].strip('_')}", folder)


def make(spark, store, run_id, n):
    """A small run: two tables that agree on n."""
    base = f"{store.location}/data/{run_id}"
    spark.range(n).write.parquet(f"{base}/a")
    spark.range(n).withColumn("part", F.col("id") % 2).write.partitionBy("part").parquet(f"{base}/b")
    return store.register(run_id, {"raw/a": f"{base}/a", "b": f"{base}/b"})


def test_a_reader_keeps_its_run(spark, store):
    store.publish(make(spark, store, "one", 10))
    reader = store.current()
    two = make(spark, store, "two", 20)
    assert store.current().run_id == "one"       # registered, not published
    store.publish(two)
    assert reader.table("raw_a").count() == reader.table("b").count() == 10
    assert store.current().table("raw/a").count() == store.current().table("b").count() == 20
    assert reader.tables() == ["b", "raw_a"]
    store.current().use()
    assert spark.sql("SELECT count(*) FROM raw_a JOIN b USING (id)").first()[0] == 20
    spark.catalog.setCurrentDatabase("default")


def test_readers_during_publishes_see_one_run(spark, store):
    runs = [make(spark, store, f"r{i}", 5 + i) for i in range(3)]
    store.publish(runs[0])
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            at = store.current()
            seen.append((at.table("raw_a").count(), at.table("b").count()))

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(12):
        store.publish(runs[i % 3])
    stop.set()
    reader.join()
    assert seen and all(a == b for a, b in seen)


def test_overwrite_is_one_step(spark, store):
    first = store.overwrite("t", spark.range(3))
    assert first.count() == 3
    store.overwrite("t", spark.table(f"{store.name}.t").unionByName(spark.range(4)))   # reads itself
    assert spark.table(f"{store.name}.t").count() == 7
    broken = spark.range(2).select(F.raise_error(F.lit("the source is gone")).cast("long").alias("id"))
    with pytest.raises(Exception, match="the source is gone"):
        store.overwrite("t", broken)
    assert spark.table(f"{store.name}.t").count() == 7
    store.overwrite("t", spark.range(1).selectExpr("id", "'x' AS more"))
    assert spark.table(f"{store.name}.t").columns == ["id", "more"]


def test_old_runs_expire_but_not_the_published_one(spark, store):
    for i in range(4):
        made = make(spark, store, f"r{i}", 2)
        if i == 0:
            store.publish(made)
    dropped = store.expire(keep=2)
    assert [x[-2:] for x in dropped] == ["r1", "r2"] and store.current().table("b").count() == 2


def test_names_are_plain(spark, store):
    assert table_name("raw/plans") == "raw_plans"
    with pytest.raises(ValueError):
        TableStore(spark, "a; DROP TABLE b")
    with pytest.raises(ValueError):
        store.overwrite("a b", spark.range(1))


def test_the_nightly_run_by_name(spark, store):
    out = tempfile.mkdtemp(prefix="tidemark-named-")
    paths = run(spark, clean_sources(spark), out, calendar=("2024-01-01", "2024-01-31"), tables=store)
    at = store.current()
    assert set(at.tables()) >= {"raw_plans", "dim_customer", "mrr_monthly", "_checks", "_load_summary"}
    by_name = reports.mrr_by_plan_segment(at.table("mrr_monthly")).collect()
    assert by_name == reports.mrr_by_plan_segment(spark.read.parquet(paths["mrr_monthly"])).collect()
    assert at.table("fact_invoice").where("invoice_month_part is not null").count() > 0
    with pytest.raises(ChecksFailed):     # breaks before the pointer is turned
        run(spark, testviews.load_sources(spark, SF_SMALL), out, tables=store)
    assert store.current() == at
