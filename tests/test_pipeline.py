"""The nightly run on the driver's tables: expected counts, invariants,
CSV round trip, JSON report sink."""
import json
import os
import tempfile
from decimal import Decimal

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tidemark.operators import profile, quality
from tidemark.plans import reports
from tidemark.plans.pipeline import MART_MODELS, Warehouse, run
from tidemark.sources import extracts, testviews


@pytest.fixture(scope="module")
def built(spark):
    out = tempfile.mkdtemp(prefix="tidemark-marts-")
    paths = run(spark, testviews.load_sources(spark, SF_SMALL), out, gate=False)
    built = {k: spark.read.parquet(v) for k, v in paths.items() if k != "dq_report"}
    assert {r.table_name: r.row_count for r in built["_load_summary"].collect()} == \
        {"plans": 5, "crm_customers": 4371, "invoices": 1530, "usage_events": 1000}
    built["_report_path"] = paths["dq_report"]
    return built


def test_expected_counts_sf0001(spark, built):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    assert wh.stg_plans.count() == 5
    assert wh.sources["crm_customers"].count() == 4371
    assert wh.sources["invoices"].count() == 1530 and wh.stg_invoices.count() == 1500
    assert wh.stg_invoices.where("has_bad_amount").count() == 78
    rej = built["fact_invoice_rejected"]
    assert rej.count() == 93
    reasons = {r.rejection_reason: r.row_count for r in reports.rejection_counts(rej).collect()}
    assert reasons == {"orphan_customer_id": 23, "invoice_predates_scd_coverage": 70}
    dim = built["dim_customer"]
    assert dim.count() == 420 and dim.select("customer_id").distinct().count() == 150
    assert dim.groupBy("customer_id").count().agg(F.max("count")).collect()[0][0] == 8
    assert wh.stg_usage_events.count() == 1000
    fud = built["fact_usage_daily"]
    assert fud.count() == 389 and fud.agg(F.sum("event_count")).collect()[0][0] == 971
    mrr = built["mrr_monthly"]
    assert mrr.count() == 26
    assert mrr.agg(F.sum("mrr")).collect()[0][0] == Decimal("223297425.07")
    per_day = profile.snapshot_rows(wh.sources["crm_customers"]).agg(
        F.min("row_count"), F.max("row_count")).collect()[0]
    assert tuple(per_day) == (135, 150)
    assert set(MART_MODELS) <= set(built)


def test_nothing_is_lost(spark, built):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    rec = reports.invoice_reconciliation(wh.sources["invoices"], wh.stg_invoices,
                                         built["fact_invoice"], built["fact_invoice_rejected"]
                                         ).collect()[0]
    assert rec.balanced and rec.duplicates_collapsed == 30
    assert rec.resolved_rows + rec.rejected_rows == 1500
    ids = built["fact_invoice"].select("invoice_id").unionByName(
        built["fact_invoice_rejected"].select("invoice_id"))
    assert ids.distinct().count() == 1500


def test_singular_assertions_pass(spark, built):
    assert quality.assert_no_scd_overlap(built["dim_customer"]).count() == 0
    assert quality.assert_paid_non_negative(built["fact_invoice"]).count() == 0
    assert quality.assert_fact_resolved(built["fact_invoice"]).count() == 0


def test_run_writes_checks_and_report(spark, built):
    res = {(r.check_name, r.model, r.column_name): r for r in built["_checks"].collect()}
    assert len(res) == 32
    failed = {k for k, r in res.items() if not r.passed}
    # the driver's tables carry other segment and tier names than the declared lists
    assert failed == {("accepted_values", "dim_customer", "segment"),
                      ("accepted_values", "dim_plan", "tier")}
    assert res[("assert_no_scd_overlap", "dim_customer", "")].passed
    path = built["_report_path"]
    doc = json.loads(open(os.path.join(path, [f for f in os.listdir(path)
                                                if f.endswith(".json")][0])).read())
    assert doc["overall_status"] == "alert"
    assert doc["invoice_quarantine_rate"]["quarantined_rows"] == 93


def test_quarantine_rate_warns_on_driver_data(spark, built):
    r = quality.quarantine_rate_report(built["fact_invoice"], built["fact_invoice_rejected"]).collect()[0]
    assert (r.total_rows, r.quarantined_rows, r.rate_status) == (1500, 93, "warn")
    assert r.quarantine_rate == 0.062


def test_health_report_json_sink(spark, built):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    rep = quality.health_report_nested(wh.sources["crm_customers"], built["fact_invoice"],
                                       built["fact_invoice_rejected"])
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-report-"), "dq_report")
    extracts.write_json_report(rep, path)
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    assert len(files) == 1
    doc = json.loads(open(os.path.join(path, files[0])).read())
    assert doc["invoice_quarantine_rate"]["status"] == "warn"
    assert doc["crm_snapshot_volume"]["n_days_checked"] == 30
    assert doc["overall_status"] == "alert"


def test_csv_round_trip_gives_the_same_marts(spark):
    """Write the four sources as CSV extracts (CRM one file per day), read
    them back as text through the glob scan, and rebuild."""
    src = testviews.load_sources(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="tidemark-extracts-")
    for name in ("plans", "invoices", "usage_events"):
        tmp = os.path.join(root, f"_{name}")
        extracts.write_csv(src[name].coalesce(1), tmp)
        part = [f for f in os.listdir(tmp) if f.endswith(".csv")][0]
        os.link(os.path.join(tmp, part), os.path.join(root, f"{name}.csv"))
    crm_dir = os.path.join(root, "crm_customers")
    os.makedirs(crm_dir)
    crm = src["crm_customers"]
    for (day,) in crm.select("snapshot_date").distinct().collect():
        tmp = os.path.join(root, f"_crm_{day:%Y%m%d}")
        extracts.write_csv(crm.where(F.col("snapshot_date") == day).coalesce(1), tmp)
        part = [f for f in os.listdir(tmp) if f.endswith(".csv")][0]
        os.link(os.path.join(tmp, part), os.path.join(crm_dir, f"customers_{day:%Y%m%d}.csv"))

    from_csv = extracts.read_sources(spark, root)
    counts = {r.table_name: r.row_count for r in extracts.load_summary(from_csv).collect()}
    assert counts == {"plans": 5, "crm_customers": 4371, "invoices": 1530, "usage_events": 1000}
    assert all(t == "string" for _, t in from_csv["invoices"].dtypes)

    a = Warehouse(spark, from_csv)
    b = Warehouse(spark, src)
    assert a.int_customer_scd.count() == 420
    assert a.fact_invoice_rejected.count() == 93
    ma = a.mrr_monthly.select("invoice_month", "plan_name", "segment", "mrr", "paying_customers")
    mb = b.mrr_monthly.select("invoice_month", "plan_name", "segment", "mrr", "paying_customers")
    assert ma.exceptAll(mb).count() == 0 and mb.exceptAll(ma).count() == 0
    fa = a.fact_usage_daily.select("customer_key", "event_date", "event_count")
    fb = b.fact_usage_daily.select(F.col("customer_key"), "event_date", "event_count")
    assert fa.exceptAll(fb).count() == 0 and fa.count() == 389


def test_checkpoint_folder_comes_from_the_session_on_a_cluster():
    """A cluster master with no spark.checkpoint.dir is refused rather than
    given a machine-local folder; a set value is used as is."""
    import pytest
    from tidemark import session

    class Conf(dict):
        def get(self, k, default=None):
            return dict.get(self, k, default)

    class Ctx:
        def __init__(self, master, conf):
            self.master, self._conf = master, conf

        def getConf(self):
            return self._conf

        def getCheckpointDir(self):
            return None

    class Spark:
        def __init__(self, master, conf):
            self.sparkContext = Ctx(master, Conf(conf))
            self.conf = Conf(conf)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Spark("yarn", {}))
    shared = "hdfs:///shared/ckpt"
    assert session.ensure_checkpoint_dir(
        Spark("yarn", {"spark.checkpoint.dir": shared})) == shared


def test_run_drops_its_intermediates_unless_asked(spark):
    """The shared intermediates exist for the run only; the marts stay."""
    from tidemark.session import run_folder
    sources = testviews.load_sources(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="tidemark-marts-")
    paths = run(spark, sources, out, run_id="drop-me", with_checks=False, persist_raw=False)
    assert not os.path.exists(run_folder(spark, "drop-me"))
    assert spark.read.parquet(paths["dim_customer"]).count() > 0
    out = tempfile.mkdtemp(prefix="tidemark-marts-")
    run(spark, sources, out, run_id="keep-me", with_checks=False, persist_raw=False,
        keep_intermediates=True)
    kept = run_folder(spark, "keep-me")
    assert os.listdir(kept) == ["int_invoice_resolved"]


def clean_sources(spark):
    """The test views with the segment and tier names of the declared lists."""
    src = testviews.load_sources(spark, SF_SMALL)
    src["plans"] = src["plans"].withColumn("tier", F.lit("growth"))
    src["crm_customers"] = src["crm_customers"].withColumn(
        "segment", F.when(F.col("segment") == "SWITCHED", "SMB").otherwise("Enterprise"))
    return src


def test_a_failing_test_stops_the_run_before_it_is_published(spark):
    from tidemark.plans.pipeline import ChecksFailed, published
    out = tempfile.mkdtemp(prefix="tidemark-gate-")
    first = run(spark, clean_sources(spark), out, calendar=("2024-01-01", "2024-01-31"))
    assert published(spark, out) == first
    assert spark.read.parquet(first["dim_date"]).count() == 31
    assert spark.read.parquet(first["_checks"]).where("not passed").count() == 0
    with pytest.raises(ChecksFailed) as failed:
        run(spark, testviews.load_sources(spark, SF_SMALL), out)
    # the dimension's own tests stop the run before anything is built on it
    assert [(r["model"], r["column_name"]) for r in failed.value.failed] == [
        ("dim_customer", "segment")]
    assert published(spark, out) == first
    assert spark.read.parquet(first["mrr_monthly"]).count() > 0
    runs = os.listdir(os.path.join(out, "runs"))
    assert len(runs) == 2


def test_a_run_broken_half_way_leaves_the_published_one(spark):
    from tidemark.plans.pipeline import published
    out = tempfile.mkdtemp(prefix="tidemark-broken-")
    first = run(spark, clean_sources(spark), out, with_checks=False, persist_raw=False)
    broken = clean_sources(spark)
    broken["usage_events"] = broken["usage_events"].withColumn(
        "feature_used", F.raise_error(F.lit("the disk is gone")).cast("string")).withColumn(
        "event_type", F.coalesce("feature_used", "event_type"))
    with pytest.raises(Exception, match="the disk is gone"):
        run(spark, broken, out, with_checks=False, persist_raw=False)
    assert published(spark, out) == first
    assert spark.read.parquet(first["fact_usage_daily"]).count() == 389


def test_facts_lie_by_month(spark, built):
    fact = built["fact_invoice"]
    assert "invoice_month_part" in fact.columns
    months = fact.groupBy("invoice_month_part").count().count()
    assert months == fact.selectExpr("date_trunc('month', invoice_date)").distinct().count()


CSV = """a,b,c
1,"Foo ""Bar"", Inc",x
2,"line
one",y
3,short
4,too,many,fields
5,,""
"""


def csv_extract(spark, folder, text=CSV, **options):
    from pyspark.sql import types as T
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "one.csv"), "w") as f:
        f.write(text)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
    return extracts.read_extract(spark, folder + "/*.csv", schema, **options)


def test_csv_keeps_quotes_and_line_ends_and_refuses_ragged_rows(spark, tmp_path):
    df = csv_extract(spark, str(tmp_path / "x"))
    good = extracts.good_rows(df, "x", "reject")
    assert sorted(tuple(r) for r in good.collect()) == [
        ("1", 'Foo "Bar", Inc', "x"), ("2", "line\none", "y"), ("5", None, None)]
    assert sorted(tuple(r) for r in extracts.rejects({"x": df}).collect()) == [
        ("x", "3,short"), ("x", "4,too,many,fields")]
    assert good.count() == 3   # and with every column pruned
    with pytest.raises(Exception, match="malformed row in extract x"):
        extracts.good_rows(df, "x").collect()
    with pytest.raises(Exception, match="malformed row in extract x"):
        extracts.good_rows(df, "x").select("a").collect()


def test_csv_in_single_lines_refuses_quoted_line_ends(spark, tmp_path):
    df = csv_extract(spark, str(tmp_path / "x"), multi_line=False)
    good = extracts.good_rows(df, "x", "reject")
    assert sorted(r.a for r in good.collect()) == ["1", "5"]
    assert extracts.rejects({"x": df}).count() == 4


def test_csv_header_is_checked(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)header"):
        csv_extract(spark, str(tmp_path / "x"), "a,c,b\n1,2,3\n").collect()


def test_rejects_are_written_with_the_run(spark):
    out = tempfile.mkdtemp(prefix="tidemark-rejects-")
    rejects = spark.createDataFrame([("invoices", "1,2")], "table_name string, record string")
    paths = run(spark, clean_sources(spark), out, with_checks=False, rejects=rejects)
    assert spark.read.parquet(paths["_rejects"]).count() == 1


def test_command_line_says_what_failed(spark, capsys):
    from tidemark.__main__ import main
    out = tempfile.mkdtemp(prefix="tidemark-cli-")
    assert main(["run", "--testdata", SF_SMALL, "--out", out]) == 1
    said = json.loads(capsys.readouterr().out.strip().split("\n")[-1])
    assert said["published"] is False and said["failed_checks"][0]["column_name"] == "segment"
    assert main(["run", "--testdata", SF_SMALL, "--out", out, "--no-gate"]) == 0


def test_lazy_revenue_has_one_version_chain(spark):
    from conftest import plan_text
    plan = plan_text(Warehouse.from_testdata(spark, SF_SMALL).mrr_monthly)
    assert plan.count("Window [lag(") == 1
