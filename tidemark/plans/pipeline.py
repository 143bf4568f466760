"""The nightly run: four sources in, staging, the SCD2 dimension, facts,
marts, checks and reports out.

`Warehouse` builds each model once as a DataFrame, in dependency order, on
first use. With `materialize=True` the SCD2 dimension and the resolved invoices,
which several models read, are written once under `spark.checkpoint.dir` and
re-read (see `tidemark.session.materialize`); `run` writes the dimension as a mart
and reads that. Otherwise every model stays a lazy plan, which is what a single ad-hoc
query wants.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.temporal import ORPHAN, UNCOVERED
from tidemark.plans import marts, staging
from tidemark.session import drop_run_folder
from tidemark.session import materialize as write_and_reread
from tidemark.sources import testviews
from tidemark.sources.tables import TableStore

MODELS = ("stg_plans", "stg_customers", "stg_invoices", "stg_usage_events",
          "int_customer_history", "int_customer_scd", "int_invoice_resolved",
          "dim_customer", "dim_plan", "dim_date", "fact_invoice",
          "fact_invoice_rejected", "fact_usage_daily", "mrr_monthly")

MART_MODELS = ("dim_customer", "dim_plan", "dim_date", "fact_invoice",
               "fact_invoice_rejected", "fact_usage_daily", "mrr_monthly")


class Warehouse:
    """calendar: (first, last) day of `dim_date`; by default the snapshot days
    with a margin. null_safe: compare tracked attributes with `<=>`. wide_rows:
    see `operators.scd`. exclusive=False joins facts by the plain range form."""

    def __init__(self, spark: SparkSession, sources: dict[str, DataFrame],
                 materialize: bool = False, run_id: str | None = None,
                 calendar: tuple[str, str] | None = None, exclusive: bool = True,
                 null_safe: bool = False, wide_rows: int | None = None):
        self.spark = spark
        self.sources = sources
        self.materialize = materialize
        self.run_id = run_id or uuid.uuid4().hex
        self.calendar = calendar
        self.exclusive = exclusive
        self.null_safe = null_safe
        self.wide_rows = wide_rows
        self.written: dict[str, DataFrame] = {}
        self.counted: dict[str, int] = {}  # rows of what was written
        self.owns_writes = False  # set by `run`, which writes the dimension itself

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> "Warehouse":
        return cls(spark, testviews.load_sources(spark, sf_dir), **kw)

    def _shared(self, df: DataFrame, name: str) -> DataFrame:
        if not self.materialize:
            return df
        seen = Observation(name)
        shared = write_and_reread(df.observe(seen, F.count(F.lit(1)).alias("rows")), name, self.run_id)
        self.counted[name] = seen.get["rows"]
        return shared

    # staging
    @cached_property
    def stg_plans(self) -> DataFrame:
        return staging.stg_plans(self.sources["plans"])

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.sources["crm_customers"])

    @cached_property
    def stg_invoices(self) -> DataFrame:
        return staging.stg_invoices(self.sources["invoices"])

    @cached_property
    def stg_usage_events(self) -> DataFrame:
        return staging.stg_usage_events(self.sources["usage_events"])

    # intermediate
    @cached_property
    def int_customer_history(self) -> DataFrame:
        return marts.int_customer_history(self.stg_customers, self.null_safe, self.wide_rows)

    @cached_property
    def int_customer_scd(self) -> DataFrame:
        """The written dimension where there is one: it holds the same rows."""
        if "dim_customer" in self.written:
            return self.written["dim_customer"]
        return self._shared(self._scd(), "int_customer_scd")

    def _scd(self) -> DataFrame:
        # built from the history with its helper columns kept, so the lag,
        # running sum, island grouping and lead share one exchange
        return marts.int_customer_scd(marts.int_customer_history(
            self.stg_customers, self.null_safe, self.wide_rows, keep_helpers=True))

    @cached_property
    def int_invoice_resolved(self) -> DataFrame:
        return self._shared(
            marts.int_invoice_resolved(self.stg_invoices, self.int_customer_scd,
                                       exclusive=self.exclusive),
            "int_invoice_resolved")

    # marts
    @cached_property
    def dim_customer(self) -> DataFrame:
        # the nightly run writes it first and then reads it as the SCD
        shared = "int_customer_scd" in self.__dict__ or not self.owns_writes
        return marts.dim_customer(self.int_customer_scd if shared else self._scd())

    @cached_property
    def dim_plan(self) -> DataFrame:
        return marts.dim_plan(self.stg_plans)

    @cached_property
    def dim_date(self) -> DataFrame:
        if self.calendar:
            start, end = self.calendar
        else:
            start, end = marts.calendar_bounds(self.stg_customers)
        return marts.dim_date(self.spark, start, end)

    @cached_property
    def fact_invoice(self) -> DataFrame:
        return marts.fact_invoice(self.int_invoice_resolved)

    @cached_property
    def fact_invoice_rejected(self) -> DataFrame:
        # known customer ids: the written dimension's, or (lazy) the same set
        # read straight from the snapshots, without re-running the window chain
        known = self.int_customer_scd if self.materialize else self.stg_customers
        return marts.fact_invoice_rejected(self.int_invoice_resolved, known)

    @cached_property
    def fact_usage_daily(self) -> DataFrame:
        return marts.fact_usage_daily(self.stg_usage_events, self.int_customer_scd,
                                      exclusive=self.exclusive)

    @cached_property
    def mrr_monthly(self) -> DataFrame:
        if "fact_invoice" in self.written:
            return marts.mrr_monthly(self.written["fact_invoice"], self.dim_plan,
                                     self.int_customer_scd)
        return marts.mrr_from_invoices(self.stg_invoices, self.dim_plan, self.int_customer_scd,
                                       exclusive=self.exclusive)

    def model(self, name: str) -> DataFrame:
        if name not in MODELS:
            raise KeyError(name)
        return getattr(self, name)

    __getitem__ = model


class _Written(dict):
    """Written marts first, the warehouse's lazy models for the rest."""

    def __init__(self, written: dict[str, DataFrame], wh: Warehouse):
        super().__init__(written)
        self.wh = wh

    def __missing__(self, name: str) -> DataFrame:
        return self.wh.model(name)


# The results of the declared tests, one row each.
RESULT_SCHEMA = ("check_name string, model string, column_name string, failures long,"
                 " failing_rows long, passed boolean")
RESULT = [c.split()[0] for c in RESULT_SCHEMA.split(", ")]

# Counts of the reconciliation that the writing of a mart observes.
MART_METRICS = {
    "fact_invoice": {"flagged": ("status_clean", marts.FLAGGED)},
    "fact_invoice_rejected": {"orphan": ("rejection_reason", ORPHAN),
                              "predates": ("rejection_reason", UNCOVERED)},
}


class ChecksFailed(RuntimeError):
    """Declared tests failed, so nothing was published. `failed`: their rows;
    `path`: where the results of all tests are."""

    def __init__(self, failed: list[dict], path: str):
        names = ", ".join(f"{r['check_name']}({r['model']}.{r['column_name']})" for r in failed)
        super().__init__(f"{len(failed)} declared tests failed: {names}; see {path}")
        self.failed, self.path = failed, path


PUBLISHED = "_published"


def published(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """Paths by table name of the run that was published last."""
    rows = spark.read.parquet(f"{out_dir.rstrip('/')}/{PUBLISHED}")
    latest = rows.groupBy("run_id").agg(
        F.max("published_at").alias("at"), F.max("tables").alias("tables")).orderBy(
        F.desc("at"), "run_id").first()
    return {t: f"{out_dir.rstrip('/')}/runs/{latest.run_id}/{t}" for t in latest.tables}


def run(spark: SparkSession, sources: dict[str, DataFrame], out_dir: str,
        run_id: str | None = None, with_checks: bool = True, persist_raw: bool = True,
        z_threshold: float = 2.0, warn_threshold: float = 0.05,
        keep_intermediates: bool = False, gate: bool = True,
        calendar: tuple[str, str] | None = None, null_safe: bool = False,
        fill_calendar: bool = False, wide_rows: int | None = 10_000,
        rejects: DataFrame | None = None, tables: TableStore | None = None) -> dict[str, str]:
    """The nightly job. Writes under `out_dir/runs/<run_id>`:

    * `raw/<source>`: each source landed once as Parquet (full refresh), so
      a CSV extract is parsed once however many models read it,
      `_load_summary`: rows per source, `_reconciliation`: where every invoice
      went, and `_rejects`: malformed extract rows, if `rejects` is given;
    * every mart as Parquet, the invoice facts by invoice month. The customer
      dimension is written first and read back by what needs it; the resolved
      invoices are written once under the checkpoint folder;
    * `_checks`: the 32 declared data tests, one row each;
    * `dq_report`: the health report (snapshot volume z-score on the raw
      CRM rows + invoice quarantine rate) as one JSON document.

    Row counts and row-level tests are metrics that the writing jobs observe, so
    they take no job and no scan of their own; metrics sit in the stage that writes,
    where a repeated task counts once. Uniqueness, relationships, overlaps and the
    tests of the staging models, which are not written, are queries.

    The tests of a mart run before the marts that read it are built. If any
    fails, the run ends with `ChecksFailed` and nothing is published
    (`gate=False` publishes anyway). Publishing is the last step: one row
    appended to `out_dir/_published`, which `published` reads. Until then
    readers see the tables of the run before, and a run that breaks half way
    leaves them whole; folders of old runs are the store's to expire.

    With `tables` the run is also registered in the catalog, and the store's
    pointer is turned to it after `_published`: `tables.current().table(name)`
    reads the tables of one whole run by name.

    The shared intermediates live under `spark.checkpoint.dir` for the run
    only and are deleted when it ends (`keep_intermediates=True` keeps them).

    Returns the paths by name.
    """
    from tidemark.operators import quality
    from tidemark.plans import checks as declared
    from tidemark.plans import reports
    from tidemark.sources.extracts import write_json_report

    wh = Warehouse(spark, sources, materialize=True, run_id=run_id, calendar=calendar,
                   null_safe=null_safe, wide_rows=wide_rows)
    wh.owns_writes = True
    root = f"{out_dir.rstrip('/')}/runs/{wh.run_id}"
    paths: dict[str, str] = {}

    found: dict[str, dict] = {}  # metrics observed by the jobs that wrote the tables

    def write(name: str, df: DataFrame, by: tuple[str, ...] = (), metrics=()) -> DataFrame:
        paths[name] = f"{root}/{name}"
        seen = Observation(name)
        (df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics)
         .write.mode("overwrite").partitionBy(*by).parquet(paths[name]))
        found[name] = seen.get
        return spark.read.schema(df.schema).parquet(paths[name])

    def write_rows(name: str, rows: list[tuple], schema: str) -> None:
        paths[name] = f"{root}/{name}"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(paths[name])

    results: list[tuple] = []

    def settle(new: list[tuple], last: bool = False) -> None:
        """Keep the results of some tests; stop the run if one failed."""
        results.extend((*r, r[3] == 0) for r in new)
        failed = [dict(zip(RESULT, r)) for r in results if not r[-1]] if gate else []
        if failed or last:
            write_rows("_checks", results, RESULT_SCHEMA)
        if failed:
            raise ChecksFailed(failed, paths["_checks"])

    if persist_raw:
        wh.sources = {name: write(f"raw/{name}", df) for name, df in sources.items()}
        write_rows("_load_summary", [(name, found[f"raw/{name}"]["rows"]) for name in sources],
                   "table_name string, row_count long")
        if rejects is not None:
            write("_rejects", rejects)
    try:
        for name in MART_MODELS:
            own = declared.declared_row_checks(name)
            extra = own.metrics() + [F.count_if(F.col(c) == v).alias(metric) for metric, (c, v)
                                     in MART_METRICS.get(name, {}).items()]
            wh.written[name] = _write_mart(
                lambda n, df, by=(): write(n, df, by, extra), name, wh.model(name))
            if with_checks:
                rows = own.results(found[name], wh.written[name])
                other = declared.other_checks(name, _Written(wh.written, wh))
                settle(rows + ([tuple(r) for r in other.collect()] if other is not None else []))
        if persist_raw:
            counts = [found["raw/invoices"]["rows"], wh.counted["int_invoice_resolved"],
                      *(found["fact_invoice"][c] for c in ("rows", "flagged")),
                      *(found["fact_invoice_rejected"][c] for c in ("rows", "orphan", "predates"))]
            write("_reconciliation", spark.range(1).select(
                *reports.reconciliation(*[F.lit(n).cast("long") for n in counts])))
        if with_checks:
            # staging models are not written: one job for all their tests
            staged = declared.model_checks(None, _Written(wh.written, wh)).drop("passed")
            settle([tuple(r) for r in staged.collect()], last=True)
            resolved, rejected = (found[m]["rows"] for m in ("fact_invoice", "fact_invoice_rejected"))
            rate = spark.range(1).select(*quality.quarantine_rate(
                F.lit(resolved + rejected), F.lit(rejected), warn_threshold))
            report = quality.rated_health_report_nested(
                wh.sources["crm_customers"], rate, z_threshold=z_threshold,
                fill_calendar=fill_calendar)
            paths["dq_report"] = f"{root}/dq_report"
            write_json_report(report, paths["dq_report"])
    finally:
        if not keep_intermediates:
            drop_run_folder(spark, wh.run_id)
    named = tables and tables.register(
        wh.run_id, {name: path for name, path in paths.items() if name != "dq_report"})
    listed = F.array(*[F.lit(t) for t in paths])
    (spark.range(1).select(F.lit(wh.run_id).alias("run_id"), F.current_timestamp().alias(
        "published_at"), listed.alias("tables"))
     .write.mode("append").parquet(f"{out_dir.rstrip('/')}/{PUBLISHED}"))
    if tables:
        tables.publish(named)
    return paths


def _write_mart(write, name: str, df: DataFrame) -> DataFrame:
    """Invoice facts lie by invoice month, so that readers skip other months."""
    if name not in ("fact_invoice", "fact_invoice_rejected"):
        return write(name, df)
    month = F.date_format("invoice_date", "yyyy-MM")
    stored = df.withColumn("invoice_month_part", month)
    return write(name, stored, ("invoice_month_part",)).select(*df.columns)


