"""CSV extracts in, Parquet tables and a JSON report out.

The three source systems deliver header CSV files: one file for plans,
invoices and usage events, one file per day for CRM snapshots. Every column
is read as text with an explicit schema (no `inferSchema`, which would cost a
full extra pass and guess types differently from file to file); staging then
types the columns, tolerantly where the source is known to be messy.

Quoting is that of standard CSV: a quote inside a quoted field is doubled, and
a quoted field may hold delimiters and line ends. A row that does not have the
schema's fields is never cut or padded: it is kept as raw text in
`MALFORMED`, and a read either stops at it or puts it among the rejects.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.csv_split import split_records


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# The source layouts (column names in file order).
SCHEMAS = {
    "plans": _text("plan_id", "plan_name", "monthly_price", "tier"),
    "crm_customers": _text(
        "customer_id", "name", "email", "company", "plan_id", "region",
        "segment", "signup_date", "snapshot_date"),
    "invoices": _text(
        "invoice_id", "customer_id", "plan_id", "invoice_date", "amount", "status"),
    "usage_events": _text(
        "event_id", "customer_id", "event_type", "event_timestamp", "feature_used"),
}

# Relative locations inside an extract folder; the CRM extract
# is a glob.
LAYOUT = {
    "plans": "plans.csv",
    "crm_customers": "crm_customers/customers_*.csv",
    "invoices": "invoices.csv",
    "usage_events": "usage_events.csv",
}


# The raw text of a row that does not fit its schema; NULL for every good row.
MALFORMED = "_malformed"

# Options of every CSV read, file or string.
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED,
}


def with_malformed(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType(), True)])


def read_extract(spark: SparkSession, path: str, schema: T.StructType,
                 multi_line: bool = True) -> DataFrame:
    """Scan one CSV file or a glob of daily files (read as one union), with
    the column `MALFORMED` after the schema's.

    `multi_line=True` keeps quoted line ends and still splits large files: the
    records are found by `csv_split.split_records` and parsed one by one.
    `multi_line=False` splits at line ends, in one scan, for extracts known to
    quote none: a value that still begins with a quote is the sign of a quoted
    line end, so its row is malformed, like the rest of it on the next line."""
    fields = with_malformed(schema)
    if multi_line:
        records = split_records(spark, path, schema.names)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        # inline() keeps filters and projections from parsing a record again
        return records.select(F.inline(F.array(F.from_csv(
            "text", ddl, {**CSV_OPTIONS, "multiLine": "true"}))))
    df = (spark.read.schema(fields)
          .options(**CSV_OPTIONS)
          .option("header", True)
          .option("enforceSchema", False)   # header names are checked against the schema
          .csv(path))
    broken = reduce(lambda x, y: x | y, [F.coalesce(F.col(c).startswith('"'), F.lit(False))
                                         for c in schema.names])
    raw = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in schema.names])
    return df.withColumn(MALFORMED, F.coalesce(MALFORMED, F.when(broken, raw)))


def _malformed(extract: DataFrame) -> F.Column:
    """Whether a row is malformed. A scan may not read the raw text alone, so
    the condition names another column as well (its length is never negative)."""
    other = F.length(F.coalesce(F.col(extract.columns[0]).cast("string"), F.lit("")))
    return F.col(MALFORMED).isNotNull() | (other < 0)


def good_rows(extract: DataFrame, name: str, on_malformed: str = "fail") -> DataFrame:
    """The rows that fit. "fail": reading stops at a malformed row, naming the
    extract and the row; "reject": malformed rows are left to `rejects`."""
    if on_malformed == "reject":
        return extract.where(~_malformed(extract)).drop(MALFORMED)
    if on_malformed != "fail":
        raise ValueError("on_malformed must be 'fail' or 'reject'")
    stop = F.raise_error(F.concat(F.lit(f"malformed row in extract {name}: "), F.col(MALFORMED)))
    return extract.where(F.when(~_malformed(extract), F.lit(True))
                         .otherwise(stop.cast("boolean"))).drop(MALFORMED)


def rejects(extracts: dict[str, DataFrame]) -> DataFrame:
    """(table_name, record): the malformed rows of all extracts."""
    parts = [df.where(_malformed(df))
               .select(F.lit(name).alias("table_name"), F.col(MALFORMED).alias("record"))
             for name, df in extracts.items()]
    return reduce(DataFrame.unionByName, parts)


def read_extracts(spark: SparkSession, extract_dir: str,
                  multi_line: dict[str, bool] | None = None) -> dict[str, DataFrame]:
    """Every extract with its malformed rows. multi_line: by source, True where
    not given."""
    root = extract_dir.rstrip("/")
    return {name: read_extract(spark, f"{root}/{rel}", SCHEMAS[name],
                               (multi_line or {}).get(name, True))
            for name, rel in LAYOUT.items()}


def read_sources(spark: SparkSession, extract_dir: str, on_malformed: str = "fail",
                 multi_line: dict[str, bool] | None = None) -> dict[str, DataFrame]:
    """The four sources; see `good_rows` for what happens to malformed rows."""
    return {name: good_rows(df, name, on_malformed)
            for name, df in read_extracts(spark, extract_dir, multi_line).items()}


def load_summary(sources: dict[str, DataFrame]) -> DataFrame:
    """Row count per loaded source: (table_name, row_count)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in sources.items()]
    return reduce(DataFrame.unionByName, parts)


def write_csv(df: DataFrame, path: str) -> None:
    """Standard CSV: quotes doubled, every text quoted."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("quoteAll", True).csv(path))


def write_json_report(report: DataFrame, path: str) -> None:
    """Write a one-row report (nested columns kept) as a single JSON file.

    `repartition(1)` shuffles only the finished row; `coalesce(1)` is narrow
    and would also pull the report's upstream stage into a single task."""
    report.repartition(1).write.mode("overwrite").json(path)
