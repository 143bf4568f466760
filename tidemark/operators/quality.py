"""Data expectations and pipeline-health checks, as Spark jobs.

Generic expectations return one row per declaration with a common schema
(`check_name, model, column_name, failures, failing_rows`); `failures`
counts what a failing test query would return (duplicated values for
`unique`, NULL rows for `not_null`, distinct unaccepted values for
`accepted_values`, orphan rows for `relationships`), `failing_rows` the rows
involved. All are aggregations with map-side partial aggregation or an anti
join; none brings a group to one task.

Singular assertions return the offending rows themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import OPEN_END, half_up_div

CHECK_COLUMNS = ["check_name", "model", "column_name", "failures", "failing_rows"]


def _row(df: DataFrame, check: str, model: str, column: str,
         failures: Column, failing_rows: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), F.lit(model).alias("model"),
                     F.lit(column).alias("column_name"),
                     failures.cast("bigint").alias("failures"),
                     failing_rows.cast("bigint").alias("failing_rows"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def expect_unique(df: DataFrame, columns: str | list[str], model: str) -> DataFrame:
    """No two rows share a (non-NULL) value of `columns`."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    dup = (df.select(*cols).where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
             .groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1)
             .agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows")))
    return _row(dup, "unique", model, ",".join(cols),
                F.col("values"), F.coalesce(F.col("rows"), F.lit(0)))


def expect_not_null(df: DataFrame, columns: list[str], model: str) -> DataFrame:
    """One scan for all listed columns of a model; one output row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], columns, "column_name", "n")
    return long.select(F.lit("not_null").alias("check_name"), F.lit(model).alias("model"),
                       "column_name", F.col("n").cast("bigint").alias("failures"),
                       F.col("n").cast("bigint").alias("failing_rows"))


def expect_accepted_values(df: DataFrame, column: str, values: list[str],
                           model: str) -> DataFrame:
    """Every non-NULL value is one of `values`."""
    bad = (df.select(column)
             .where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
             .groupBy(column).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows")))
    return _row(bad, "accepted_values", model, column,
                F.col("values"), F.coalesce(F.col("rows"), F.lit(0)))


class RowChecks:
    """Row-level tests of one model as metrics of the job that writes it, so that
    they cost no scan. counts and accepted: see `row_level_checks`."""

    def __init__(self, model: str, counts: dict[tuple[str, str], Column],
                 accepted: dict[str, list[str]] | None = None):
        self.model, self.counts, self.accepted = model, counts, accepted or {}

    def metrics(self) -> list[Column]:
        return ([F.count_if(c).alias(f"c{i}") for i, c in enumerate(self.counts.values())]
                + [F.count_if(self._bad(c)).alias(f"r{i}") for i, c in enumerate(self.accepted)])

    def _bad(self, column: str) -> Column:
        return F.col(column).isNotNull() & ~F.col(column).isin(*self.accepted[column])

    def results(self, found: dict, written: DataFrame) -> list[tuple]:
        """Rows of CHECK_COLUMNS. Only where a value list is broken are its
        distinct values counted, by a scan of one column."""
        rows = [(check, self.model, column, found[f"c{i}"], found[f"c{i}"])
                for i, (check, column) in enumerate(self.counts)]
        for i, column in enumerate(self.accepted):
            n = found[f"r{i}"]
            values = n and written.where(self._bad(column)).select(
                F.count_distinct(column)).first()[0]
            rows.append(("accepted_values", self.model, column, values, n))
        return rows


def row_level_checks(df: DataFrame, model: str, counts: dict[tuple[str, str], Column],
                     accepted: dict[str, list[str]] | None = None) -> DataFrame:
    """Several row-level tests of one model in one aggregate. counts: offending
    rows by (check, column); accepted: allowed values by column (their failures
    are distinct values, counted as a set of at most those that offend)."""
    accepted = accepted or {}
    totals = [F.count_if(c).alias(f"c{i}") for i, c in enumerate(counts.values())]
    for i, (column, values) in enumerate(accepted.items()):
        bad = F.col(column).isNotNull() & ~F.col(column).isin(*values)
        totals += [F.count_distinct(F.when(bad, F.col(column))).alias(f"v{i}"),
                   F.count_if(bad).alias(f"r{i}")]
    rows = [F.struct(F.lit(check).alias("check_name"), F.lit(model).alias("model"),
                     F.lit(column).alias("column_name"), F.col(f"c{i}").alias("failures"),
                     F.col(f"c{i}").alias("failing_rows"))
            for i, (check, column) in enumerate(counts)]
    rows += [F.struct(F.lit("accepted_values").alias("check_name"), F.lit(model).alias("model"),
                      F.lit(column).alias("column_name"), F.col(f"v{i}").alias("failures"),
                      F.col(f"r{i}").alias("failing_rows"))
             for i, column in enumerate(accepted)]
    return df.agg(*totals).select(F.inline(F.array(*rows)))


def expect_relationships(child: DataFrame, column: str, parent: DataFrame, field: str,
                         model: str) -> DataFrame:
    """Every non-NULL child key exists in the parent."""
    orphans = unmatched_rows(child, column, parent, field)
    return _row(orphans, "relationships", model, column, F.col("n"), F.col("n"))


def unmatched_rows(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """One row `n`: child rows with a key that is not in the parent. Child rows are
    counted by key before the anti join, so a task ships its distinct keys, never
    its rows, and a key that holds a third of them is one row per task."""
    keys = parent.select(F.col(field).alias("_parent_key")).where(F.col("_parent_key").isNotNull())
    counted = (child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_child_key"))
               .agg(F.count(F.lit(1)).alias("_n")))
    return (counted.join(keys, F.col("_child_key") == F.col("_parent_key"), "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")))


# ------------------------------------------------------------ singular checks

def _over_earlier(rows: DataFrame, key: str, day: Column, order: list[str],
                  running: dict[str, tuple[str, Column]], sliced: bool) -> DataFrame:
    """`rows` with running maxima or minima over the earlier rows of the key:
    running gives by name ("max" or "min", column).

    `sliced`: in two levels. A slice is a day of the key's rows; within it the
    value runs by a window of its own, and what the slices before it amount to is
    carried in by a prefix over one row per slice. No task holds a key."""
    folds = {"max": (F.max, F.greatest), "min": (F.min, F.least)}
    earlier = (Window.unboundedPreceding, -1)
    if not sliced:
        window = Window.partitionBy(key).orderBy(*order).rowsBetween(*earlier)
        return rows.select("*", *[folds[kind][0](c).over(window).alias(name)
                                  for name, (kind, c) in running.items()])
    rows = rows.withColumn("_slice", day)
    inside = Window.partitionBy(key, "_slice").orderBy(*order).rowsBetween(*earlier)
    before = Window.partitionBy("_s_key").orderBy("_s_slice").rowsBetween(*earlier)
    slices = rows.groupBy(F.col(key).alias("_s_key"), F.col("_slice").alias("_s_slice")).agg(
        *[folds[kind][0](c).alias(f"_s_{name}") for name, (kind, c) in running.items()])
    carried = slices.select("_s_key", "_s_slice", *[
        folds[kind][0](f"_s_{name}").over(before).alias(f"_s_{name}")
        for name, (kind, _) in running.items()])
    own = rows.select("*", *[folds[kind][0](c).over(inside).alias(f"_o_{name}")
                             for name, (kind, c) in running.items()])
    joined = own.join(carried, (F.col(key) == F.col("_s_key")) & (F.col("_slice") == F.col("_s_slice")))
    kept = [c for c in rows.columns if c != "_slice"]
    return joined.select(*kept, *[folds[kind][1](f"_o_{name}", f"_s_{name}").alias(name)
                                  for name, (kind, _) in running.items()])


def assert_no_scd_overlap(dim: DataFrame, key: str = "customer_id",
                          version: str = "version_id", valid_from: str = "valid_from",
                          valid_to: str = "valid_to", wide_rows: int | None = 10_000) -> DataFrame:
    """Versions of one key whose [valid_from, valid_to] ranges overlap those of
    another version.

    Rows of a key are taken in the order of (valid_from, version). A row whose
    range begins before an earlier row of another version has ended overlaps it,
    and every overlapping pair has a later row; so one running maximum of range
    ends finds every offending version. The result has one row per offending
    row, with the earlier one of the latest end (`a` is the smaller version):
    linear in the dimension, one sort per key, zero rows exactly when no two
    versions overlap.

    Rows of one version do not offend each other: where the row of the latest
    end is of the same version, the latest of the other versions counts. That
    is the greatest "loser" so far, a loser being, at each row of another version
    than the leader's, the one of the two that ends first.

    Keys of more than `wide_rows` rows are swept in slices by the day on which
    ranges begin (see `_over_earlier`), with the same result; it costs a count per
    key. None: every key is swept in its own window.

    NULL keys, versions or starts compare as unknown and a range that ends
    before it begins holds no day: they are left out, which also keeps a large
    NULL group out of one window partition.
    """
    end = F.coalesce(F.col(valid_to), F.lit(OPEN_END).cast("date"))
    ranges = dim.where(F.col(key).isNotNull() & F.col(version).isNotNull()
                       & F.col(valid_from).isNotNull() & (F.col(valid_from) <= end)).select(
        key, F.struct(end.alias("end"), F.col(version).alias("version"),
                      F.col(valid_from).alias("valid_from"),
                      F.col(valid_to).alias("valid_to")).alias("own"))
    if wide_rows is None:
        found = _swept(ranges, key, sliced=False)
    else:
        # at most rows / wide_rows keys
        wide = (ranges.groupBy(F.col(key).alias("_w_key")).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > wide_rows).select("_w_key"))
        same = F.col(key) == F.col("_w_key")
        found = _swept(ranges.join(wide, same, "left_anti"), key, sliced=False).unionByName(
            _swept(ranges.join(wide, same, "left_semi"), key, sliced=True))
    other = F.col("leader").isNotNull() & (F.col("leader.version") != F.col("own.version"))
    found = found.withColumn("hit", F.when(other, F.col("leader")).when(
        F.col("second.version") != F.col("own.version"), F.col("second")).when(
        F.col("low.version") != F.col("own.version"), F.col("low")))
    hits = found.where(F.col("hit").isNotNull() & (F.col("own.valid_from") <= F.col("hit.end")))
    first = F.col("hit.version") < F.col("own.version")

    def pick(name: str, small: bool) -> Column:
        a, b = F.col(f"hit.{name}"), F.col(f"own.{name}")
        return F.when(first, a if small else b).otherwise(b if small else a)

    return hits.select(
        key, pick("version", True).alias("version_a"),
        pick("valid_from", True).alias("a_valid_from"), pick("valid_to", True).alias("a_valid_to"),
        pick("version", False).alias("version_b"),
        pick("valid_from", False).alias("b_valid_from"),
        pick("valid_to", False).alias("b_valid_to"))


def _swept(ranges: DataFrame, key: str, sliced: bool) -> DataFrame:
    """`ranges` with, of the earlier rows of the key: `leader`, the one of the
    latest end, and `second` and `low`, the greatest losers."""
    order, day = ["own.valid_from", "own.version", "own.end"], F.col("own.valid_from")
    led = _over_earlier(ranges, key, day, order, {"leader": ("max", F.col("own"))}, sliced)
    other = F.col("leader").isNotNull() & (F.col("leader.version") != F.col("own.version"))
    led = led.withColumn("loser", F.when(other, F.least("own", "leader")))
    # Of losers that end together both ends of the order by version are kept:
    # one of them is of another version than the row's. NULL is the least value of a
    # struct's field, so rows without a loser are no candidates for the minimum.
    lowest = F.when(F.col("loser").isNotNull(), F.struct(
        -F.datediff(F.col("loser.end"), F.lit("1970-01-01").cast("date")).alias("days"),
        F.col("loser.version").alias("version"), F.col("loser").alias("row")))
    swept = _over_earlier(led, key, day, order, {"second": ("max", F.col("loser")),
                                                 "low": ("min", lowest)}, sliced)
    return swept.withColumn("low", F.col("low.row"))


def paid_negative() -> Column:
    return (F.col("status_clean") == "paid") & (F.col("amount").isNull() | (F.col("amount") < 0))


def assert_paid_non_negative(fact: DataFrame) -> DataFrame:
    return fact.where(paid_negative())


def assert_fact_resolved(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("customer_key").isNull())


# ------------------------------------------------------------ health checks

def daily_counts(df: DataFrame, day: str, day_expr: Column | None = None,
                 fill_calendar: bool = False) -> DataFrame:
    """(day, row_count) for the days that have rows. A day with no rows at
    all is invisible here, as in a GROUP BY over the loaded rows.

    `fill_calendar=True` lists every day between the first and the last one
    seen (as DATE), with 0 for a day that delivered nothing, so a missing
    daily file becomes an anomaly instead of disappearing. The calendar is
    generated from the one-row min/max aggregate: bounded by the day span.
    """
    d = (day_expr if day_expr is not None else F.col(day)).alias(day)
    counts = df.groupBy(d).agg(F.count(F.lit(1)).alias("row_count"))
    if not fill_calendar:
        return counts
    dated = counts.select(F.col(day).cast("date").alias(day), "row_count")
    calendar = (dated.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
                .select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(day)))
    return (calendar.join(dated, day, "left")
            .select(day, F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count")))


def volume_zscore(counts: DataFrame, day: str = "snapshot_date",
                  z_threshold: float = 2.0) -> DataFrame:
    """Leave-one-out z-score of each day's row count against all OTHER days
    (population std). The totals enter as scalar subqueries; the variance
    is computed exactly in decimal, n^2 * var = n(S2 - x^2) - (S1 - x)^2 with
    n = N - 1, so a constant baseline is recognised exactly: then z is 0 for
    an equal day, +999 above and -999 below. With one day there is no
    baseline: z NULL, not an anomaly. Anomaly: |z| > z_threshold.
    """
    dec = "decimal(38,0)"
    x = F.col("row_count").cast(dec)
    totals = counts.agg(F.count(F.lit(1)).alias("N"),
                        F.sum(x).cast(dec).alias("S1"), F.sum(x * x).cast(dec).alias("S2"))
    N = totals.select("N").scalar()
    S1 = totals.select("S1").scalar()
    S2 = totals.select("S2").scalar()
    n = (N - 1).cast(dec)
    rest = S1 - x
    var_n2 = (n * (S2 - x * x) - rest * rest).cast(dec)
    num = (n * x - rest).cast(dec)
    z = (F.when(n == 0, F.lit(None).cast("double"))
          .when(var_n2 == 0, F.when(num == 0, 0.0).when(num > 0, 999.0).otherwise(-999.0))
          .otherwise(num.cast("double") / F.sqrt(var_n2.cast("double"))))
    mean_o = F.when(n > 0, rest.cast("double") / n.cast("double"))
    std_o = F.when(n > 0, F.sqrt(var_n2.cast("double")) / n.cast("double"))
    return counts.select(
        day, F.col("row_count").cast("bigint").alias("row_count"),
        mean_o.alias("mean_others"), std_o.alias("std_others"), z.alias("z_score"),
        F.coalesce(F.abs(z) > F.lit(z_threshold), F.lit(False)).alias("is_anomaly"))


def volume_summary(scored: DataFrame) -> DataFrame:
    """One row: days checked, mean and population std of the daily counts
    (1 decimal), number of anomalies, status ('alert' if any)."""
    dec = "decimal(38,0)"
    x = F.col("row_count").cast(dec)
    agg = scored.agg(F.count(F.lit(1)).alias("N"), F.sum(x).cast(dec).alias("S1"),
                     F.sum(x * x).cast(dec).alias("S2"),
                     F.count_if("is_anomaly").alias("n_anomalies"))
    var_n2 = (F.col("N") * F.col("S2") - F.col("S1") * F.col("S1")).cast(dec)
    mean = F.when(F.col("N") > 0, half_up_div(F.col("S1"), F.col("N"), 1)).otherwise(0.0)
    std = F.when(F.col("N") > 0,
                 F.round(F.sqrt(var_n2.cast("double")) / F.col("N").cast("double"), 1)).otherwise(0.0)
    return agg.select(
        F.col("N").cast("bigint").alias("n_days_checked"), mean.alias("mean_count"),
        std.alias("std_count"), F.col("n_anomalies").cast("bigint").alias("n_anomalies"),
        F.when(F.col("n_anomalies") > 0, "alert").otherwise("ok").alias("volume_status"))


def quarantine_rate(total: Column, quarantined: Column, warn_threshold: float = 0.05) -> list[Column]:
    """Columns of the quarantine-rate report. rate = quarantined / total
    (0 when total is 0), reported to 4 decimals (half-up, exact); 'warn'
    when the unrounded rate exceeds the threshold."""
    rate = F.when(total > 0, half_up_div(quarantined, total, 4)).otherwise(0.0)
    warn = quarantined.cast("double") > F.lit(warn_threshold) * total.cast("double")
    return [total.cast("bigint").alias("total_rows"),
            quarantined.cast("bigint").alias("quarantined_rows"),
            rate.alias("quarantine_rate"),
            F.when(warn & (total > 0), "warn").otherwise("ok").alias("rate_status")]


def quarantine_rate_report(fact: DataFrame, rejected: DataFrame,
                           warn_threshold: float = 0.05) -> DataFrame:
    """Resolved + rejected invoices against rejected ones: one row."""
    q = rejected.agg(F.count(F.lit(1)).alias("q"))
    resolved = fact.select(F.count(F.lit(1))).scalar()
    return q.select(*quarantine_rate(resolved + F.col("q"), F.col("q"), warn_threshold))


def resolved_quarantine_rate(resolved: DataFrame, key: str = "customer_key",
                             warn_threshold: float = 0.05) -> DataFrame:
    """The same row from resolved facts in which rejected ones have no key: one
    aggregate over one resolution."""
    counts = resolved.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("q"))
    return counts.select(*quarantine_rate(F.col("n"), F.col("q"), warn_threshold))


def health_report(snapshots_raw: DataFrame, fact: DataFrame, rejected: DataFrame,
                  z_threshold: float = 2.0, warn_threshold: float = 0.05,
                  day: str = "snapshot_date") -> DataFrame:
    """Volume check on the raw snapshot rows + quarantine rate: one flat row,
    `overall_status` 'alert' if either check fires."""
    return rated_health_report(snapshots_raw, quarantine_rate_report(fact, rejected, warn_threshold),
                               z_threshold, day)


def rated_health_report(snapshots_raw: DataFrame, rate: DataFrame, z_threshold: float = 2.0,
                        day: str = "snapshot_date") -> DataFrame:
    """`health_report` with the quarantine rate as a row of its own."""
    return _flat_report(volume_zscore(daily_counts(snapshots_raw, day), day, z_threshold), rate)


def _flat_report(scored: DataFrame, rate: DataFrame) -> DataFrame:
    row = _one_row_concat(volume_summary(scored), rate)
    overall = F.when((F.col("volume_status") == "alert") | (F.col("rate_status") == "warn"),
                     "alert").otherwise("ok")
    return row.select("*", overall.alias("overall_status"))


def _one_row_concat(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side by side concatenation of two one-row frames without a join or
    per-column subqueries: union them (missing columns NULL) and fold the two
    rows with one global aggregate; each column is non-NULL on one side only,
    so `max` just picks it. Each input is computed once."""
    cols = a.columns + [c for c in b.columns if c not in a.columns]
    both = a.unionByName(b, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in cols])


def health_report_nested(snapshots_raw: DataFrame, fact: DataFrame, rejected: DataFrame,
                         z_threshold: float = 2.0, warn_threshold: float = 0.05,
                         day: str = "snapshot_date", fill_calendar: bool = False) -> DataFrame:
    """The report shaped for the JSON sink: two sections, anomalies listed
    (one entry per anomalous day: bounded by the calendar). `fill_calendar`:
    see `daily_counts`; a day is then taken as a date."""
    return rated_health_report_nested(
        snapshots_raw, quarantine_rate_report(fact, rejected, warn_threshold), z_threshold, day,
        fill_calendar)


def rated_health_report_nested(snapshots_raw: DataFrame, rate: DataFrame, z_threshold: float = 2.0,
                               day: str = "snapshot_date", fill_calendar: bool = False) -> DataFrame:
    """`health_report_nested` with the quarantine rate as a row of its own."""
    counts = daily_counts(snapshots_raw, day, F.col(day).cast("date") if fill_calendar else None,
                          fill_calendar)
    scored = volume_zscore(counts, day, z_threshold)
    anomalies = (scored.where("is_anomaly")
                 .agg(F.sort_array(F.collect_list(F.struct(
                     F.col(day).cast("string").alias("date"),
                     F.col("row_count").alias("count"),
                     F.round("z_score", 2).alias("z_score")))).alias("anomalies")))
    flat = _flat_report(scored, rate)
    return flat.select(
        F.struct(F.col("n_days_checked"), F.col("mean_count"), F.col("std_count"),
                 F.coalesce(anomalies.select("anomalies").scalar(),
                            F.array().cast(anomalies.schema["anomalies"].dataType)).alias("anomalies"),
                 F.col("volume_status").alias("status")).alias("crm_snapshot_volume"),
        F.struct(F.col("total_rows"), F.col("quarantined_rows"), F.col("quarantine_rate"),
                 F.col("rate_status").alias("status")).alias("invoice_quarantine_rate"),
        F.col("overall_status"))
