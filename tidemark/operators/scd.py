"""Daily snapshots -> Type 2 slowly changing dimension (gaps and islands).

Plan shape: exact copies of a snapshot row are collapsed first (a `distinct`,
aggregated map-side before its shuffle). Then the rows are shuffled once, by
key: the three `lag`s, the running sum, the island `groupBy` and the `lead` that
closes ranges all need clustering by key only, so Catalyst reuses that exchange
through the whole chain (two sorts: by day, then by version).

Rows without a key belong to the record that their identity (carried) columns
name: the identity itself is part of the window key for them, so every record
is versioned alone, whatever their number.

After the collapse a key holds its snapshot days. A placeholder id shared by
many records holds many rows a day; with `wide_rows` such keys (more rows than
that on one day) take a second path with the same result, in which no task
holds a key: rows are numbered within (key, day), days are chained by their
first and last rows (one row per day of a key), and a prefix sum over days joins
back to the rows.

Rows of one key and day follow in the order of all their attributes, so versions
do not depend on the input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of, surrogate_key

IDENTITY = "_record_identity"
WIDE = "_wide_key"


def record_identity(key: str, attrs: list[str]) -> Column:
    """NULL for a real key; for a NULL key the record's identity columns."""
    named = F.struct(*[F.col(c) for c in attrs]) if attrs else F.struct(F.lit(0).alias("none"))
    return F.when(F.col(key).isNull(), named)


def _opens(tracked: list[str], prev: dict[str, Column], first: Column, null_safe: bool) -> Column:
    """1 where a row opens a version, given the row before it."""
    if null_safe:
        changed = any_of([~F.col(c).eqNullSafe(prev[c]) for c in tracked])
        return F.when(first, 1).when(changed, 1).otherwise(0)
    return F.when(prev[tracked[0]].isNull(), 1).when(
        any_of([F.col(c) != prev[c] for c in tracked]), 1).otherwise(0)


def _numbered(rows: DataFrame, parts: list[str], attrs: list[str], tracked: list[str], day: str,
              null_safe: bool) -> DataFrame:
    """`rows` with version_id: one window per key."""
    w = Window.partitionBy(*parts).orderBy(day, *attrs)
    prev = {c: F.lag(c).over(w) for c in tracked}
    flagged = rows.withColumn("_opens", _opens(tracked, prev, F.row_number().over(w) == 1,
                                               null_safe))
    running = F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return flagged.withColumn("version_id", running.cast("bigint")).drop("_opens")


def _numbered_by_day(rows: DataFrame, parts: list[str], attrs: list[str], tracked: list[str],
                     day: str, null_safe: bool) -> DataFrame:
    """The same in two levels: within (key, day), then over the days of a key."""
    w = Window.partitionBy(*parts, day).orderBy(*attrs)
    prev = {c: F.lag(c).over(w) for c in tracked}
    number = F.row_number().over(w)
    inner = rows.withColumn("_number", number).withColumn(
        "_opens", F.when(number == 1, 0).otherwise(
            _opens(tracked, prev, F.lit(False), null_safe)))
    whole = F.struct(*attrs)
    days = inner.groupBy(*parts, day).agg(
        F.min(whole).alias("_first"), F.max(whole).alias("_last"), F.sum("_opens").alias("_inner"))
    over_days = Window.partitionBy(*parts).orderBy(day)
    before = F.lag("_last").over(over_days)
    first = days.withColumn("_before", before).withColumn(
        "_day_number", F.row_number().over(over_days)).select(
        *parts, day, "_inner", "_before", "_day_number", "_first.*")
    opened = first.withColumn("_first_opens", _opens(
        tracked, {c: F.col(f"_before.{c}") for c in tracked}, F.col("_day_number") == 1,
        null_safe))
    total = F.sum(F.col("_first_opens") + F.col("_inner")).over(
        over_days.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    base = opened.select(
        *[F.col(p).alias(f"_b_{p}") for p in parts], F.col(day).alias("_b_day"),
        (total - F.col("_inner")).alias("_base"))
    same = [F.col(p).eqNullSafe(F.col(f"_b_{p}")) for p in parts]
    joined = inner.join(base, [*same, F.col(day).eqNullSafe(F.col("_b_day"))])
    running = F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return joined.withColumn("version_id", (F.col("_base") + running).cast("bigint")).select(
        *rows.columns, "version_id")


def snapshot_versions(snapshots: DataFrame, key: str, tracked: list[str],
                      carried: list[str] | None = None, day: str = "snapshot_date",
                      null_safe: bool = False, collapse_copies: bool = True,
                      wide_rows: int | None = None, keep_helpers: bool = False) -> DataFrame:
    """One row per island of unchanged tracked attributes.

    Output: key, attributes (input order), version_id, valid_from, last_seen_date.

    Default rules (as the reference pipeline defines them):
    * a row opens a version when the lag of the FIRST tracked column is NULL
      (first observation, or that column was NULL the day before), or when any
      tracked column differs from the day before under SQL `!=` (a change to
      or from NULL in another column compares as unknown, i.e. no change);
    * the island is grouped by key, every tracked and carried column and the
      version number, so a carried change or a NULL-only change splits a row
      off that keeps the same version number;
    * days missing inside an island are bridged; A -> B -> A gives 3 versions.

    `null_safe=True` instead compares with `<=>`, opens a version only on the
    key's first row or a real change, and takes carried columns as of the
    version's last day, so (key, version) is unique.

    `collapse_copies` (default) drops exact duplicate rows before the window
    chain. Copies never change the versions, except where the first tracked
    column is NULL: there each copy would open one more, empty, version. Turn it
    off only for extracts known to hold one row per key and day; it saves one
    shuffle of the snapshots.

    `wide_rows`: keys with more rows than this on one day are numbered in two
    levels (see above); it costs one count per (key, day). None: every key is
    numbered in its own window, which spills when it is large.

    `keep_helpers=True` keeps the record identity and the flag of such keys for
    `close_ranges`, so that the whole chain runs on the one exchange.
    """
    carried = list(carried or [])
    attrs = [c for c in snapshots.columns if c in set(tracked) | set(carried)]
    if collapse_copies:
        snapshots = snapshots.select(key, *attrs, day).distinct()
    identity = [c for c in attrs if c in carried] or attrs
    rows = snapshots.select(key, *attrs, day, record_identity(key, identity).alias(IDENTITY))
    parts = [key, IDENTITY]
    if wide_rows is None:
        grouped = _numbered(rows, parts, attrs, tracked, day, null_safe).withColumn(
            WIDE, F.lit(False))
    else:
        crowded = (rows.groupBy(*parts, day).agg(F.count(F.lit(1)).alias("_n"))
                   .where(F.col("_n") > wide_rows).select(
                       F.col(key).alias("_w_key"), F.col(IDENTITY).alias("_w_identity"))
                   .distinct())
        same = (F.col(key).eqNullSafe(F.col("_w_key"))
                & F.col(IDENTITY).eqNullSafe(F.col("_w_identity")))
        grouped = _numbered(rows.join(crowded, same, "left_anti"), parts, attrs, tracked, day,
                            null_safe).withColumn(WIDE, F.lit(False)).unionByName(
            _numbered_by_day(rows.join(crowded, same, "left_semi"), parts, attrs, tracked, day,
                             null_safe).withColumn(WIDE, F.lit(True)))
    extra = [IDENTITY, WIDE] if keep_helpers else []
    islands = [key, IDENTITY, WIDE]
    span = [F.min(day).alias("valid_from"), F.max(day).alias("last_seen_date")]
    if not null_safe or not carried:
        by = attrs if not null_safe else [c for c in attrs if c in tracked]
        return grouped.groupBy(*islands, *by, "version_id").agg(*span).select(
            key, *by, "version_id", "valid_from", "last_seen_date", *extra)
    # Of several rows on the last day the greatest, so that it is the same one
    # whatever the input order.
    latest = F.max(F.struct(F.col(day).alias("_day"), *carried)).alias("_carried")
    out = grouped.groupBy(*islands, *[c for c in attrs if c in tracked], "version_id").agg(
        *span, latest)
    cols = [F.col(f"_carried.{c}").alias(c) if c in carried else F.col(c) for c in attrs]
    return out.select(key, *cols, "version_id", "valid_from", "last_seen_date", *extra)


def last_rows(islands: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """(key, identity, `_last`): of each key the last day seen, the last row of
    that day in the order of all attributes, and its version."""
    return islands.groupBy(key, IDENTITY).agg(F.max(F.struct(
        F.col("last_seen_date").alias("day"), F.struct(*attrs).alias("row"),
        F.col("version_id").alias("version"))).alias("_last"))


def merge_snapshots(islands: DataFrame, snapshots: DataFrame, key: str, tracked: list[str],
                    carried: list[str], day: str = "snapshot_date") -> DataFrame:
    """The islands of `snapshot_versions` (default rules, helper columns kept)
    after more snapshot days, from the islands before them instead of all history.

    Every new day of a key must lie behind the last day of that key (see
    `late_keys`). `islands` may be those of each key's last version alone: no other
    can grow. The last row of a key stands before its new rows, so a change is seen
    as in the full chain, and version numbers go on from its version. An island that
    goes on is joined with its new days by key, attributes and version.

    Adds `is_open`: whether the island is of its key's last version."""
    attrs = [c for c in snapshots.columns if c in set(tracked) | set(carried)]
    identity = [c for c in attrs if c in carried] or attrs
    new = snapshots.select(key, *attrs, day).distinct().withColumn(
        IDENTITY, record_identity(key, identity))
    state = islands.select(key, IDENTITY, *attrs, "version_id", "valid_from", "last_seen_date")
    last = last_rows(state, key, attrs).select(
        key, IDENTITY, "_last.row.*", F.col("_last.day").alias(day), F.col("_last.version").alias("_base"))
    rows = new.withColumn("_base", F.lit(None).cast("bigint")).unionByName(last)
    of_key = Window.partitionBy(key, IDENTITY)
    w = of_key.orderBy(day, *attrs)
    prev = {c: F.lag(c).over(w) for c in tracked}
    opens = F.when(F.col("_base").isNotNull(), 0).otherwise(
        _opens(tracked, prev, F.row_number().over(w) == 1, False))
    running = F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = (rows.withColumn("_opens", opens)
                .withColumn("version_id", (F.coalesce(F.max("_base").over(of_key), F.lit(0))
                                           + running).cast("bigint"))
                .where(F.col("_base").isNull())
                .select(key, IDENTITY, *attrs, "version_id", F.col(day).alias("valid_from"),
                        F.col(day).alias("last_seen_date")))
    merged = state.unionByName(numbered).groupBy(key, IDENTITY, *attrs, "version_id").agg(
        F.min("valid_from").alias("valid_from"), F.max("last_seen_date").alias("last_seen_date"))
    return merged.withColumn("is_open", F.col("version_id") == F.max("version_id").over(of_key))


def late_keys(islands: DataFrame, snapshots: DataFrame, key: str, tracked: list[str],
              carried: list[str], day: str = "snapshot_date") -> DataFrame:
    """(key, identity) of the keys that have a new row on or before their last
    day: their versions have to be built again from all their snapshots."""
    attrs = [c for c in snapshots.columns if c in set(tracked) | set(carried)]
    identity = [c for c in attrs if c in carried] or attrs
    first = snapshots.select(key, record_identity(key, identity).alias(IDENTITY), day).groupBy(
        key, IDENTITY).agg(F.min(day).alias("_first"))
    seen = islands.groupBy(F.col(key).alias("_k"), F.col(IDENTITY).alias("_i")).agg(
        F.max("last_seen_date").alias("_seen"))
    return first.join(seen, F.col(key).eqNullSafe(F.col("_k")) & F.col(IDENTITY).eqNullSafe(F.col("_i"))
                      ).where(F.col("_first") <= F.col("_seen")).select(key, IDENTITY)


def close_ranges(history: DataFrame, key: str, version: str = "version_id",
                 valid_from: str = "valid_from", key_name: str = "customer_key",
                 drop: tuple[str, ...] = ("last_seen_date",),
                 identity: str | None = None, wide: str | None = None) -> DataFrame:
    """Add the surrogate key, `valid_to` (next valid_from - 1 day, NULL when
    open) and `is_current` (no next version). A key that stops appearing in
    the snapshots keeps an open, current last version.

    `identity`, `wide`: the helper columns kept by `snapshot_versions`. Ranges
    are closed within (key, identity). The rows flagged `wide` are closed in
    two levels: within one day, the next row begins on that day too; the last
    row of a day ends before the next day on which a row of the key begins."""
    parts = [key] + ([identity] if identity else [])
    body = [c for c in history.columns if c not in (*drop, identity, wide)]
    tie = [c for c in body if c not in (key, version, valid_from)]
    w = Window.partitionBy(*parts).orderBy(version, valid_from, *tie)
    usual = history if wide is None else history.where(~F.col(wide))
    closed = usual.withColumn("_next", F.lead(valid_from).over(w))
    if wide is not None:
        crowded = history.where(F.col(wide))
        on_day = Window.partitionBy(*parts, valid_from).orderBy(version, *tie)
        days = crowded.select(*parts, valid_from).distinct().withColumn(
            "_next_day", F.lead(valid_from).over(Window.partitionBy(*parts).orderBy(valid_from)))
        days = days.select(*[F.col(p).alias(f"_d_{p}") for p in parts],
                           F.col(valid_from).alias("_d_from"), "_next_day")
        same = [F.col(p).eqNullSafe(F.col(f"_d_{p}")) for p in parts]
        in_day = crowded.withColumn("_on_day", F.lead(valid_from).over(on_day)).join(
            days, [*same, F.col(valid_from) == F.col("_d_from")])
        closed = closed.unionByName(in_day.withColumn(
            "_next", F.coalesce("_on_day", "_next_day")).select(*history.columns, "_next"))
    return closed.select(
        surrogate_key(key, version).alias(key_name),
        *body,
        F.date_sub("_next", 1).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def change_summary(scd: DataFrame, snapshots: DataFrame, key: str,
                   day: str = "snapshot_date") -> DataFrame:
    """versions, keys, keys that changed at least once, and the change rate
    per key-day: (versions - keys) / ((days - 1) * keys)."""
    per_key = scd.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.sum("n").cast("bigint").alias("versions"),
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("n") > 1).alias("customers_changed"))
    n_days = snapshots.select(F.count_distinct(day)).scalar()
    changes = F.col("versions") - F.col("customers")
    denom = (n_days - 1) * F.col("customers")
    return totals.select(
        "versions", "customers", "customers_changed",
        n_days.cast("bigint").alias("snapshot_days"),
        (changes.cast("double") / F.nullif(denom, F.lit(0)).cast("double")).alias("change_rate"))
