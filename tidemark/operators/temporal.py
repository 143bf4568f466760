"""Join facts to the dimension version valid on the fact's date.

The predicate: same key, fact date in the closed range [valid_from, valid_to],
open end NULL. `temporal_join` resolves it per (key, date), not per fact:

* the facts' distinct (key, date) pairs are taken first (a partial aggregate,
  so a key with millions of facts is at most one row per day);
* pairs and versions of a key are sorted by date in one window, which carries
  the latest version that has begun; a pair is resolved if that version has not
  ended. The window holds a key's days and versions, never its facts, and no
  version is expanded or paired with what it does not cover;
* the facts meet their resolved pairs by (key, date), so a key that holds a third
  of all facts is spread over its days, and AQE splits a single hot day.

This needs ranges that do not overlap within a key, which is what
`close_ranges` builds. For other dimensions `exclusive=False` gives the plain
range join.

Rows with a NULL key or date match nothing. They take no part in any shuffle:
they are set aside and put back with NULL dimension columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Why a fact was not resolved.
ORPHAN, UNCOVERED = "orphan_customer_id", "invoice_predates_scd_coverage"

_K, _D, _V, _P = "_tj_key", "_tj_day", "_tj_version", "_tj_is_pair"


def temporal_join(facts: DataFrame, dim: DataFrame, key: str, fact_date: str,
                  dim_cols: list[str], how: str = "left",
                  valid_from: str = "valid_from", valid_to: str = "valid_to",
                  exclusive: bool = True, known: str | None = None) -> DataFrame:
    """facts ⋈ dim on key and fact_date within [valid_from, valid_to].

    `how` is "left" (unmatched facts kept, dim columns NULL) or "inner".
    `exclusive`: the ranges of a key do not overlap (see above).
    `known` (left, exclusive): a boolean column of this name says whether the
    fact's key is in any row of `dim`. The window that resolves the pairs has seen
    all rows of the key, so this takes no join of its own.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    if known is not None:
        if how != "left" or not exclusive:
            raise ValueError("known needs a left join with exclusive ranges")
        keyed = facts.where(F.col(key).isNotNull())
        joined = _by_day(keyed, dim, key, fact_date, dim_cols, how, valid_from, valid_to, known)
        types = dict(joined.dtypes)
        aside = facts.where(F.col(key).isNull()).select(
            *facts.columns, *[F.lit(None).cast(types[c]).alias(c) for c in dim_cols],
            F.lit(False).alias(known))
        return joined.unionByName(aside)
    matchable = F.col(key).isNotNull() & F.col(fact_date).isNotNull()
    keyed = facts.where(matchable)
    match = _by_day if exclusive else _by_range
    joined = match(keyed, dim, key, fact_date, dim_cols, how, valid_from, valid_to)
    if how == "inner":
        return joined
    types = dict(dim.dtypes)
    aside = facts.where(~matchable).select(
        *facts.columns, *[F.lit(None).cast(types[c]).alias(c) for c in dim_cols])
    return joined.unionByName(aside)


def _by_day(facts, dim, key, fact_date, dim_cols, how, valid_from, valid_to,
            known=None) -> DataFrame:
    day_type = dict(facts.dtypes)[fact_date]
    body = F.struct(F.col(valid_to).alias("_end"), *dim_cols)
    begins = F.lit(True) if known else F.col(valid_from).isNotNull()
    versions = dim.where(F.col(key).isNotNull() & begins).select(
        F.col(key).alias(_K), F.col(valid_from).cast(day_type).alias(_D), body.alias(_V),
        F.lit(False).alias(_P))
    pairs = facts.select(F.col(key).alias(_K), F.col(fact_date).alias(_D)).distinct().select(
        _K, _D, F.lit(None).cast(versions.schema[_V].dataType).alias(_V), F.lit(True).alias(_P))
    # Of versions that begin on one day all but the last have ended before it.
    order = Window.partitionBy(_K).orderBy(
        _D, _P, F.col(f"{_V}._end").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    if known:
        return _with_known(facts, versions, pairs, order, key, fact_date, dim_cols, known)
    begun = versions.unionByName(pairs).withColumn(
        _V, F.last(_V, ignorenulls=True).over(order))
    end = F.col(f"{_V}._end")
    resolved = begun.where(F.col(_P) & F.col(_V).isNotNull()
                           & (end.isNull() | (F.col(_D) <= end))).drop(_P)
    joined = facts.join(
        resolved, (F.col(key) == F.col(_K)) & (F.col(fact_date) == F.col(_D)), how)
    return joined.select(*[facts[c] for c in facts.columns],
                         *[F.col(f"{_V}.{c}").alias(c) for c in dim_cols])


def _with_known(facts, versions, pairs, order, key, fact_date, dim_cols, known) -> DataFrame:
    """`_by_day` with all pairs kept: a version without a start, or a fact without
    a date, resolves nothing but counts as (or asks for) its key."""
    whole_key = Window.partitionBy(_K)
    own = F.when(F.col(_D).isNotNull(), F.col(_V))
    begun = versions.unionByName(pairs).withColumn(
        known, F.max(~F.col(_P)).over(whole_key)).withColumn(
        _V, F.last(own, ignorenulls=True).over(order))
    end = F.col(f"{_V}._end")
    covers = F.col(_D).isNotNull() & (end.isNull() | (F.col(_D) <= end))
    asked = begun.where(F.col(_P)).select(_K, _D, F.when(covers, F.col(_V)).alias(_V), known)
    joined = facts.join(
        asked, (F.col(key) == F.col(_K)) & F.col(fact_date).eqNullSafe(F.col(_D)), "left")
    return joined.select(*[facts[c] for c in facts.columns],
                         *[F.col(f"{_V}.{c}").alias(c) for c in dim_cols], known)


def _by_range(facts, dim, key, fact_date, dim_cols, how, valid_from, valid_to) -> DataFrame:
    d = dim.select(F.col(key).alias(_K), F.col(valid_from).alias(_D),
                   F.col(valid_to).alias("_tj_end"), *dim_cols)
    covers = ((F.col(key) == F.col(_K)) & (F.col(fact_date) >= F.col(_D))
              & (F.col("_tj_end").isNull() | (F.col(fact_date) <= F.col("_tj_end"))))
    return facts.join(d, covers, how).drop(_K, _D, "_tj_end")


def classify_unresolved(unresolved: DataFrame, dim: DataFrame, key: str,
                        reason_col: str = "rejection_reason",
                        unknown: str = ORPHAN, uncovered: str = UNCOVERED) -> DataFrame:
    """Reason for each fact the temporal join could not resolve: its key is
    in no version at all (NULL keys included), or it is, but no version
    covers the fact's date.

    `dim` only supplies the set of known keys: the dimension itself, or the
    snapshots it was built from (the same set of keys). Rows with a NULL key
    need no lookup and are not shuffled."""
    known = (dim.select(F.col(key).alias("_known_key")).where(F.col("_known_key").isNotNull())
             .distinct())
    keyed = unresolved.where(F.col(key).isNotNull())
    reason = F.when(F.col("_known_key").isNull(), F.lit(unknown)).otherwise(F.lit(uncovered))
    looked_up = keyed.join(known, F.col(key) == F.col("_known_key"), "left").select(
        *unresolved.columns, reason.alias(reason_col))
    return looked_up.unionByName(unresolved.where(F.col(key).isNull()).withColumn(
        reason_col, F.lit(unknown)))
