"""Keep one row per key, chosen by a total order.

`row_number() = 1` over the key. Catalyst rewrites the filter into a
WindowGroupLimit that runs once before the shuffle (each map task sends at
most one row per key) and once after it, so a key repeated millions of times
costs one row per map task in the exchange, not millions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, keys: list[str], order: list[str | Column] | None = None,
                rank_col: str = "_dedup_rank") -> DataFrame:
    """First row per `keys` in `order`: column names sort ascending with
    NULLs first, Column entries as given (e.g. `F.col(c).desc()`).

    `order` defaults to every other column, which makes the survivor
    independent of input order: rows that tie on all columns are identical.
    """
    order = order if order is not None else [c for c in df.columns if c not in keys]
    spec = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*keys).orderBy(*spec)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) == 1)
              .drop(rank_col))
