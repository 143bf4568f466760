"""Column expressions shared by the models (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"   # fixed value: sentinel for an open valid_to


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_decimal(c: str | Column, precision: int = 10, scale: int = 2) -> Column:
    """Text or number -> decimal; malformed, empty or overflowing -> NULL."""
    return col(c).cast("string").try_cast(f"decimal({precision},{scale})")


def is_bad_amount(c: str | Column) -> Column:
    """NULL or negative. NULL-safe: the first arm settles NULL."""
    c = col(c)
    return F.when(c.isNull() | (c < 0), True).otherwise(False)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def surrogate_key(key: str | Column, version: str | Column) -> Column:
    """`key || '-' || version`; NULL if either part is NULL (like `||`)."""
    return F.concat(col(key).cast("string"), F.lit("-"), col(version).cast("string"))


def month_start(c: str | Column) -> Column:
    return F.date_trunc("month", col(c)).cast("date")


def day_of_week_sunday0(c: str | Column) -> Column:
    """0 = Sunday ... 6 = Saturday (Spark's dayofweek has Sunday = 1)."""
    return (F.dayofweek(col(c)) - 1).cast("bigint")


def half_up_div(numerator: Column, denominator: Column, digits: int) -> Column:
    """Round numerator/denominator half-up to `digits` decimals, exactly.

    Integer arithmetic, so the result does not depend on how a double
    quotient happens to be represented. Expects numerator >= 0 and
    denominator > 0 (NULL for a zero denominator).
    """
    scale = 10 ** digits
    n = (numerator * scale).cast("decimal(38,0)")
    d = F.nullif(denominator.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    a, b = n * 2 + d, d * 2
    units = ((a - a % b) / b).cast("decimal(38,0)")   # exact floor division
    return units.cast("double") / F.lit(float(scale))
