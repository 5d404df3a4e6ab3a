"""Numeric and text expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def logistic(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def round_half_even(c: Column, digits: int = 2) -> Column:
    """Binary half-even rounding of a double (0.125 gives 0.12)."""
    scale = float(10 ** digits)
    return F.rint(c * scale) / scale


def clean_pow(base: Column, exponent: float) -> Column:
    """Power with NULL instead of NaN, e.g. for the cube root of a negative number."""
    p = F.pow(base, F.lit(exponent))
    return F.when(~F.isnan(p), p)


def cap(c: Column, limit: float) -> Column:
    return F.when(c > limit, F.lit(limit)).otherwise(c)


def to_number(c: Column) -> Column:
    """Double from text; unreadable text and NaN give NULL."""
    n = c.try_cast("double")
    return F.when(~F.isnan(n), n)


def nan_to_null(df: DataFrame) -> DataFrame:
    """The library knows one missing value, NULL."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in floats}) if floats else df


def fill_number(c: Column, value: float) -> Column:
    """Cast to double and fill what is missing."""
    n = c.cast("double")
    return F.when(n.isNull() | F.isnan(n), F.lit(float(value))).otherwise(n)


def replace_infinite(c: Column, value: float) -> Column:
    return F.when(F.abs(c) == float("inf"), F.lit(float(value))).otherwise(c)


def fill_text(c: Column, value: str = "Unknown", missing: str = "None") -> Column:
    return F.when(c.isNull() | (c == missing), F.lit(value)).otherwise(c)


def right_closed_bin(c: Column, edges: Sequence[float]) -> Column:
    """Index of the interval (edges[i], edges[i+1]] holding the value; NULL outside."""
    expr = None
    for i in range(len(edges) - 1):
        inside = (c > edges[i]) & (c <= edges[i + 1])
        expr = F.when(inside, F.lit(i)) if expr is None else expr.when(inside, F.lit(i))
    return expr


def rolling_mean(c: Column, n: int, order: Column, *partition: str) -> Column:
    """Mean of the last `n` rows; NULL until all `n` are there and none is NULL.

    Without `partition` the whole frame is one window, so keep it to monthly series.
    """
    spec = Window.partitionBy(*partition) if partition else Window.partitionBy(F.lit(0))
    spec = spec.orderBy(order).rowsBetween(-(n - 1), 0)
    return F.when(F.count(c).over(spec) == n, F.avg(c).over(spec))


def min_max_scale(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Scale each column to [0, 1] by the frame's own range; a constant column becomes 0."""
    columns = list(columns)
    ranges = [F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(columns)]
    ranges += [F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(columns)]
    bounds = df.agg(*ranges).select(F.struct("*").alias("r")).scalar()
    scaled = {}
    for i, c in enumerate(columns):
        lo, hi = bounds.getField(f"lo{i}"), bounds.getField(f"hi{i}")
        x = F.col(c).cast("double")
        scaled[c] = F.when(hi > lo, (x - lo) / (hi - lo)).otherwise(x - lo)
    return df.withColumns(scaled)
