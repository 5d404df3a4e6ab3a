"""Row picking, flag preference and ordered totals that stay whole and balanced under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.session import materialise


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1,
                  rank_col: str | None = None) -> DataFrame:
    """The first `n` rows of each key.

    Spark turns `row_number() <= n` into a limit per map task before the shuffle, so a key with very
    many rows sends at most `n` rows per task.
    """
    name = rank_col or "__rank"
    spec = Window.partitionBy(*keys).orderBy(*order)
    picked = df.withColumn(name, F.row_number().over(spec)).filter(F.col(name) <= n)
    return picked if rank_col else picked.drop(name)


def latest_with_ties(df: DataFrame, key: str, date: str) -> DataFrame:
    """All rows carrying the latest date of their key."""
    spec = Window.partitionBy(key).orderBy(F.col(date).desc())
    return df.filter(F.col(date).isNotNull()).withColumn("__rank", F.rank().over(spec)).filter("__rank = 1").drop("__rank")


def attach(df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join an aggregate with one row per key back to rows of which one key may hold very many.

    AQE splits a hot key only where both join inputs come straight from a shuffle, which an aggregate
    on the join keys does not. Written first, the aggregate is a plain scan: the planner knows its size,
    broadcasts it if that is small, and else can split the hot key on the left.
    """
    return df.join(materialise(per_key, "per-key"), list(keys), how)


def prefer_flagged(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Where a key has a row with `flag` = 1, keep only its flagged rows; keep other keys whole.

    The flagged keys are aggregated, combining on the map side, and attached; a window over the key
    would hold a hot key in one task. `df` is read twice, the first time for the keys and the flag only;
    materialise a costly one before. A NULL key matches nothing and is kept.
    """
    flagged = df.filter(F.col(flag) == 1).select(*keys).distinct().withColumn("__flagged", F.lit(True))
    keep = F.col("__flagged").isNull() | F.coalesce(F.col(flag) == 1, F.lit(False))
    return attach(df, flagged, keys).filter(keep).drop("__flagged").select(*df.columns)


def running_totals(df: DataFrame, order: Sequence[str], values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Running sums `cum_<value>` and sums `total_<value>` over an order, of all rows or within groups `by`.

    A distributed prefix sum: rows are dealt to ranges of the whole key, groups and order, sized by the data, and
    written once. The sums of each range, a row a group and range, become offsets and totals, and a window runs
    inside each (group, range). So a hot group, or a hot value of the first order column, is many tasks, and `df` is
    computed once. Rows with equal keys are in one range and take their places in any order; a NULL group is a
    group.
    """
    keys = [F.col(c) for c in (*by, *order)]
    ranged = materialise(df.repartitionByRange(*keys).withColumn("__range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy(*by, "__range").agg(*[F.sum(v).alias(f"__sum_{v}") for v in values])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(c).alias(f"__by_{c}") for c in by], F.col("__range").alias("__of"),
        *[F.coalesce(F.sum(f"__sum_{v}").over(before), F.lit(0)).alias(f"__off_{v}") for v in values],
        *[F.sum(f"__sum_{v}").over(group).alias(f"total_{v}") for v in values])
    offsets = materialise(offsets, "range-offsets")
    same = F.col("__range") == F.col("__of")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    inside = Window.partitionBy(*by, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # The window before the join: it needs no columns of the offsets.
    within = ranged.withColumns({f"cum_{v}": F.sum(v).over(inside) for v in values})
    cums = {f"cum_{v}": F.col(f"cum_{v}") + F.col(f"__off_{v}") for v in values}
    return within.join(offsets, same).withColumns(cums).drop("__range", "__of", *[f"__by_{c}" for c in by], *[f"__off_{v}" for v in values])
