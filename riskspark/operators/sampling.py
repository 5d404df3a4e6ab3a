"""Train, test and validation split; class balancing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.dates import year_month
from riskspark.operators.keyed import attach, first_per_key, running_totals
from riskspark.operators.outcomes import hash_number

ORDER = ("AccountNumber", "MOB", "SnapshotDate")
COPIES_PER_MONTH = 170


def split_by_positive_share(df: DataFrame, label: str = "Ever90_12M", shares: Sequence[float] = (0.7, 0.85),
                            order: Sequence[str] = ORDER, names: Sequence[str] = ("train", "test", "validation")) -> DataFrame:
    """Cut the ordered rows where the positives reach each share; the row reaching it opens the next part.

    Only the positives are accumulated, one row per distinct `order`, and every row is then compared
    with the cut keys. Rows with equal `order` stay together.
    """
    per_key = df.filter(F.col(label) == 1).groupBy(*order).agg(F.count("*").alias("n"))
    cums = running_totals(per_key, list(order), ["n"])
    # Half-even, so that the row reaching the rounded count is the one the share names.
    targets = [F.rint(F.col("total_n") * F.lit(s)) for s in shares]
    key = F.struct(*order)
    reached = [F.min(F.when((F.col("cum_n") >= t) & (t > 0), key)).alias(f"cut{i}") for i, t in enumerate(targets)]
    cuts = cums.agg(*reached).select(F.struct("*")).scalar()
    part = F.lit(names[-1])
    for i in reversed(range(len(shares))):
        part = F.when(key < cuts.getField(f"cut{i}"), names[i]).otherwise(part)
    return df.withColumn("Split", part)


def replicate_to_length(df: DataFrame, by: Column, n: int = COPIES_PER_MONTH, order: Sequence[str] = ORDER,
                        name: str = "YearMonth") -> DataFrame:
    """Repeat each group's rows, in order, until it has exactly `n`; a group of `n` or more rows keeps each once.

    Only rows of small groups are numbered: the others are dealt by a hash, so a hot group is many partitions.
    Rows without a group are kept once.
    """
    df = df.withColumn(name, by)
    rows = attach(df, df.groupBy(name).agg(F.count("*").alias("__m")), [name])
    short = F.coalesce(F.col("__m") < n, F.lit(False))
    part = F.when(short, 0).otherwise(F.pmod(F.xxhash64(*order), F.lit(1 << 20)))
    rows = rows.withColumn("__i", F.row_number().over(Window.partitionBy(name, part).orderBy(*order)))
    extra = F.when(F.col("__i") <= F.lit(n) % F.col("__m"), 1).otherwise(0)
    copies = F.when(short, F.floor(F.lit(n) / F.col("__m")) + extra).otherwise(1).cast("int")
    return rows.withColumn("Copy", F.explode(F.sequence(F.lit(1), copies))).drop("__m", "__i").select(*df.columns, "Copy")


def balance_by_month(train: DataFrame, label: str = "Ever90_12M", n: int = COPIES_PER_MONTH,
                     order: Sequence[str] = ORDER) -> DataFrame:
    """All negatives, and all positives, those of a disbursal month with fewer than `n` repeated to `n`."""
    month = year_month(F.col("DisbursedDate"))
    bad = replicate_to_length(train.filter(F.col(label) == 1), month, n, order).drop("Copy")
    return train.filter(F.col(label) == 0).withColumn("YearMonth", F.lit(None).cast("int")).unionByName(bad)


def upsample_minority(df: DataFrame, label: str = "Ever90_12M", key: Sequence[str] = ORDER, seed: int = 42) -> DataFrame:
    """All rows of the majority class and as many draws, with replacement, from the minority class.

    Draws pick ranks by hash and are counted per rank before the join, so a row travels once however
    often it is drawn. `key` identifies a row.
    """
    counts = {r[label]: r["count"] for r in df.filter(F.col(label).isNotNull()).groupBy(label).count().collect()}
    if len(counts) < 2:
        return df
    rare = min(counts, key=lambda k: (counts[k], k))
    wanted, have = sum(c for k, c in counts.items() if k != rare), counts[rare]
    minority = df.filter(F.col(label) == rare).withColumn("__h", hash_number(*[F.col(c) for c in key], F.lit(seed)))
    ids = minority.groupBy("__h", *key).agg(F.count("*").alias("__n"))
    ids = running_totals(ids, ["__h", *key], ["__n"]).drop("total___n")
    draws = df.sparkSession.range(wanted).select((F.pmod(hash_number(F.col("id"), F.lit(seed)), F.lit(have)) + 1).alias("__rank"))
    draws = draws.groupBy("__rank").agg(F.count("*").alias("__copies"))
    # A key standing for several equal rows takes the ranks (cum - n, cum].
    spread = ids.withColumn("__rank", F.explode(F.sequence(F.col("cum___n") - F.col("__n") + 1, F.col("cum___n"))))
    drawn = spread.join(draws, "__rank").groupBy(*key).agg(F.sum("__copies").alias("__copies"))
    one = first_per_key(minority.drop("__h"), list(key), [F.col(key[0])])
    copies = one.join(drawn, list(key)).withColumn("__c", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return df.filter(F.col(label) != rare).unionByName(copies.drop("__copies", "__c"))


def split_sizes(df: DataFrame, label: str = "Ever90_12M") -> DataFrame:
    return df.groupBy("Split").agg(F.count("*").alias("n"), F.sum(label).cast("long").alias("positives"))


def group_index(df: DataFrame, by: str, order: Sequence[str] = ORDER) -> DataFrame:
    """Zero-based position of a row within its group, by `order`; rows of equal order take any of their places.

    Positions come from counts of ranges, so a group that holds half of all rows is many tasks.
    """
    ranked = running_totals(df.withColumn("__one", F.lit(1)), list(order), ["__one"], [by])
    return ranked.withColumn("index", (F.col("cum___one") - 1).cast("int")).drop("__one", "cum___one", "total___one")


def stratified_folds(df: DataFrame, label: str, folds: int = 5, key: Sequence[str] = ("AccountNumber", "SnapshotDate"), seed: int = 42) -> DataFrame:
    """Adds `fold`, 0 to folds - 1: each class is dealt round in a random order, so its folds differ by one row at most.

    The order is a hash of the key and the seed. Rows without a label are dealt as a class of their own.
    """
    drawn = df.withColumn("__h", hash_number(*[F.col(k) for k in key], F.lit(seed))).withColumn("__one", F.lit(1))
    ranked = running_totals(drawn, ["__h", *key], ["__one"], [label])
    return ranked.withColumn("fold", ((F.col("cum___one") - 1) % folds).cast("int")).drop("__h", "__one", "cum___one", "total___one")
