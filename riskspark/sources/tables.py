"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.dates import DateLike, as_date
from riskspark.functions.scalars import nan_to_null


def read_table(spark: SparkSession, name: str, root: str | None = None, jdbc: Mapping[str, str] | None = None,
               as_of: DateLike | None = None, date: str = "SnapshotDate",
               require_non_empty: bool = False) -> DataFrame:
    """A warehouse table: parquet below `root`, a JDBC source, or a catalog table.

    `jdbc` takes Spark's own options; give partitionColumn, lowerBound, upperBound and numPartitions
    there so that a large table is not read through one connection.
    """
    if jdbc is not None:
        df = spark.read.format("jdbc").options(**jdbc).option("dbtable", name).load()
    elif root is not None:
        df = spark.read.parquet(f"{root}/{name}.parquet")
    else:
        df = spark.table(name)
    if as_of is not None:
        df = df.filter(F.col(date) == as_date(as_of))
    if require_non_empty and df.isEmpty():
        raise ValueError(f"{name} returned no rows")
    return nan_to_null(df)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tape with a header and a declared schema; columns are matched by position, as written."""
    return nan_to_null(spark.read.csv(path, header=True, schema=schema, mode="FAILFAST"))


def read_manual_input(spark: SparkSession, path: str, schema: str, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """A hand-kept sheet exported to CSV. `mapping` is source column -> (name, type); the rest is dropped."""
    raw = spark.read.csv(path, header=True, schema=schema)
    return rename_and_cast(raw, mapping)


def rename_and_cast(df: DataFrame, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    return nan_to_null(df.select(*[F.col(f"`{src}`").cast(kind).alias(name) for src, (name, kind) in mapping.items()]))


def append_month(df: DataFrame, path: str, key_date: str) -> None:
    """Write one or more months; a month that is already there is replaced, so reruns are safe.

    The rebalance hint lets AQE size the files: it splits a large month and merges small ones.
    """
    (df.hint("rebalance", key_date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(key_date).parquet(path))


def write_tape(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    if fmt == "csv":
        df.write.mode("overwrite").csv(path, header=True)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def insert_manual_row(spark: SparkSession, path: str, schema: str, values: Mapping[str, Any], key: str) -> None:
    """Add one hand-entered row, replacing an earlier one with the same key."""
    row = spark.createDataFrame([tuple(values.values())], schema=schema)
    append_month(row, path, key)


def copy_commission_setup(setup: DataFrame, applications: DataFrame, product: str, as_of: DateLike,
                          excluded_brokers: tuple[str, ...] = (),
                          only_rate: Mapping[str, float] | None = None) -> DataFrame:
    """Commission rows valid at `as_of`, of brokers seen on `product`, relabelled to that product.

    `only_rate` keeps, for a broker named there, only rows with that commission share.
    """
    brokers = applications.filter(F.col("Product") == product).select("BrokerName")
    brokers = brokers.filter(F.col("BrokerName").isNotNull())
    if excluded_brokers:
        brokers = brokers.filter(~F.col("BrokerName").isin(*excluded_brokers))
    rows = setup.filter(as_date(as_of).between(F.col("validFrom"), F.col("validTo")))
    for broker, rate in (only_rate or {}).items():
        rows = rows.filter((F.col("BrokerName") != broker) | (F.col("CommissionPct") == rate))
    return rows.join(brokers.distinct(), "BrokerName", "left_semi").withColumn("Product", F.lit(product))
