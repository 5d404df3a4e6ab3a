"""Session defaults. Everything here is an ordinary Spark setting a cluster may override."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even if that costs one more exchange after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites of column expressions cost more than building the plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster passes its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskspark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Small local data still spreads over the cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`, set here only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix=f"riskspark-{os.getpid()}-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several branches read to the shared folder, and read it back.

    The branches then scan only their columns instead of each repeating the work behind `df`, and a lost executor
    costs a read, not a recomputation. `discard` removes a table that nothing reads any more; the folder's own
    retention removes the others.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that `materialise` returned and that no frame still to be run reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
