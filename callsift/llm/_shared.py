"""Materialised tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no checkpoint folder and all runs on one machine (tests, notebooks).
LOCAL_FALLBACK = "/tmp/checkpoints/callsift"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, without a trailing slash."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (base or LOCAL_FALLBACK).rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    This cuts lineage in a way that survives lost executors and freezes
    partition-dependent columns such as ``monotonically_increasing_id``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/callsift-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._callsift_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete materialised tables that no later plan reads."""
    for df in frames:
        path = getattr(df, "_callsift_path", None)
        if path:
            spark = df.sparkSession
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def with_position(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sort ``df`` by ``keys`` over range partitions and freeze each row's place.

    Adds ``_part`` (range partition, ascending with the keys) and ``_row`` (place
    within it). No task sees more than its range, however frequent a key is, as
    long as the keys end in a near-unique column.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    placed = materialize(placed, "placed")
    return placed.withColumn("_part", F.shiftright("_id", 33)).withColumn(
        "_row", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    ).drop("_id")
