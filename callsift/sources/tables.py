"""Stage tables: Parquet as the durable form, JSON lines and JSON documents at the edges."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.schemas import DDL, SCHEMAS, checked, conform
from callsift.sources import files

#: Folders, each of one call, that a job writes.
FOLDERS_AT_ONCE = 50_000


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{directory}/{name}") if name in DDL else spark.read.parquet(f"{directory}/{name}")


def write_table(df: DataFrame, directory: str, name: str) -> None:
    """Overwrite table ``name``, with the columns, domains and ranges of its schema.

    Personal-data mappings are partitioned by transcript, so that access can be granted per call.
    """
    out, place = checked(conform(df, name)), f"{directory}/{name}"
    if name == "pii_mappings":
        _write_folders(out, place, "transcript_id")
    else:
        out.write.mode("overwrite").parquet(place)


def _write_folders(rows: DataFrame, place: str, key: str) -> None:
    """A folder for each key, written by jobs of about ``FOLDERS_AT_ONCE`` folders, spread over all cores.

    The names of a job's folders come to the driver. Beyond one job, rows are first cut into slices of whole keys, so
    that each job reads its own; the slices go in any case, as they hold what the folders keep apart.
    """
    spark = rows.sparkSession
    spread = lambda df: df.repartition(spark.sparkContext.defaultParallelism, key)
    slices = -(-rows.select(key).distinct().count() // FOLDERS_AT_ONCE)
    if slices <= 1:
        spread(rows).write.mode("overwrite").partitionBy(key).parquet(place)
        return
    cut = f"{place}_slices"
    try:
        rows.withColumn("__slice", F.pmod(F.xxhash64(key), F.lit(slices))).repartition("__slice").write.mode("overwrite").partitionBy("__slice").parquet(cut)
        files.remove(place)
        for name in files.folders(cut):
            spread(spark.read.schema(rows.schema).parquet(f"{cut}/{name}")).write.mode("append").partitionBy(key).parquet(place)
    finally:
        files.remove(cut)


def read_json_lines(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Strictly typed JSON lines; blank lines are skipped, unknown fields and bad types are errors."""
    schema = SCHEMAS[name]
    lines = spark.read.text(path).where(F.trim("value") != "")
    keys = F.json_object_keys("value")
    known = F.array(*(F.lit(n) for n in schema.names))
    unknown = F.size(F.array_except(keys, known)) > 0
    text = F.when(unknown, F.raise_error(F.concat(F.lit("unknown fields: "), F.col("value"))).cast("string")).otherwise(F.col("value"))
    return checked(lines.select(F.from_json(text, schema, {"mode": "FAILFAST"}).alias("r")).select("r.*"))


def export_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_json(path: str | Path) -> Any:
    return json.loads(files.read_text(path))


def write_json(path: str | Path, value: Any) -> None:
    """A small JSON document, written by the driver."""
    files.write_text(path, json.dumps(value, indent=2, default=str))
