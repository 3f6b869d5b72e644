"""Folder scan: one transcript per immediate subfolder, joined to its meeting record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.functions.scalar import iso_timestamp, month_of_text
from callsift.schemas import DDL, conform


def _scan(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``transcript_id, relative_path, content, size`` of every ``<root>/<id>/<name>``."""
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/{name}")
    return files.select(
        F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("transcript_id"),
        F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("relative_path"),
        "content",
        F.col("length").alias("size_bytes"),
    )


def scan_transcripts(spark: SparkSession, root: str) -> DataFrame:
    """Parsed transcript files; folders without one are skipped, none at all is an error.

    A file whose ``data`` is missing, empty or not a list raises while it is read.
    """
    try:
        files = _scan(spark, root, "transcript.json")
        empty = files.select("transcript_id").isEmpty()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        empty = True
    if empty:
        raise FileNotFoundError(f"no transcripts below {root}")
    parsed = files.withColumn("raw", F.from_json(F.decode("content", "UTF-8"), DDL["raw_transcript"], {"mode": "FAILFAST"}))
    data = F.col("raw.data")
    said = F.concat(F.lit("transcript without utterances: "), F.col("relative_path"))
    good = data.isNotNull() & (F.size(data) > 0)
    return parsed.withColumn("data", F.when(good, data).otherwise(F.raise_error(said).cast(parsed.schema["raw"].dataType["data"].dataType))).drop("raw")


def scan_meetings(spark: SparkSession, root: str) -> DataFrame:
    """``transcript_id`` with start (required), end and duration (optional) of each meeting."""
    files = _scan(spark, root, "meeting-info.json")
    info = F.from_json(F.decode("content", "UTF-8"), DDL["meeting_info"], {"mode": "FAILFAST"})
    rows = files.select("transcript_id", info.alias("m")).select("transcript_id", "m.*")
    start = F.when(F.trim("startTime") != "", F.col("startTime")).otherwise(
        F.raise_error(F.concat(F.lit("meeting without a start: "), F.col("transcript_id"))).cast("string")
    )
    return rows.select(
        "transcript_id",
        iso_timestamp(start).alias("transcript_datetime"),
        month_of_text(start).alias("transcript_month"),
        iso_timestamp(F.col("endTime")).alias("end_time"),
        F.col("duration").alias("duration_minutes"),
    )


def ingest(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """``(transcripts, utterances)``; a transcript without a meeting record is an error."""
    files, meetings = scan_transcripts(spark, root), scan_meetings(spark, root)
    lonely = files.select("transcript_id").join(meetings.select("transcript_id"), "transcript_id", "left_anti").take(5)
    if lonely:
        raise FileNotFoundError(f"no meeting record for {', '.join(sorted(r.transcript_id for r in lonely))}")
    joined = files.join(meetings, "transcript_id")
    transcripts = joined.select(
        "transcript_id", "relative_path", "transcript_datetime", "transcript_month", "end_time", "duration_minutes",
        F.size("data").cast("long").alias("utterance_count"),
        F.sha2("content", 256).alias("content_hash"),
        "size_bytes",
        F.lit("ingested").alias("ingestion_status"),
    )
    utterances = files.select("transcript_id", F.explode("data").alias("u")).select(
        "transcript_id", "u.index", "u.speaker_id", "u.speaker_name", "u.sentence", "u.time", F.col("u.endTime").alias("end_time")
    )
    return conform(transcripts, "transcripts"), conform(utterances, "utterances")
