"""Utterances to turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.functions.scalar import dialogue
from callsift.schemas import conform


def materialize_turns(utterances: DataFrame, classifications: DataFrame) -> DataFrame:
    """One turn per redacted utterance; an utterance without a classification raises while it is read."""
    known = classifications.select("transcript_id", "source_set")
    missing = F.concat(F.lit("unclassified transcript: "), F.col("transcript_id"))
    rows = utterances.join(known, "transcript_id", "left").select(
        F.concat_ws(":", "transcript_id", F.col("index").cast("string")).alias("turn_id"),
        "transcript_id",
        F.coalesce("source_set", F.raise_error(missing).cast("string")).alias("source_set"),
        F.col("index").alias("order"),
        F.col("speaker_name").alias("speaker"),
        F.col("sentence").alias("text"),
        "time",
        "end_time",
    )
    return conform(rows, "turns")


def dialogues(rows: DataFrame, order: str = "index", speaker: str = "speaker_name", sentence: str = "sentence", first: int | None = None) -> DataFrame:
    """``transcript_id, dialogue``: lines in order, joined by newlines; only the first lines if asked."""
    if first is not None:
        from pyspark.sql import window as W

        nth = F.row_number().over(W.Window.partitionBy("transcript_id").orderBy(order))
        rows = rows.withColumn("__n", nth).where(F.col("__n") <= first)
    lines = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), dialogue(F.col(speaker), F.col(sentence)).alias("line"))))
    return rows.groupBy("transcript_id").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("dialogue"))
