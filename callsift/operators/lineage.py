"""From a chart point to its segments, findings and transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lineage(
    contributors: DataFrame, segments: DataFrame, transcripts: DataFrame, findings: DataFrame | None = None, chart_point_id: str | None = None
) -> DataFrame:
    """Rows behind one chart point, or behind all if none is named."""
    rows = contributors if chart_point_id is None else contributors.where(F.col("chart_point_id") == chart_point_id)
    texts = segments.select("segment_id", F.col("text").alias("segment_text"))
    calls = transcripts.select("transcript_id", "transcript_datetime", "relative_path")
    out = rows.join(texts, "segment_id").join(calls, "transcript_id")
    if findings is not None:
        out = out.join(findings.select("finding_id", "finding_type", "target", "value", "reason"), "finding_id", "left")
    return out
