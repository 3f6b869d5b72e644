"""Rates over topics and findings, each with the rows behind it.

Sparse by nature: a category that does not occur in a (source, month) has no row. Finding
rates count findings, not segments, so they may exceed 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from callsift.functions.scalar import month_key, safe_rate
from callsift.schemas import conform


def majority_polarity(value: Column) -> Column:
    """``positive`` if more than half are, ``negative`` if fewer: all that is not positive, null too,
    speaks against; ``neutral`` if it is just half."""
    balance = 2 * F.count_if(value == "positive") - F.count("*")
    return F.when(balance > 0, "positive").when(balance < 0, "negative").otherwise("neutral")


def _months(transcripts: DataFrame) -> DataFrame:
    month = F.coalesce("transcript_month", month_key(F.col("transcript_datetime"))) if "transcript_month" in transcripts.columns else month_key(F.col("transcript_datetime"))
    return transcripts.select("transcript_id", month.alias("month"))


def _with_month(rows: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Rows with their transcript's month; a row without a transcript raises."""
    joined = rows.join(_months(transcripts).withColumn("__found", F.lit(True)), "transcript_id", "left")
    known = F.when(F.col("__found"), F.col("month")).otherwise(
        F.raise_error(F.concat(F.lit("unknown transcript: "), F.coalesce("transcript_id", F.lit("null")))).cast("string")
    )
    return joined.withColumn("month", known).drop("__found")


def topic_members(assignments: DataFrame, transcripts: DataFrame) -> DataFrame:
    return _with_month(assignments.where(~F.col("is_outlier")), transcripts)


def topic_prevalence(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Monthly and all-time prevalence in one pass, by grouping sets.

    The denominator is the number of assignments of the same window, taken over the
    aggregated rows, so members are shuffled once.
    """
    sets = members.groupingSets([["source_set", "month", "topic_id"], ["source_set", "topic_id"]], "source_set", "month", "topic_id")
    rows = sets.agg(
        F.grouping("month").alias("all_time"), F.count("*").alias("numerator"), F.countDistinct("transcript_id").alias("distinct_transcripts")
    )
    window = F.when(F.col("all_time") == 1, F.lit("all")).otherwise(F.col("month"))
    point = F.when(F.col("all_time") == 1, F.concat_ws("|", F.lit("topic_all"), "source_set", "topic_id")).otherwise(
        F.concat_ws("|", F.lit("topic_month"), "source_set", "month", "topic_id")
    )
    total = F.sum("numerator").over(W.Window.partitionBy("source_set", "time_window"))
    named = labels.select("topic_id", "label").dropDuplicates(["topic_id"])
    rows = rows.withColumn("time_window", window).withColumn("denominator", total).join(named, "topic_id", "left")
    kind = F.when(F.col("all_time") == 1, "topic_prevalence_all_time").otherwise("topic_prevalence_monthly")
    return _metric(rows, point, kind, F.coalesce("label", "topic_id"), F.lit(None).cast("string"))


def finding_members(segments: DataFrame, findings: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Findings with the source set and month of their segment; findings of unknown segments vanish."""
    own = _with_month(segments.select("segment_id", "source_set", "transcript_id"), transcripts).select("segment_id", "source_set", "month")
    sentiment = F.col("finding_type") == "sentiment"
    category = F.when(sentiment, F.concat_ws(":", F.coalesce("value", F.lit("None")), F.coalesce("target", F.lit("None")))).otherwise(F.col("finding_type"))
    return findings.drop("source_set").join(own, "segment_id").withColumn("is_sentiment", sentiment).withColumn("category", category)


def finding_metrics(segments: DataFrame, findings: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Sentiment distribution and finding prevalence; the denominator is all segments of the window."""
    sizes = _with_month(segments.select("segment_id", "source_set", "transcript_id"), transcripts).groupBy("source_set", "month").agg(
        F.count("*").alias("denominator")
    )
    rows = finding_members(segments, findings, transcripts).groupBy("source_set", "month", "is_sentiment", "category").agg(
        F.count("*").alias("numerator"), F.countDistinct("transcript_id").alias("distinct_transcripts"), majority_polarity(F.col("value")).alias("polarity")
    )
    rows = rows.join(sizes, ["source_set", "month"]).withColumn("time_window", F.col("month"))
    kind = F.when(F.col("is_sentiment"), "sentiment_distribution").otherwise("finding_prevalence")
    point = F.concat_ws("|", F.when(F.col("is_sentiment"), "sentiment").otherwise("finding"), "source_set", "month", "category")
    return _metric(rows, point, kind, F.col("category"), F.col("polarity"))


def _metric(rows: DataFrame, point: Column, kind: Column, category: Column, polarity: Column) -> DataFrame:
    return rows.select(
        point.alias("metric_id"), point.alias("chart_point_id"), kind.alias("metric_type"), "source_set", "time_window",
        category.alias("category"), "numerator", "denominator", safe_rate(F.col("numerator"), F.col("denominator")).alias("value"),
        "distinct_transcripts", polarity.alias("polarity"),
        F.create_map().cast("map<string,string>").alias("filters"),
    )


def contributors(members: DataFrame, found: DataFrame) -> DataFrame:
    """One row per metric and member: topic assignments (monthly and all-time), then findings."""
    month = F.concat_ws("|", F.lit("topic_month"), "source_set", "month", "topic_id")
    whole = F.concat_ws("|", F.lit("topic_all"), "source_set", "topic_id")
    topics = members.select(
        F.explode(F.array(month, whole)).alias("chart_point_id"), F.lit(None).cast("string").alias("finding_id"), "topic_id", "segment_id", "transcript_id"
    )
    point = F.concat_ws("|", F.when(F.col("is_sentiment"), "sentiment").otherwise("finding"), "source_set", "month", "category")
    rest = found.select(point.alias("chart_point_id"), "finding_id", F.lit(None).cast("string").alias("topic_id"), "segment_id", "transcript_id")
    both = topics.unionByName(rest).withColumn("membership_role", F.lit("numerator")).withColumn("exclusion_reason", F.lit(None).cast("string"))
    return conform(both, "metric_contributors")


def aggregate_metrics(
    transcripts: DataFrame, segments: DataFrame, assignments: DataFrame, labels: DataFrame, findings: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """``(metrics, contributors)``."""
    members = topic_members(assignments, transcripts)
    metrics = topic_prevalence(members, labels).unionByName(finding_metrics(segments, findings, transcripts))
    return conform(metrics, "metrics"), contributors(members, finding_members(segments, findings, transcripts))


def export_order(metrics: DataFrame) -> DataFrame:
    """Topic metrics by month, then all-time, then per source and month sentiment before findings."""
    from callsift.schemas import SOURCE_SETS

    block = F.when(F.col("metric_type") == "topic_prevalence_monthly", 0).when(F.col("metric_type") == "topic_prevalence_all_time", 1).otherwise(2)
    source = F.when(block < 2, F.lit(0)).otherwise(F.array_position(F.array(*map(F.lit, SOURCE_SETS)), F.col("source_set")))
    return metrics.orderBy(
        block, source, F.when(block < 2, F.col("source_set")), "time_window", F.col("metric_type") != "sentiment_distribution", "chart_point_id"
    )
