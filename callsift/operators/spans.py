"""Interval logic over spans: overlap groups, their winners, containment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W


def overlap_groups(spans: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """``spans`` with ``grp``: a group ends where the next span starts at or after all ends so far."""
    order = W.Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(W.Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col(start) >= reach), 1).otherwise(0)
    return spans.withColumn("__fresh", fresh).withColumn("grp", F.sum("__fresh").over(order.rowsBetween(W.Window.unboundedPreceding, 0))).drop("__fresh")


def resolve(spans: DataFrame, key: str) -> DataFrame:
    """One span per overlap group, with ``conflict`` where its members differ.

    Pattern spans (``detector`` starts with ``regex:``) beat all others; without one, preserved
    spans beat the rest. Then the longest wins, then the best score, then the first.
    ``ordinal`` is a span's place in detection order.
    """
    grouped = overlap_groups(spans, key)
    part = W.Window.partitionBy(key, "grp")
    pattern = F.col("detector").startswith("regex:").cast("int")
    keeps = (F.col("action") == "preserve").cast("int")
    rows = grouped.withColumn("__pattern", pattern).withColumn(
        "conflict", F.size(F.collect_set(F.struct("start", "end", "entity_type", "action")).over(part)) > 1
    )
    order = part.orderBy(
        F.desc("__pattern"), F.desc(F.when(F.col("__pattern") == 0, keeps).otherwise(0)),
        F.desc(F.col("end") - F.col("start")), F.desc("score"), "start", "end", "ordinal",
    )
    return rows.withColumn("__n", F.row_number().over(order)).where(F.col("__n") == 1).drop("__n", "__pattern", "grp")


def not_contained(spans: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    """Spans that lie in no range of the same key."""
    r = ranges.select(F.col(key).alias("__k"), F.col("start").alias("__s"), F.col("end").alias("__e"))
    inside = (F.col(key) == F.col("__k")) & (F.col("__s") <= F.col("start")) & (F.col("end") <= F.col("__e"))
    return spans.join(r, inside, "left_anti")
