"""Segment vectors: centroids, nearest members, neighbouring similarity."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from callsift.functions.scalar import dot, normalized
from callsift.schemas import conform
from callsift.shipping import ship


def embedding_column(provider) -> Callable:
    """A column function: unit vectors of texts, in Arrow batches."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def embed(texts: pa.Array) -> pa.Array:
        return pa.array(list(provider.embed([t.as_py() or "" for t in texts])), pa.list_(pa.float32()))

    return embed


def embed_segments(segments: DataFrame, provider) -> DataFrame:
    ship(segments.sparkSession)
    return conform(segments.select("segment_id", "transcript_id", embedding_column(provider)("text").alias("embedding")), "segment_embeddings")


def centroids(rows: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """``key, centroid``: the elementwise mean of each group, scaled to unit length."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    # Means are kept up map-side, a vector a group.
    means = rows.groupBy(key).agg(Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>"))).alias("m"))
    return means.select(key, normalized(vector_to_array("m")).alias("centroid"))


def nearest_members(rows: DataFrame, key: str, order: list[str], k: int, vector: str = "embedding") -> DataFrame:
    """Each group's ``k`` rows with the largest product with its centroid; ties keep ``order``."""
    scored = rows.join(centroids(rows, key, vector), key).withColumn("similarity", dot(F.col(vector), F.col("centroid")))
    ranked = F.row_number().over(W.Window.partitionBy(key).orderBy(F.desc("similarity"), *order))
    return scored.withColumn("rank", ranked).where(F.col("rank") <= k).drop("centroid", vector)


def neighbour_similarity(rows: DataFrame, key: str, order: str, threshold: float, vector: str = "embedding") -> DataFrame:
    """Similarity with the row before, and whether it falls short of the threshold (strictly)."""
    before = F.lag(vector).over(W.Window.partitionBy(key).orderBy(order))
    out = rows.withColumn("similarity", F.when(before.isNotNull(), dot(before, F.col(vector))))
    return out.withColumn("shift", F.coalesce(F.col("similarity") < threshold, F.lit(False)))
