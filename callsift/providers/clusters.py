"""Clustering providers: rows with an ``embedding`` in, ``cluster_id`` (-1 for outliers) out."""

from __future__ import annotations

import math
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W


class Clusterer(Protocol):
    def fit(self, rows: DataFrame, least_size: int, seed: int) -> DataFrame: ...


class BisectingClusterer:
    """Principal components, bisecting k-means, and outliers by distance.

    The number of centres is the root of ``rows / per_cluster_root``, however many rows there are, so
    centres stay few next to rows. Rows farther from their centre than three quartile ranges beyond
    the upper quartile, and clusters below the least size, are outliers; rows that lie close together
    have none. Ids number the clusters by size, then by smallest segment, from 0.
    """

    def __init__(self, components: int = 5, per_cluster_root: float = 2.0, reach: float = 3.0):
        self.components, self.root, self.reach = components, per_cluster_root, reach

    def fit(self, rows: DataFrame, least_size: int, seed: int) -> DataFrame:
        from pyspark import StorageLevel
        from pyspark.ml.clustering import BisectingKMeans
        from pyspark.ml.feature import PCA
        from pyspark.ml.functions import array_to_vector, vector_to_array

        # Read by every step below; lost blocks are made anew from the embeddings' table.
        vectors = rows.withColumn("v", array_to_vector(F.col("embedding").cast("array<double>"))).persist(StorageLevel.MEMORY_AND_DISK)
        n, size = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
        reduced = PCA(k=max(1, min(self.components, size)), inputCol="v", outputCol="p").fit(vectors).transform(vectors).drop("v")
        k = max(2, min(math.ceil(math.sqrt(n / self.root)), n // least_size))
        model = BisectingKMeans(k=k, seed=seed, featuresCol="p", predictionCol="c", minDivisibleClusterSize=2.0 * least_size).fit(reduced)
        centres = rows.sparkSession.createDataFrame(
            [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "c int, centre array<double>"
        )
        gap = F.aggregate(F.zip_with(vector_to_array("p"), "centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
        found = model.transform(reduced).join(centres, "c").withColumn("gap", F.sqrt(gap)).drop("p", "centre").persist(StorageLevel.MEMORY_AND_DISK)
        low, high = found.agg(F.percentile_approx("gap", [0.25, 0.75], 10_000)).first()[0]
        edge = high + self.reach * (high - low)
        found = found.withColumn("c", F.when(F.col("gap") > F.lit(edge), -1).otherwise(F.col("c"))).drop("gap")
        sizes = found.where("c >= 0").groupBy("c").agg(F.count("*").alias("n"), F.min("segment_id").alias("least")).where(F.col("n") >= least_size)
        # As many rows as centres.
        names = sizes.withColumn("cluster_id", F.row_number().over(W.Window.orderBy(F.desc("n"), "least")) - 1).select("c", "cluster_id")
        return found.join(names, "c", "left").withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1))).drop("c")
