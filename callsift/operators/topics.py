"""Segments to topics per scope: clusters, sizes, terms, nearest examples, labels."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from callsift.operators.vectors import nearest_members
from callsift.providers.calls import LanguageModel, map_calls
from callsift.providers.clusters import Clusterer
from callsift.schemas import CUSTOMER_TOPICS, INTERNAL_TOPICS, SOURCE_SETS, conform
from callsift.settings import Settings

log = logging.getLogger(__name__)

#: Topic version and the kinds of call in its scope.
SCOPES = {CUSTOMER_TOPICS: SOURCE_SETS[:2], INTERNAL_TOPICS: SOURCE_SETS[2:]}
TERMS = 5
LABEL_INSTRUCTIONS = "Name this group of call passages in a few words (label) and say in one sentence what they share (description)."


def assign_topics(segments: DataFrame, embeddings: DataFrame, clusterer: Clusterer, settings: Settings) -> DataFrame:
    """Assignments of every scope that has enough segments; smaller scopes are skipped with a warning."""
    out = None
    for version, kinds in SCOPES.items():
        scope = segments.where(F.col("source_set").isin(*kinds))
        if scope.limit(settings.minimum_cluster_size).count() < settings.minimum_cluster_size:
            log.warning("too few segments to cluster: %s", version)
            continue
        rows = scope.select("segment_id", "transcript_id", "source_set").join(embeddings.select("segment_id", "embedding"), "segment_id")
        found = clusterer.fit(rows, settings.minimum_cluster_size, settings.topic_random_state)
        outlier = F.col("cluster_id") == -1
        made = found.select(
            F.lit(version).alias("topic_version"),
            F.concat_ws(":", F.lit(version), F.when(outlier, "outlier").otherwise(F.col("cluster_id").cast("string"))).alias("topic_id"),
            F.col("cluster_id").cast("int").alias("cluster_id"), "segment_id", "transcript_id", "source_set", outlier.alias("is_outlier"),
        )
        out = made if out is None else out.unionByName(made)
    if out is None:
        from callsift.schemas import SCHEMAS

        return segments.sparkSession.createDataFrame([], SCHEMAS["topic_assignments"])
    return conform(out, "topic_assignments")


def cluster_metadata(assignments: DataFrame) -> DataFrame:
    """Size and distribution over the kinds of call that occur, in their fixed order."""
    rank = F.array_position(F.array(*map(F.lit, SOURCE_SETS)), F.col("source_set"))
    keys = ["topic_version", "topic_id", "cluster_id", "is_outlier"]
    counts = assignments.groupBy(*keys, "source_set").agg(F.count("*").alias("n")).withColumn("r", rank)
    entries = F.transform(F.array_sort(F.collect_list(F.struct("r", "source_set", "n"))), lambda e: F.struct(e["source_set"], e["n"]))
    out = counts.groupBy(*keys).agg(F.sum("n").alias("cluster_size"), F.map_from_entries(entries).alias("source_distribution"))
    return conform(out, "cluster_metadata")


def dominant_source(distribution):
    """The most frequent kind of call; ties go to the earlier one."""
    counts = F.transform(
        F.array(*map(F.lit, SOURCE_SETS)), lambda s: F.struct(F.coalesce(F.try_element_at(distribution, s), F.lit(0)).alias("n"), -F.array_position(F.array(*map(F.lit, SOURCE_SETS)), s), s.alias("s"))
    )
    return F.array_max(counts)["s"]


def topic_terms(assignments: DataFrame, segments: DataFrame, stop_words: list[str] | None = None, least_segments: int = 2) -> DataFrame:
    """The terms with the highest class-based weight of each topic.

    Words and word pairs without stop words; a term's weight in a topic is
    ``sqrt(share of the topic's terms) * log(1 + mean terms per topic / term's total)``.
    """
    from pyspark import StorageLevel
    from pyspark.ml.feature import RegexTokenizer, StopWordsRemover

    # A segment's number is its identifier's hash and its place among identifiers of that hash: longs, whose bounds are
    # kept up map-side. Terms with different bounds occur in two segments, so no pair of term and segment is shuffled.
    hashed = assignments.where(~F.col("is_outlier")).select("topic_version", "topic_id", "cluster_id", "segment_id", F.xxhash64("segment_id").alias("h"))
    numbered = hashed.withColumn("p", F.dense_rank().over(W.Window.partitionBy("h").orderBy("segment_id")))
    rows = numbered.join(segments.select("segment_id", F.coalesce("text", F.lit("")).alias("text")), "segment_id")
    words = RegexTokenizer(inputCol="text", outputCol="words", pattern=r"(?U)\b\w\w+\b", gaps=False).transform(rows)
    stops = stop_words or StopWordsRemover.loadDefaultStopWords("english")
    # The tokenizer's words are in lower case already. Arrays stay in Spark's own form from here on.
    kept = words.withColumn("kept", F.filter("words", lambda w: ~w.isin([s.lower() for s in stops])))
    pairs = kept.withColumn("pairs", F.transform(F.slice("kept", F.lit(2), F.size("kept")), lambda w, i: F.concat(F.get("kept", i), F.lit(" "), w)))
    terms = pairs.select("topic_version", "topic_id", "cluster_id", "segment_id", "h", "p", F.explode(F.concat("kept", "pairs")).alias("term"))
    bounds = [f(c).alias(f"{f.__name__}_{c}") for c in ("h", "p") for f in (F.min, F.max)]
    counts = terms.groupBy("topic_version", "topic_id", "cluster_id", "term").agg(F.count("*").alias("n"), *bounds)
    # The hash comes first, so that sorting seldom compares strings.
    counts = counts.withColumn("t", F.xxhash64("topic_version", "term"))
    whole = W.Window.partitionBy("t", "topic_version", "term")
    differ = [F.min(f"min_{c}").over(whole) < F.max(f"max_{c}").over(whole) for c in ("h", "p")]
    counts = counts.select("topic_version", "topic_id", "cluster_id", "term", "n", F.sum("n").over(whole).alias("total"), (differ[0] | differ[1]).alias("shared"))
    if least_segments > 1:
        counts = counts.where("shared")
    if least_segments > 2:
        known = terms.groupBy("topic_version", "term").agg(F.countDistinct("segment_id").alias("df")).where(F.col("df") >= least_segments)
        counts = counts.join(known, ["topic_version", "term"], "left_semi")
    counts = counts.drop("shared").persist(StorageLevel.MEMORY_AND_DISK)  # read for the sizes, then for the ranks
    sizes = counts.groupBy("topic_version", "topic_id").agg(F.sum("n").alias("size"))
    # As many rows as topics; joined without a shuffle, so that terms are ranked where they lie before a topic's best meet.
    sizes = sizes.withColumn("mean", F.avg("size").over(W.Window.partitionBy("topic_version")))
    weighed = counts.join(F.broadcast(sizes), ["topic_version", "topic_id"]).withColumn(
        "weight", F.sqrt(F.col("n") / F.col("size")) * F.log1p(F.col("mean") / F.col("total"))
    )
    rank = F.row_number().over(W.Window.partitionBy("topic_id").orderBy(F.desc("weight"), "term"))
    return conform(weighed.select("topic_version", "topic_id", "cluster_id", rank.alias("rank"), "term").where(F.col("rank") <= TERMS), "topic_terms")


def centroid_segments(assignments: DataFrame, embeddings: DataFrame, segments: DataFrame, k: int) -> DataFrame:
    rows = assignments.where(~F.col("is_outlier")).join(embeddings.select("segment_id", "embedding"), "segment_id").join(
        segments.select("segment_id", F.col("order").alias("__o")), "segment_id"
    )
    near = nearest_members(rows, "topic_id", ["transcript_id", "__o"], k)
    return conform(near.select("topic_version", "topic_id", "cluster_id", F.col("rank").cast("int").alias("rank"), "segment_id"), "centroid_segments")


def described(metadata: DataFrame, terms: DataFrame, nearest: DataFrame, segments: DataFrame) -> DataFrame:
    """Every topic that is not the outliers', with its terms and the texts of its nearest segments."""
    ranked = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("rank", c))), lambda x: x[c])
    words = terms.groupBy("topic_id").agg(ranked("term").alias("terms"))
    ids = nearest.groupBy("topic_id").agg(ranked("segment_id").alias("centroid_segment_ids"))
    texts = nearest.join(segments.select("segment_id", "text"), "segment_id").groupBy("topic_id").agg(F.array_join(ranked("text"), "\n\n").alias("examples"))
    none = F.array().cast("array<string>")
    return metadata.where(~F.col("is_outlier")).join(words, "topic_id", "left").join(ids, "topic_id", "left").join(texts, "topic_id", "left").withColumns(
        {"terms": F.coalesce("terms", none), "centroid_segment_ids": F.coalesce("centroid_segment_ids", none), "examples": F.coalesce("examples", F.lit(""))}
    )


def ask(topics: DataFrame, provider: LanguageModel, settings: Settings) -> DataFrame:
    """The model's answer for every topic, from its size, terms and nearest segments, with the tokens it took."""
    quoted = F.array_join(F.transform("terms", lambda t: F.concat(F.lit("'"), t, F.lit("'"))), ", ")
    prompt = F.concat(F.lit("segments: "), F.col("cluster_size"), F.lit("\nterms: "), quoted, F.lit("\nexamples:\n"), "examples")
    return map_calls(topics.select("topic_id", F.lit(LABEL_INSTRUCTIONS).alias("instructions"), prompt.alias("prompt")), "topic_id", "label", "label string, description string", provider, settings)


def labelled(topics: DataFrame, answers: DataFrame, model: str, settings: Settings) -> DataFrame:
    """One label per topic."""
    out = topics.join(answers.select("topic_id", "label", "description"), "topic_id").select(
        "topic_version", "topic_id", "cluster_id", "label", "description", "terms", "centroid_segment_ids", "cluster_size", "source_distribution",
        F.lit(model).alias("model"), F.lit(settings.topic_prompt_version).alias("prompt_version"),
    )
    return conform(out, "topics")


def label_topics(metadata: DataFrame, terms: DataFrame, nearest: DataFrame, segments: DataFrame, provider: LanguageModel, settings: Settings) -> DataFrame:
    known = described(metadata, terms, nearest, segments)
    return labelled(known, ask(known, provider, settings), provider.name, settings)


def discovery(segments: DataFrame, metadata: DataFrame) -> dict[str, int]:
    """Totals of the clustering stage."""
    kinds = {r.source_set: r.n for r in segments.groupBy("source_set").agg(F.count("*").alias("n")).collect()}
    return {
        "customer_segments": sum(kinds.get(s, 0) for s in SOURCE_SETS[:2]),
        "internal_segments": kinds.get(SOURCE_SETS[2], 0),
        "topics": metadata.where(~F.col("is_outlier")).count(),
    }


def outlier_counts(assignments: DataFrame) -> DataFrame:
    """``source_set, outliers`` with a row for every kind of call."""
    kinds = assignments.sparkSession.createDataFrame([(s,) for s in SOURCE_SETS], "source_set string")
    counts = assignments.where("is_outlier").groupBy("source_set").agg(F.count("*").alias("n"))
    return kinds.join(counts, "source_set", "left").select("source_set", F.coalesce("n", F.lit(0)).cast("long").alias("outliers"))
