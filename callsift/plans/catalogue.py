"""Queries over the driver's tables that apply the operators, and DuckDB SQL for the same rows.

The tables stand in for stage tables (orders for topic assignments, events for findings,
conversations for utterances, embeddings for segment vectors).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from callsift.functions import scalar
from callsift.operators import charts, classify, findings, lineage, metrics, privacy, segments, spans, topics, turns, vectors
from callsift.providers.offline import HashEmbedder, RuleModel
from callsift.schemas import CUSTOMER_FINDINGS, INTERNAL_FINDINGS, SCHEMAS, SOURCE_SETS
from callsift.settings import Settings
from callsift.sources import tables


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _kind(column: str):
    """One of the kinds of call, by remainder."""
    n = F.pmod(F.col(column), F.lit(3))
    return F.when(n == 0, SOURCE_SETS[0]).when(n == 1, SOURCE_SETS[1]).otherwise(SOURCE_SETS[2])


_KIND = "CASE {0} % 3 WHEN 0 THEN 'customer-support' WHEN 1 THEN 'account-manager' ELSE 'internal-discuss' END"


# --- topic metrics --------------------------------------------------------------------------


def _order_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source_set"), scalar.month_key(F.col("o_orderdate")).alias("month"), F.col("o_orderstatus").alias("topic_id"),
        F.col("o_orderkey").cast("string").alias("segment_id"), F.col("o_custkey").cast("string").alias("transcript_id"),
    )


def _order_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.createDataFrame([("F", "finished"), ("O", "open")], "topic_id string, label string")
    rows = metrics.topic_prevalence(_order_members(spark, sf_dir), labels)
    return rows.select(
        "chart_point_id", "metric_type", "source_set", "time_window", "category", "numerator", "denominator", F.round("value", 9).alias("value"), "distinct_transcripts"
    )


def q1_prevalence_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_metrics(spark, sf_dir).where("metric_type = 'topic_prevalence_monthly'")


def q2_prevalence_all_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_metrics(spark, sf_dir).where("metric_type = 'topic_prevalence_all_time'")


def q2_prevalence_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_metrics(spark, sf_dir)


_PREVALENCE = """
    WITH m AS (
        SELECT o_orderpriority AS s, strftime(o_orderdate, '%Y-%m') AS w, o_orderstatus AS t, o_custkey AS c FROM orders
    ), g AS (
        SELECT s, w, t, count(*) AS n, count(DISTINCT c) AS d, 'month' AS k FROM m GROUP BY s, w, t
        UNION ALL SELECT s, 'all', t, count(*), count(DISTINCT c), 'all' FROM m GROUP BY s, t
    ), r AS (SELECT *, CAST(sum(n) OVER (PARTITION BY s, w) AS BIGINT) AS den FROM g)
    SELECT concat_ws('|', 'topic_' || k, s, CASE WHEN k = 'month' THEN w END, t) AS chart_point_id,
           CASE WHEN k = 'month' THEN 'topic_prevalence_monthly' ELSE 'topic_prevalence_all_time' END AS metric_type,
           s AS source_set, w AS time_window, CASE t WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE t END AS category,
           n AS numerator, den AS denominator, round(n / den, 9) AS value, d AS distinct_transcripts
    FROM r WHERE k IN ({0})
"""


# --- finding metrics ------------------------------------------------------------------------


def _event_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    events = _t(spark, sf_dir, "events")
    ids = F.col("event_id").cast("string")
    user = F.col("user_id").cast("string")
    calls = events.groupBy("user_id").agg(F.min("ts").alias("transcript_datetime")).select(user.alias("transcript_id"), "transcript_datetime")
    segs = events.select(ids.alias("segment_id"), _kind("user_id").alias("source_set"), user.alias("transcript_id"))
    found = events.select(
        F.concat(ids, F.lit(":finding:0")).alias("finding_id"), ids.alias("segment_id"), user.alias("transcript_id"), _kind("user_id").alias("source_set"),
        F.when(F.col("event_type") == "click", "sentiment").otherwise(F.col("event_type")).alias("finding_type"),
        F.lit("product").alias("target"), F.when(F.col("value") > 50, "positive").when(F.col("value") < 20, "negative").otherwise("neutral").alias("value"),
    )
    return calls, segs, found


def q3_finding_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, segs, found = _event_frames(spark, sf_dir)
    rows = metrics.finding_metrics(segs, found, calls)
    return rows.select(
        "chart_point_id", "metric_type", "source_set", "time_window", "category", "numerator", "denominator", F.round("value", 9).alias("value"), "distinct_transcripts", "polarity"
    )


_FOUND = f"""
    e AS (SELECT *, {_KIND.format('user_id')} AS s, min(ts) OVER (PARTITION BY user_id) AS first FROM events),
    f AS (
        SELECT event_id, user_id, s, strftime(first, '%Y-%m') AS w, CASE WHEN event_type = 'click' THEN 'sentiment' ELSE event_type END AS k,
               CASE WHEN value > 50 THEN 'positive' WHEN value < 20 THEN 'negative' ELSE 'neutral' END AS v
        FROM e
    )
"""
_FINDINGS = f"""
    WITH {_FOUND}, d AS (SELECT s, strftime(first, '%Y-%m') AS w, count(*) AS den FROM e GROUP BY 1, 2),
    g AS (
        SELECT s, w, k = 'sentiment' AS tone, CASE WHEN k = 'sentiment' THEN v || ':product' ELSE k END AS c, count(*) AS n, count(DISTINCT user_id) AS u,
               sum(CASE WHEN v = 'positive' THEN 1 ELSE -1 END) AS balance
        FROM f GROUP BY 1, 2, 3, 4
    )
    SELECT concat_ws('|', CASE WHEN tone THEN 'sentiment' ELSE 'finding' END, s, w, c) AS chart_point_id,
           CASE WHEN tone THEN 'sentiment_distribution' ELSE 'finding_prevalence' END AS metric_type, s AS source_set, w AS time_window, c AS category,
           n AS numerator, den AS denominator, round(n / den, 9) AS value, u AS distinct_transcripts,
           CASE sign(balance) WHEN 1 THEN 'positive' WHEN -1 THEN 'negative' ELSE 'neutral' END AS polarity
    FROM g JOIN d USING (s, w)
"""


def q3_contributor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, segs, found = _event_frames(spark, sf_dir)
    rows = metrics.contributors(_order_members(spark, sf_dir), metrics.finding_members(segs, found, calls))
    return rows.groupBy("chart_point_id", "membership_role").agg(
        F.count("*").alias("members"), F.count("topic_id").alias("topics"), F.count("finding_id").alias("findings"), F.countDistinct("transcript_id").alias("transcripts")
    )


_CONTRIBUTORS = f"""
    WITH {_FOUND}, p AS (
        SELECT concat_ws('|', CASE WHEN k = 'sentiment' THEN 'sentiment' ELSE 'finding' END, s, w, CASE WHEN k = 'sentiment' THEN v || ':product' ELSE k END) AS p,
               user_id AS c, 0 AS t, 1 AS f FROM f
        UNION ALL SELECT concat_ws('|', 'topic_month', o_orderpriority, strftime(o_orderdate, '%Y-%m'), o_orderstatus), o_custkey, 1, 0 FROM orders
        UNION ALL SELECT concat_ws('|', 'topic_all', o_orderpriority, o_orderstatus), o_custkey, 1, 0 FROM orders
    )
    SELECT p AS chart_point_id, 'numerator' AS membership_role, count(*) AS members, CAST(sum(t) AS BIGINT) AS topics, CAST(sum(f) AS BIGINT) AS findings,
           count(DISTINCT c) AS transcripts FROM p GROUP BY p
"""

#: Event types as finding types; two of them lie outside one of the vocabularies.
_TYPES = {"click": "sentiment", "purchase": "resolution", "view": "renewal_risk"}


def _proposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.coalesce(*(F.when(F.col("event_type") == a, b) for a, b in _TYPES.items()), F.concat(F.lit("new_"), "event_type"))
    return _t(spark, sf_dir, "events").select(
        F.col("event_id").alias("finding_id"), F.floor(F.col("user_id") / 4).cast("long").alias("segment_id"), _kind("user_id").alias("source_set"), kind.alias("finding_type")
    )


_PROPOSED = f"""
    f AS (
        SELECT event_id AS finding_id, CAST(floor(user_id / 4) AS BIGINT) AS segment_id, {_KIND.format('user_id')} AS source_set,
               CASE event_type WHEN 'click' THEN 'sentiment' WHEN 'purchase' THEN 'resolution' WHEN 'view' THEN 'renewal_risk' ELSE 'new_' || event_type END AS finding_type
        FROM events
    ), p AS (
        SELECT finding_type AS t, count(*) AS n, count(DISTINCT segment_id) AS s FROM f
        WHERE CASE WHEN source_set = 'internal-discuss'
            THEN finding_type NOT IN {INTERNAL_FINDINGS!r} ELSE finding_type NOT IN {CUSTOMER_FINDINGS!r} END
        GROUP BY 1
    )
"""


def q4_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    tally = findings.proposals(_proposed(spark, sf_dir), 20)
    return tally.select("proposed_type", "finding_count", "segment_count", "promoted", F.size("finding_ids").cast("long").alias("ids"))


def q4_kept_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.keep_findings(_proposed(spark, sf_dir), 20)


# --- vectors --------------------------------------------------------------------------------


def q5_nearest_to_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = vectors.nearest_members(_t(spark, sf_dir, "embeddings"), "label", ["vec_id"], 3)
    return near.select("label", F.col("rank").cast("long").alias("rank"), "vec_id", F.round("similarity", 6).alias("similarity"))


_NEAREST = """
    WITH x AS (SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) r(i)),
    m AS (SELECT label, i, avg(v) AS m FROM x GROUP BY 1, 2),
    c AS (SELECT label, i, m / greatest(sqrt(sum(m * m) OVER (PARTITION BY label)), 1e-12) AS c FROM m),
    d AS (SELECT x.label, vec_id, sum(v * c) AS s FROM x JOIN c ON x.label = c.label AND x.i = c.i GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) AS rank FROM d)
    SELECT label, rank, vec_id, round(s, 6) AS similarity FROM r WHERE rank <= 3
"""


def q6_topic_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors.neighbour_similarity(_t(spark, sf_dir, "embeddings"), "label", "vec_id", 0.35)
    return rows.select("label", "vec_id", F.round("similarity", 6).alias("similarity"), "shift")


_SHIFT = """
    WITH p AS (SELECT label, vec_id, embedding AS e, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings),
    d AS (SELECT label, vec_id, CASE WHEN b IS NOT NULL THEN list_sum(list_transform(list_zip(e, b), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))) END AS s FROM p)
    SELECT label, vec_id, round(s, 6) AS similarity, coalesce(s < 0.35, false) AS shift FROM d
"""


def q5_cluster_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "embeddings").select(
        F.lit("customer-topic-v1").alias("topic_version"), F.concat(F.lit("customer-topic-v1:"), F.col("label").cast("string")).alias("topic_id"),
        F.col("label").alias("cluster_id"), _kind("vec_id").alias("source_set"), (F.col("label") == 9).alias("is_outlier"),
    )
    made = topics.cluster_metadata(rows)
    dist = lambda s: F.coalesce(F.try_element_at("source_distribution", F.lit(s)), F.lit(0)).cast("long")
    return made.select(
        "topic_id", "cluster_id", "cluster_size", "is_outlier", dist(SOURCE_SETS[0]).alias("support"), dist(SOURCE_SETS[1]).alias("am"), dist(SOURCE_SETS[2]).alias("internal"),
        topics.dominant_source(F.col("source_distribution")).alias("dominant"),
    )


_CLUSTERS = """
    WITH g AS (
        SELECT label, count(*) AS n, count(*) FILTER (WHERE vec_id % 3 = 0) AS a, count(*) FILTER (WHERE vec_id % 3 = 1) AS b, count(*) FILTER (WHERE vec_id % 3 = 2) AS c
        FROM embeddings GROUP BY 1
    )
    SELECT 'customer-topic-v1:' || label AS topic_id, label AS cluster_id, n AS cluster_size, label = 9 AS is_outlier, a AS support, b AS am, c AS internal,
           CASE WHEN a >= b AND a >= c THEN 'customer-support' WHEN b >= c THEN 'account-manager' ELSE 'internal-discuss' END AS dominant FROM g
"""


# --- conversations --------------------------------------------------------------------------


def _utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("transcript_id"), F.col("turn").alias("index"), F.lit(0).cast("long").alias("speaker_id"),
        F.col("role").alias("speaker_name"), F.col("text").alias("sentence"), F.lit(None).cast("double").alias("time"), F.lit(None).cast("double").alias("end_time"),
    )


def q7_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _utterances(spark, sf_dir)
    kinds = rows.select("transcript_id").distinct().withColumn("source_set", _kind("transcript_id"))
    return turns.materialize_turns(rows, kinds).select("turn_id", "transcript_id", "source_set", F.col("order").alias("position"), "speaker", "text")


def q7_openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.dialogues(_utterances(spark, sf_dir), first=3)


def q14_segment_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("transcript_id"), F.col("turn").alias("order"), scalar.word_count(F.coalesce("text", F.lit(""))).alias("tokens"), F.lit(False).alias("shift")
    )
    return segments.segment_ordinals(rows, 120).select("transcript_id", F.col("order").alias("position"), "tokens", "segment")


_ORDINALS = """
    WITH RECURSIVE t AS (
        SELECT CAST(conv_id AS VARCHAR) AS c, turn, len(list_filter(string_split_regex(trim(coalesce(text, ''), ' \t\n\r'), '\\s+'), lambda x: x <> '')) AS n,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations
    ), f AS (
        SELECT c, turn, n, k, n AS held, CAST(0 AS BIGINT) AS seg FROM t WHERE k = 1
        UNION ALL
        SELECT t.c, t.turn, t.n, t.k, CASE WHEN f.held + t.n > 120 THEN t.n ELSE f.held + t.n END, f.seg + CASE WHEN f.held + t.n > 120 THEN 1 ELSE 0 END
        FROM f JOIN t ON t.c = f.c AND t.k = f.k + 1
    )
    SELECT c AS transcript_id, turn AS position, n AS tokens, seg AS segment FROM f
"""


def q16_redaction_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as one-line transcripts: pattern spans, placeholders, replacement, residual check."""
    rows = _t(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("transcript_id"), F.lit(0).cast("long").alias("index"), F.lit(0).cast("long").alias("speaker_id"),
        F.lit("Jordan Smith").alias("speaker_name"), F.col("text").alias("sentence"), F.lit(None).cast("double").alias("time"), F.lit(None).cast("double").alias("end_time"),
    )
    made = privacy.reports(privacy.redact(rows, Settings()))
    return made.select(
        "transcript_id", "replacement_count", "conflict_count", F.round("redacted_character_ratio", 9).alias("redacted_character_ratio"), "review_required",
        F.to_json("category_counts").alias("category_counts"), F.to_json("residual_category_counts").alias("residual_category_counts"),
    )


def q16_classification_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "labels").select(_kind("doc_id").alias("source_set"))
    return classify.classification_counts(rows)


# --- patterns, hashes, groups ---------------------------------------------------------------


def _found(docs: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """``doc_id, kind, n, value`` of several kinds in one scan."""
    each = F.array(*(F.struct(F.lit(kind).alias("kind"), scalar.matches(F.col("text"), kind).alias("values")) for kind in kinds))
    return docs.select("doc_id", F.explode(each).alias("e")).select("doc_id", "e.kind", F.posexplode("e.values").alias("n", "value"))


def q8_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts; e-mail and IPv4 addresses."""
    return _found(_t(spark, sf_dir, "documents"), ("EMAIL_ADDRESS", "IP_ADDRESS")).select("doc_id", "kind", F.col("n").cast("long").alias("n"), "value")


_ADDRESSES = r"""
    WITH m AS (
        SELECT doc_id, 'EMAIL_ADDRESS' AS kind, regexp_extract_all(text, '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b') AS v FROM documents
        UNION ALL
        SELECT doc_id, 'IP_ADDRESS', regexp_extract_all(text, '\b(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}\b') FROM documents
    )
    SELECT doc_id, kind, unnest(range(0, len(v))) AS n, unnest(v) AS value FROM m
"""


def q9_cards_and_phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts; cards that pass the check, and phone numbers. DuckDB's patterns have no look-behind."""
    return _found(_t(spark, sf_dir, "documents"), ("CREDIT_CARD", "PHONE_NUMBER", "US_SSN"))


def q10_top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``top`` report of a chart: the largest categories per source and month."""
    chart = charts.CHARTS[0]
    rows = metrics.topic_prevalence(_order_members(spark, sf_dir).withColumn("topic_id", F.pmod(F.col("segment_id").cast("long"), F.lit(13)).cast("string")), spark.createDataFrame([], "topic_id string, label string"))
    return charts.chart_rows(rows, chart).select("chart_point_id", "category", "numerator", F.col("rank").cast("long").alias("rank"))


_TOP = """
    WITH g AS (
        SELECT o_orderpriority AS s, strftime(o_orderdate, '%Y-%m') AS w, CAST(o_orderkey % 13 AS VARCHAR) AS t, count(*) AS n FROM orders GROUP BY 1, 2, 3
    ), r AS (SELECT *, concat_ws('|', 'topic_month', s, w, t) AS p FROM g),
    k AS (SELECT *, row_number() OVER (PARTITION BY s, w ORDER BY n DESC, p) AS rank FROM r)
    SELECT p AS chart_point_id, t AS category, n AS numerator, rank FROM k WHERE rank <= 5
"""


def q11_overlap_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select(
        "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("start"), (F.unix_micros(F.col("ts").cast("timestamp")) + (F.col("value") * 3_600_000_000).cast("long")).alias("end")
    )
    grouped = spans.overlap_groups(rows, "user_id")
    return grouped.groupBy("user_id", "grp").agg(F.count("*").alias("members"), F.min("start").alias("first_start"), F.max("end").alias("last_end"))


_OVERLAP = """
    WITH x AS (SELECT user_id, epoch_us(ts) AS a, epoch_us(ts) + CAST(trunc(value * 3600000000) AS BIGINT) AS b FROM events),
    m AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM x),
    g AS (SELECT *, CAST(sum(CASE WHEN reach IS NULL OR a >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS BIGINT) AS grp FROM m)
    SELECT user_id, grp, count(*) AS members, min(a) AS first_start, max(b) AS last_end FROM g GROUP BY 1, 2
"""


def q12_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = _order_members(spark, sf_dir)
    rows = members.select(F.concat_ws("|", F.lit("topic_all"), "source_set", "topic_id").alias("chart_point_id"), F.lit(None).cast("string").alias("finding_id"), "segment_id", "transcript_id")
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("segment_id"), F.col("o_orderstatus").alias("text"))
    calls = _t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("transcript_id"), F.col("c_name").alias("relative_path"), F.col("c_nationkey").alias("transcript_datetime"))
    out = lineage.lineage(rows, orders, calls, chart_point_id="topic_all|1-URGENT|F")
    return out.select("chart_point_id", "segment_id", "transcript_id", "segment_text", "relative_path")


_LINEAGE = """
    SELECT 'topic_all|1-URGENT|F' AS chart_point_id, CAST(o_orderkey AS VARCHAR) AS segment_id, CAST(o_custkey AS VARCHAR) AS transcript_id, o_orderstatus AS segment_text, c_name AS relative_path
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
"""


def q13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return _t(spark, sf_dir, "documents").select(
        "doc_id", F.sha2(text.cast("binary"), 256).alias("content_hash"), F.octet_length(text).cast("long").alias("size_bytes"), scalar.word_count(text).alias("words")
    )


def q15_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id", "source")


def q15_not_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containment anti-join: line items whose price range lies in no range of their part."""
    items = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("part"), F.floor("l_quantity").cast("long").alias("start"), (F.floor("l_quantity").cast("long") + 2).alias("end")
    )
    parts = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.col("p_size").cast("long").alias("start"), (F.col("p_size") + 20).cast("long").alias("end"))
    return spans.not_contained(items, parts, "part").select("l_orderkey", "l_linenumber")


def q17_document_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per source with the most frequent language of each."""
    docs = _t(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    order = W.Window.partitionBy("source").orderBy(F.desc("n"), "lang")
    return docs.withColumn("r", F.row_number().over(order)).groupBy("source").agg(
        F.sum("n").alias("documents"), F.max_by("lang", -F.col("r")).alias("main_lang"), F.count("*").alias("langs")
    )


def q18_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming count's aggregation, over a finished table."""
    from callsift.streaming.rates import monthly_counts

    rows = _t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return monthly_counts(rows, "ts", ["event_type"]).select("month", F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "n")


def q19_topic_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-based terms of documents, the source as the topic."""
    docs = _t(spark, sf_dir, "documents")
    ids = F.col("doc_id").cast("string").alias("segment_id")
    assigned = docs.select(F.lit("customer-topic-v1").alias("topic_version"), F.col("source").alias("topic_id"), F.lit(0).alias("cluster_id"), ids, F.lit(False).alias("is_outlier"))
    return topics.topic_terms(assigned, docs.select(ids, "text")).select("topic_id", "rank", "term")


def _scratch(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or "/tmp/checkpoints"
    return f"{base.rstrip('/')}/callsift-run-{uuid.uuid4().hex}"


def _calls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Conversations as transcripts and utterances; their start is spread over months by identifier."""
    lines = _utterances(spark, sf_dir)
    day = F.date_add(F.lit("2026-01-01").cast("date"), F.pmod(F.col("transcript_id").cast("long"), F.lit(90)).cast("int"))
    month, text = F.date_format(day, "yyyy-MM"), F.coalesce("sentence", F.lit(""))
    calls = lines.groupBy("transcript_id").agg(F.count("*").alias("utterance_count"), F.sha2(F.array_join(F.array_sort(F.collect_list(text)), "\n"), 256).alias("content_hash"))
    calls = calls.withColumns({"transcript_datetime": day.cast("timestamp"), "transcript_month": month, "relative_path": F.concat(F.col("transcript_id"), F.lit("/transcript.json"))})
    names = SCHEMAS["transcripts"].names
    for f in SCHEMAS["transcripts"].fields:
        if f.name not in calls.columns:
            calls = calls.withColumn(f.name, F.lit(None).cast(f.dataType))
    return calls.select(*names), lines.withColumn("sentence", text)


def _whole_run(spark: SparkSession, sf_dir: str):
    from callsift.plans.run import run_pipeline

    return run_pipeline(spark, _calls(spark, sf_dir), _scratch(spark))


def q20_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step over all conversations, from redaction to rates; the metrics."""
    run = _whole_run(spark, sf_dir)
    return tables.read_table(spark, run.stage_dir("aggregation"), "metrics").drop("filters")


def q21_run_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows behind the metrics of such a run, counted by metric."""
    run = _whole_run(spark, sf_dir)
    rows = tables.read_table(spark, run.stage_dir("aggregation"), "metric_contributors")
    return rows.groupBy("chart_point_id").agg(F.count("*").alias("members"), F.countDistinct("transcript_id").alias("transcripts"))


def q22_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations cut at topic shifts and at the cap, by hashed word vectors."""
    rows = _utterances(spark, sf_dir).withColumn("sentence", F.coalesce("sentence", F.lit("")))
    kinds = rows.select("transcript_id").distinct().withColumn("source_set", _kind("transcript_id"))
    made = segments.create_segments(turns.materialize_turns(rows, kinds), HashEmbedder(), Settings(maximum_segment_tokens=60))
    return made.select("segment_id", "transcript_id", F.col("order").alias("position"), "first_turn_id", "last_turn_id", F.size("turn_ids").cast("long").alias("turns"), "token_count")


#: Closing lines that give the invented prose something to find.
CLOSINGS = (
    "", "Thanks, the outage is resolved and we are happy.", "We wish for a feature, else we cancel at renewal.", "It is slow and we are frustrated with the delay.",
    "I will send the upgrade by Friday; no competitor is interested.", "Our capacity is a concern, a terrible problem.",
)


def q23_extracted_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of documents, each with a closing line as one segment, by keyword rules."""
    ids = F.col("doc_id").cast("string")
    closing = F.get(F.array(*map(F.lit, CLOSINGS)), F.pmod("doc_id", F.lit(len(CLOSINGS))).cast("int"))
    segs = _t(spark, sf_dir, "documents").select(
        ids.alias("segment_id"), ids.alias("transcript_id"), _kind("doc_id").alias("source_set"), F.concat_ws("\n", F.coalesce("text", F.lit("")), closing).alias("text")
    )
    return findings.extract_findings(segs, RuleModel(), Settings()).select("finding_id", "segment_id", "source_set", "finding_type", "target", "value")


QUERIES = {
    "q1_prevalence_monthly": q1_prevalence_monthly, "q2_prevalence_all_time": q2_prevalence_all_time, "q2_prevalence_both": q2_prevalence_both,
    "q3_finding_metrics": q3_finding_metrics, "q3_contributor_counts": q3_contributor_counts, "q4_proposals": q4_proposals, "q4_kept_findings": q4_kept_findings,
    "q5_nearest_to_centroid": q5_nearest_to_centroid, "q5_cluster_metadata": q5_cluster_metadata, "q6_topic_shift": q6_topic_shift,
    "q7_turns": q7_turns, "q7_openings": q7_openings, "q8_addresses": q8_addresses, "q9_cards_and_phones": q9_cards_and_phones, "q10_top_per_group": q10_top_per_group,
    "q11_overlap_groups": q11_overlap_groups, "q12_lineage": q12_lineage, "q13_fingerprints": q13_fingerprints, "q14_segment_ordinals": q14_segment_ordinals,
    "q15_unlabelled": q15_unlabelled, "q15_not_contained": q15_not_contained, "q16_redaction_reports": q16_redaction_reports,
    "q16_classification_counts": q16_classification_counts, "q17_document_mix": q17_document_mix, "q18_daily_counts": q18_daily_counts, "q19_topic_terms": q19_topic_terms,
    "q20_run_metrics": q20_run_metrics, "q21_run_contributors": q21_run_contributors, "q22_segments": q22_segments, "q23_extracted_findings": q23_extracted_findings,
}

ORACLE_SQL = {
    "q1_prevalence_monthly": _PREVALENCE.format("'month'"), "q2_prevalence_all_time": _PREVALENCE.format("'all'"), "q2_prevalence_both": _PREVALENCE.format("'month', 'all'"),
    "q3_finding_metrics": _FINDINGS, "q3_contributor_counts": _CONTRIBUTORS,
    "q4_proposals": f"WITH {_PROPOSED} SELECT t AS proposed_type, n AS finding_count, s AS segment_count, s >= 20 AS promoted, n AS ids FROM p",
    "q4_kept_findings": f"WITH {_PROPOSED} SELECT f.* FROM f LEFT JOIN p ON f.finding_type = p.t WHERE p.t IS NULL OR p.s >= 20",
    "q5_nearest_to_centroid": _NEAREST, "q5_cluster_metadata": _CLUSTERS, "q6_topic_shift": _SHIFT,
    "q7_turns": f"""
        SELECT conv_id || ':' || turn AS turn_id, CAST(conv_id AS VARCHAR) AS transcript_id, {_KIND.format('conv_id')} AS source_set, turn AS position, role AS speaker, text
        FROM conversations
    """,
    "q7_openings": """
        WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations)
        SELECT CAST(conv_id AS VARCHAR) AS transcript_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS dialogue FROM t WHERE k <= 3 GROUP BY conv_id
    """,
    "q8_addresses": _ADDRESSES, "q10_top_per_group": _TOP, "q11_overlap_groups": _OVERLAP, "q12_lineage": _LINEAGE,
    "q13_fingerprints": """
        SELECT doc_id, sha256(coalesce(text, '')) AS content_hash, strlen(coalesce(text, '')) AS size_bytes,
               len(list_filter(string_split_regex(trim(coalesce(text, '')), '\\s+'), lambda x: x <> '')) AS words FROM documents
    """,
    "q14_segment_ordinals": _ORDINALS,
    "q15_unlabelled": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "q15_not_contained": """
        SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS (
            SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= floor(l_quantity) AND floor(l_quantity) + 2 <= p.p_size + 20)
    """,
    "q16_classification_counts": f"""
        WITH k AS (SELECT unnest(['customer-support', 'account-manager', 'internal-discuss']) AS s), l AS (SELECT {_KIND.format('doc_id')} AS s FROM labels)
        SELECT k.s AS source_set, count(l.s) AS calls FROM k LEFT JOIN l ON k.s = l.s GROUP BY 1
    """,
    "q17_document_mix": """
        WITH g AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS r FROM g)
        SELECT source, CAST(sum(n) AS BIGINT) AS documents, min(CASE WHEN r = 1 THEN lang END) AS main_lang, count(*) AS langs FROM r GROUP BY 1
    """,
    "q18_daily_counts": "SELECT strftime(ts, '%Y-%m') AS month, strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2, 3",
}
