"""Schemas of all tables, their closed domains and ranges, and checks of both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values. Their order breaks ties.
SOURCE_SETS = ("customer-support", "account-manager", "internal-discuss")

# Finding types by kind of call.
CUSTOMER_FINDINGS = (
    "sentiment", "process_friction", "resolution", "objection", "renewal_risk",
    "feature_request", "opportunity", "commitment", "competitive_risk",
)
INTERNAL_FINDINGS = (
    "sentiment", "operational_risk", "delivery_risk", "competitive_risk",
    "renewal_risk", "opportunity", "commitment", "capacity_constraint",
)
CUSTOMER_TOPICS, INTERNAL_TOPICS = "customer-topic-v1", "internal-topic-v1"



SPAN = "struct<start:int,end:int,entity_type:string,value:string,score:double,detector:string,action:string,conflict:boolean>"

DDL = {
    "raw_transcript": "data array<struct<index:bigint,speaker_id:bigint,speaker_name:string,sentence:string,time:double,endTime:double,averageConfidence:double,sentimentType:string>>",
    "meeting_info": "startTime string, endTime string, duration double",
    "transcripts": "transcript_id string, relative_path string, transcript_datetime timestamp, transcript_month string, end_time timestamp, duration_minutes double, utterance_count bigint, content_hash string, size_bytes bigint, ingestion_status string",
    "utterances": "transcript_id string, index bigint, speaker_id bigint, speaker_name string, sentence string, time double, end_time double",
    "redacted_utterances": "transcript_id string, index bigint, speaker_id bigint, speaker_name string, sentence string, time double, end_time double",
    "pseudonymized_transcripts": f"transcript_id string, transcript_datetime timestamp, replacement_count bigint, unique_replacement_count bigint, conflict_count bigint, redacted_character_ratio double, residual_findings array<{SPAN}>, review_required boolean",
    "redaction_reports": "transcript_id string, category_counts map<string,bigint>, unique_category_counts map<string,bigint>, replacement_count bigint, conflict_count bigint, redacted_character_ratio double, residual_category_counts map<string,bigint>, review_required boolean",
    "pii_mappings": "transcript_id string, placeholder string, surface string",
    "review_queue": "review_id string, review_type string, transcript_id string, reason string, status string",
    "classifications": "transcript_id string, source_set string, confidence double, rationale string, low_confidence boolean",
    "turns": "turn_id string, transcript_id string, source_set string, order bigint, speaker string, text string, time double, end_time double",
    "segments": "segment_id string, transcript_id string, source_set string, order bigint, first_turn_id string, last_turn_id string, turn_ids array<string>, speakers array<string>, text string, token_count bigint",
    "segment_embeddings": "segment_id string, transcript_id string, embedding array<float>",
    "topic_assignments": "topic_version string, topic_id string, cluster_id int, segment_id string, transcript_id string, source_set string, is_outlier boolean",
    "cluster_metadata": "topic_version string, topic_id string, cluster_id int, cluster_size bigint, source_distribution map<string,bigint>, is_outlier boolean",
    "topic_terms": "topic_version string, topic_id string, cluster_id int, rank int, term string",
    "centroid_segments": "topic_version string, topic_id string, cluster_id int, rank int, segment_id string",
    "topics": "topic_version string, topic_id string, cluster_id int, label string, description string, terms array<string>, centroid_segment_ids array<string>, cluster_size bigint, source_distribution map<string,bigint>, model string, prompt_version string",
    "findings": "finding_id string, request_id string, transcript_id string, segment_id string, source_set string, finding_type string, target string, value string, reason string, model string, prompt_version string",
    "metrics": "metric_id string, chart_point_id string, metric_type string, source_set string, time_window string, category string, numerator bigint, denominator bigint, value double, distinct_transcripts bigint, polarity string, filters map<string,string>",
    "metric_contributors": "chart_point_id string, membership_role string, exclusion_reason string, finding_id string, topic_id string, segment_id string, transcript_id string",
}


class _Schemas(dict):
    """Parsed on first use: parsing needs a session, importing must not."""

    def __missing__(self, name: str) -> T.StructType:
        self[name] = T.StructType.fromDDL(DDL[name])
        return self[name]


SCHEMAS: dict[str, T.StructType] = _Schemas()

#: Columns with a closed set of values.
DOMAINS = {
    "source_set": SOURCE_SETS,
    "ingestion_status": ("ingested",),
    "action": ("redact", "preserve"),
    "review_type": ("privacy", "classify"),
    "status": ("pending",),
    "polarity": ("positive", "negative", "neutral"),
    "membership_role": ("numerator", "denominator", "excluded"),
    "metric_type": ("topic_prevalence_monthly", "topic_prevalence_all_time", "sentiment_distribution", "finding_prevalence"),
}
#: Columns within 0..1.
SHARES = ("confidence", "redacted_character_ratio")


def conform(df: DataFrame, name: str) -> DataFrame:
    """``df`` with exactly the columns and types of table ``name``; unknown or missing columns are an error."""
    schema = SCHEMAS[name]
    unknown, missing = set(df.columns) - set(schema.names), set(schema.names) - set(df.columns)
    if unknown or missing:
        raise ValueError(f"{name}: unknown columns {sorted(unknown)}, missing {sorted(missing)}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def checked(df: DataFrame) -> DataFrame:
    """``df`` that raises, while it is read, on a value outside its column's domain or range."""
    out = df
    for name in df.columns:
        ok = None
        if name in DOMAINS:
            ok = F.col(name).isNull() | F.col(name).isin(*DOMAINS[name])
        elif name in SHARES:
            ok = F.col(name).isNull() | F.col(name).between(0.0, 1.0)
        if ok is not None:
            bad = F.concat(F.lit(f"{name} out of domain: "), F.col(name).cast("string"))
            out = out.withColumn(name, F.when(ok, F.col(name)).otherwise(F.raise_error(bad).cast(df.schema[name].dataType)))
    return out
