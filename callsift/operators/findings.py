"""Findings per segment, and types that the model proposes beyond the vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.providers.calls import LanguageModel, map_calls
from callsift.schemas import CUSTOMER_FINDINGS, INTERNAL_FINDINGS, conform
from callsift.settings import Settings

ANSWER = "findings array<struct<finding_type:string,target:string,value:string,reason:string>>"


def _ask_for(vocabulary: tuple[str, ...]) -> str:
    return (
        "List what stands out in this passage of a call, most important first. Each finding has a finding_type "
        f"(one of {', '.join(vocabulary)}, or a new short type if none fits), a target, a value and a reason."
    )


def instructions(source_set: Column) -> Column:
    return F.when(source_set == "internal-discuss", _ask_for(INTERNAL_FINDINGS)).otherwise(_ask_for(CUSTOMER_FINDINGS))


def ask(segments: DataFrame, provider: LanguageModel, settings: Settings) -> DataFrame:
    """The model's answer for every segment, with the tokens it took."""
    asked = segments.select("segment_id", instructions(F.col("source_set")).alias("instructions"), F.col("text").alias("prompt"))
    return map_calls(asked, "segment_id", "findings", ANSWER, provider, settings)


def found(segments: DataFrame, answers: DataFrame, model: str, settings: Settings) -> DataFrame:
    """The first ``findings_per_segment_maximum`` findings of each segment, in the order given."""
    first = F.slice(F.col("findings"), 1, settings.findings_per_segment_maximum)
    rows = answers.select("segment_id", F.posexplode(first).alias("n", "f")).join(segments.select("segment_id", "transcript_id", "source_set"), "segment_id")
    out = rows.select(
        F.concat_ws(":", "segment_id", F.lit("finding"), F.col("n").cast("string")).alias("finding_id"),
        F.concat(F.lit("findings:"), "segment_id").alias("request_id"),
        "transcript_id", "segment_id", "source_set", "f.finding_type", "f.target", "f.value", "f.reason",
        F.lit(model).alias("model"), F.lit(settings.findings_prompt_version).alias("prompt_version"),
    )
    return conform(out, "findings")


def extract_findings(segments: DataFrame, provider: LanguageModel, settings: Settings) -> DataFrame:
    return found(segments, ask(segments, provider, settings), provider.name, settings)


def is_proposal(source_set: Column, finding_type: Column) -> Column:
    """A type outside the vocabulary of the row's own kind of call."""
    return F.when(source_set == "internal-discuss", ~finding_type.isin(*INTERNAL_FINDINGS)).otherwise(~finding_type.isin(*CUSTOMER_FINDINGS))


def proposals(findings: DataFrame, promotion_minimum: int) -> DataFrame:
    """One row per proposed type; promoted if proposed in enough different segments."""
    rows = findings.where(is_proposal(F.col("source_set"), F.col("finding_type")))
    return rows.groupBy(F.col("finding_type").alias("proposed_type")).agg(
        F.count("*").alias("finding_count"),
        F.countDistinct("segment_id").alias("segment_count"),
        (F.countDistinct("segment_id") >= promotion_minimum).alias("promoted"),
        F.sort_array(F.collect_set("segment_id")).alias("segment_ids"),
        F.sort_array(F.collect_list("finding_id")).alias("finding_ids"),
    )


def keep_findings(findings: DataFrame, promotion_minimum: int) -> DataFrame:
    """Findings whose type nobody proposed, or that was promoted.

    Proposals count by type alone: a customer type proposed once on an internal call drops
    the customers' rows of that type as well, unless it is promoted.
    """
    tally = findings.where(is_proposal(F.col("source_set"), F.col("finding_type"))).groupBy("finding_type").agg(
        (F.countDistinct("segment_id") >= promotion_minimum).alias("__promoted")
    )
    return findings.join(tally, "finding_type", "left").where(F.coalesce("__promoted", F.lit(True))).select(*findings.columns)
