"""Calls to kinds of call, by a language-model provider."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.operators.turns import dialogues
from callsift.providers.calls import LanguageModel, map_calls
from callsift.schemas import SOURCE_SETS, conform
from callsift.settings import Settings

#: What the model is asked for; the answer has these fields.
INSTRUCTIONS = (
    "Decide which kind of call this is from its first lines. Answer with source_set "
    f"({', '.join(SOURCE_SETS)}), confidence between 0 and 1, and a one-sentence rationale."
)


def ask(utterances: DataFrame, provider: LanguageModel, settings: Settings) -> DataFrame:
    """The model's answer for the opening of every transcript, with the tokens it took."""
    opening = dialogues(utterances, first=settings.classify_utterance_window)
    return map_calls(
        opening.select("transcript_id", F.lit(INSTRUCTIONS).alias("instructions"), F.col("dialogue").alias("prompt")),
        "transcript_id", "classify", "source_set string, confidence double, rationale string", provider, settings,
    )


def classified(answers: DataFrame, settings: Settings) -> DataFrame:
    """One classification per transcript; ``low_confidence`` is strictly below the threshold."""
    low = F.col("confidence") < F.lit(settings.classify_confidence_threshold)
    return conform(answers.select("transcript_id", "source_set", "confidence", "rationale", low.alias("low_confidence")), "classifications")


def classify(utterances: DataFrame, provider: LanguageModel, settings: Settings) -> DataFrame:
    return classified(ask(utterances, provider, settings), settings)


def classification_counts(classifications: DataFrame) -> DataFrame:
    """``source_set, calls`` with a row for every kind of call."""
    kinds = classifications.sparkSession.createDataFrame([(s,) for s in SOURCE_SETS], "source_set string")
    counts = classifications.groupBy("source_set").agg(F.count("*").alias("calls"))
    return kinds.join(counts, "source_set", "left").select("source_set", F.coalesce("calls", F.lit(0)).cast("long").alias("calls"))


def confidence_reviews(classifications: DataFrame, threshold: float) -> DataFrame:
    rows = classifications.where("low_confidence").select(
        F.concat(F.lit("classify:"), "transcript_id").alias("review_id"), F.lit("classify").alias("review_type"), "transcript_id",
        F.format_string("confidence %.2f below %s", "confidence", F.lit(str(threshold))).alias("reason"), F.lit("pending").alias("status"),
    )
    return conform(rows, "review_queue")
