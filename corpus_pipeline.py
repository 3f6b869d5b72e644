"""From raw documents to training sequences: filter, deduplicate, redact, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``documents``. Rows with null texts pass through as empty texts,
empty tables stay empty, and columns beyond those of ``documents`` are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.llm._shared import materialize
from callsift.llm.exact_dedup import drop_exact_copies
from callsift.llm.packing import pack_documents
from callsift.llm.queries import held_out, vocabulary
from callsift.llm.secrets import redact_secrets
from callsift.llm.simhash import drop_near_copies
from callsift.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels.where(~held_out(F.col("doc_id"))))
    return drop_toxic(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest identifier stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts with a five-word shingle similarity of 0.8 or more the smallest identifier stays.

    SimHash components by Golay keys gather them, a prefix filter joins those that fingerprints leave apart.
    """
    return drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; the spans of secrets in it are replaced."""
    clean = redact_secrets(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("packing", packing),
]

#: No stage but the second can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
