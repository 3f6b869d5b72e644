"""Turns to segments: a greedy fold that cuts at topic shifts and at the token cap."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.functions.scalar import word_count
from callsift.operators.vectors import embedding_column, neighbour_similarity
from callsift.schemas import SCHEMAS, conform
from callsift.settings import Settings
from callsift.shipping import ship


def cuts(tokens: list[int], shifts: list[bool], cap: int) -> list[int]:
    """Segment ordinal of each turn. A cut needs a turn before it, so one turn over the cap stays whole.

    ``tokens`` are the turns' own counts; a segment's count is their sum.
    """
    ordinals, current, held = [], 0, 0
    for i, (n, shift) in enumerate(zip(tokens, shifts)):
        if held and (shift or current + n > cap):
            ordinals.append(ordinals[-1] + 1)
            current, held = n, 1
        else:
            ordinals.append(ordinals[-1] if i else 0)
            current, held = current + n, held + 1
    return ordinals


def cuts_by_text(lines: list[str], shifts: list[bool], cap: int, count: Callable[[str], int]) -> list[int]:
    """The same fold where ``count`` measures a segment's whole text, as a tokenizer does."""
    ordinals, held = [], []
    for line, shift in zip(lines, shifts):
        cut = bool(held) and (shift or count("\n".join([*held, line])) > cap)
        held = [line] if cut else [*held, line]
        ordinals.append(ordinals[-1] + cut if ordinals else 0)
    return ordinals


def _folded(turns: DataFrame, fold: Callable[[pa.Table], list[int]]) -> DataFrame:
    """``turns`` with ``segment``. State resets at each cut, which no window frame can say, so each
    transcript is folded once, whole."""
    ship(turns.sparkSession)
    schema = T.StructType([*turns.schema.fields, T.StructField("segment", T.LongType())])

    def run(table: pa.Table) -> pa.Table:
        ordered = table.sort_by("order")
        return ordered.append_column("segment", pa.array(fold(ordered), pa.int64()))

    return turns.groupBy("transcript_id").applyInArrow(run, schema)


def segment_ordinals(turns: DataFrame, cap: int) -> DataFrame:
    """``turns`` with ``segment``, by the turns' own token counts; reads ``transcript_id, order, tokens, shift``."""
    return _folded(turns, lambda t: cuts(t.column("tokens").to_pylist(), t.column("shift").to_pylist(), cap))


def create_segments(turns: DataFrame, provider, settings: Settings) -> DataFrame:
    """Segments with their turns, speakers in order of appearance, and text.

    The cap holds for the provider's tokens of the segment's whole text; ``token_count`` is words.
    """
    ship(turns.sparkSession)
    line = F.concat("speaker", F.lit(": "), "text")
    cap, count = settings.maximum_segment_tokens, provider.tokens
    rows = turns.withColumn("embedding", embedding_column(provider)("text")).withColumn("line", line)
    rows = neighbour_similarity(rows, "transcript_id", "order", settings.semantic_similarity_threshold)
    rows = _folded(
        rows.select("transcript_id", "order", "turn_id", "speaker", "source_set", "line", "shift"),
        lambda t: cuts_by_text([x or "" for x in t.column("line").to_pylist()], t.column("shift").to_pylist(), cap, count),
    )
    item = F.struct(F.col("order").alias("o"), "turn_id", "speaker", "source_set", "line")
    grouped = rows.groupBy("transcript_id", "segment").agg(F.array_sort(F.collect_list(item)).alias("t"))
    ids, text = F.transform("t", lambda x: x["turn_id"]), F.array_join(F.transform("t", lambda x: x["line"]), "\n")
    out = grouped.select(
        F.concat_ws(":", "transcript_id", F.lit("seg"), F.col("segment").cast("string")).alias("segment_id"),
        "transcript_id",
        F.col("t")[0]["source_set"].alias("source_set"),
        F.col("segment").alias("order"),
        F.element_at(ids, 1).alias("first_turn_id"),
        F.element_at(ids, -1).alias("last_turn_id"),
        ids.alias("turn_ids"),
        F.array_distinct(F.transform("t", lambda x: x["speaker"])).alias("speakers"),
        text.alias("text"),
        word_count(text).alias("token_count"),
    )
    return conform(out.select(*SCHEMAS["segments"].names), "segments")
