"""Proportional stratified interleaving of documents into shards.

Rows are shuffled by a seeded hash within each source and ranked there; rank
``r`` of a source with ``n`` rows stands at ``(r + phase) / n``; the phase, between 0 and
1, is a seeded hash of the source, so that sources of equal size do not fall into step. Sorting all rows by
that fraction interleaves the sources in proportion, and cutting the sorted rows
into runs of equal length gives shards whose source mixture matches the whole.
Law ``rows``: shard sizes in rows are at most one apart.

Both rankings are distributed: rows are range-partitioned by keys that end in the
seeded hash, so a source with a third of all rows spreads over many tasks, and
only per-partition counts are added up.

Edge cases: a null source is a source of its own; null texts have no bytes; null
identifiers sort first; ties of the hash fall back to identifier, checksum, size; repeated
rows have a place each; the length of a text does not matter to its place; an empty table
gives no rows; further columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from callsift.llm._shared import with_position

LAW = "rows"
#: Bytes counted for each document besides its text.
ROW_OVERHEAD = 8


def drawn(seed: int, value: Column, bits: int) -> Column:
    """A number of so many bits (a multiple of four) from the seed and a text; null counts as empty."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(value, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, bits // 4), 16, 10).cast("long")


def interleave(
    docs: DataFrame,
    n_shards: int,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``id_col, source, size, text_crc32, fraction, shard, slot`` for every row of ``docs``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
    ).withColumn("draw", drawn(seed, F.col("id").cast("string"), 60))
    tie = ["draw", "id", "crc", "size"]

    ranked = with_position(base, ["source", *tie])
    runs = ranked.groupBy("_part", "source").agg(F.min("_row").alias("first"), F.count("*").alias("n"))
    over = W.Window.partitionBy("source")
    runs = runs.select(
        F.col("_part").alias("p"),
        F.col("source").alias("s"),
        (F.sum("n").over(over.orderBy("_part")) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(over).alias("total"),
    )
    phase = (drawn(seed, F.col("source"), 20) + 0.5) / (1 << 20)
    same_run = (F.col("_part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))
    placed = ranked.join(runs, same_run).select(
        "id", "source", "size", "crc", "draw",
        ((F.col("_row") + F.col("shift") + phase) / F.col("total")).alias("fraction"),
    )

    lined = with_position(placed, ["fraction", *tie])
    parts = lined.groupBy("_part").agg(F.count("*").alias("n"))
    # One row per range partition: the number of partitions, not of documents.
    starts = parts.select(
        F.col("_part").alias("p"),
        (F.sum("n").over(W.Window.orderBy("_part")) - F.col("n")).alias("start"),
        F.sum("n").over(W.Window.partitionBy()).alias("total"),
    )

    at = lined.join(starts, F.col("_part") == F.col("p")).withColumn("at", F.col("_row") + F.col("start"))
    at = at.withColumn("shard", F.expr(f"at * {int(n_shards)}L div total"))
    first = F.expr(f"(shard * total + {int(n_shards) - 1}L) div {int(n_shards)}L")
    return at.select(
        F.col("id").alias(id_col), "source", "size", F.col("crc").alias("text_crc32"), "fraction",
        F.col("shard").cast("int").alias("shard"), (F.col("at") - first).alias("slot"),
    )
