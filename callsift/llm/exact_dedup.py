"""Exact deduplication over an extendible-hash index on shared files.

Every text has a 64-bit key. The index is an extendible hash: a *directory* names, by the
leading bits of a key, the *bucket* that holds it, and a bucket with more than
``bucket_capacity`` distinct keys is split by one more leading bit until none is overfull.
The directory lies in pages: the root page has ``2**ROOT_BITS`` slots; where a bucket is
still overfull there, its slot leads to a page that tells ``PAGE_BITS`` further bits apart,
and so on down to the last bit of the key. Pages are tables; the root page alone, whose size
is fixed, is broadcast, so neither the driver nor a task ever holds a directory that grows.

A bucket is a range of keys. The steps:

1. the distinct keys are counted map-side, without texts, and the directory is built from them;
2. every row looks its bucket up and probes it for a key that occurs more than once; only
   such rows keep their texts. The probe is a join without an aggregation behind it, so that a
   key which a third of all rows share is dealt to many tasks (adaptive skew handling);
3. equal texts are combined map-side, and owner tasks, each with a range of buckets, chain the
   different texts of a key, each compared byte by byte with the one before;
4. every row probes its bucket again, for its own text's entry.

Everything is DataFrame code. Edge cases: null and empty texts are equal to each other; a
null identifier sorts below every other; repeated rows count in ``group_size`` and share one
decision; very long texts are compared whole; an empty table has an empty index; further
columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from callsift.llm._shared import discard, materialize

#: Distinct keys per bucket before it is split.
BUCKET_CAPACITY = 4096
#: Leading bits that the root page of the directory tells apart, and those of each further page.
ROOT_BITS, PAGE_BITS = 16, 8


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64) -> DataFrame:
    """``id, text, key, sha``: whole texts with their index key and digest."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    return out.select("id", "text", key_of(F.col("text"), key_bits).alias("key"), sha_of(F.col("text")).alias("sha"))


def key_of(text: Column, key_bits: int = 64) -> Column:
    key = F.xxhash64(text)
    # Tests shorten keys to force collisions.
    return key if key_bits == 64 else F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)


def sha_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


class Directory:
    """Pages by level; ``locate`` adds the bucket that they name."""

    def __init__(self, pages: list[tuple[int, DataFrame]]):
        self.pages = pages

    def locate(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the ``bucket`` of their ``key``: the first key of its range."""
        for level, (bits, page) in enumerate(self.pages):
            page = page.select(F.col("slot").alias("__slot"), F.col("bucket").alias("__bucket"))
            rows = rows.join(page if level else F.broadcast(page), F.shiftrightunsigned("key", 64 - bits) == F.col("__slot"), "left")
            found = F.coalesce("bucket", "__bucket") if level else F.col("__bucket")
            rows = rows.withColumn("bucket", found).drop("__slot", "__bucket")
        return rows

    def discard(self) -> None:
        discard(*(page for _, page in self.pages))


def split_level(counts: DataFrame, low: int, bits: int, capacity: int) -> tuple[DataFrame, DataFrame]:
    """Doubling from ``low`` to ``bits`` leading bits of the buckets that are overfull at ``low``.

    ``counts`` has ``p, n``: distinct keys by ``bits``-bit prefix. Returns the buckets ``depth, p, n``
    that hold at most ``capacity`` keys, and the prefixes ``p`` that are overfull at ``bits``, too.
    """
    loads = (
        counts.select(F.explode(F.sequence(F.lit(low), F.lit(bits))).alias("depth"), "p", "n")
        .select("depth", F.expr(f"shiftrightunsigned(p, {bits} - depth)").alias("p"), "n")
        .groupBy("depth", "p").agg(F.sum("n").alias("n"))
    )
    overfull = loads.where(F.col("n") > capacity)
    parents = overfull.select((F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("p") * 2, F.col("p") * 2 + 1)).alias("p"))
    held = loads.where(F.col("n") <= capacity)
    split = held.join(parents, ["depth", "p"], "left_semi")
    if not low:  # the whole table may fit the one bucket that an index starts with
        split = split.unionByName(held.where("depth = 0"))
    return split, overfull.where(F.col("depth") == bits).select("p")


def build_directory(keys: DataFrame, capacity: int = BUCKET_CAPACITY) -> Directory:
    """The directory for a table of distinct ``key`` values; the driver only learns whether to go on."""
    pages, low, bits, left = [], 0, ROOT_BITS, keys.select("key")
    while True:
        counts = left.groupBy(F.shiftrightunsigned("key", 64 - bits).alias("p")).agg(F.count("*").alias("n"))
        counts = materialize(counts, "counts")
        buckets, overfull = split_level(counts, low, bits, capacity)
        first = F.expr(f"shiftleft(p, {bits} - depth)")
        slots = buckets.select(
            F.explode(F.sequence(first, first + F.expr(f"shiftleft(1L, {bits} - depth)") - 1)).alias("slot"),
            # Of keys without any leading bit, the one bucket.
            F.expr("if(depth = 0, 0L, shiftleft(p, 64 - depth))").alias("bucket"),
            "depth",
        )
        pages.append((bits, materialize(slots, "page")))
        overfull = materialize(overfull, "overfull")
        if bits == 64 or overfull.isEmpty():
            discard(counts, overfull)
            return Directory(pages)
        left = materialize(left.join(overfull, F.shiftrightunsigned("key", 64 - bits) == F.col("p"), "left_semi"), "left")
        low, bits = bits, bits + PAGE_BITS


def build_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_capacity: int = BUCKET_CAPACITY,
    key_bits: int = 64,
) -> tuple[Directory, DataFrame, bool]:
    """Directory, index entries of every text whose key occurs more than once, and whether rows repeat.

    Entries lie in shared files, ordered by owner: ``bucket, key, chain, sha, keep_id, group_size``;
    ``chain`` numbers the different texts of a key. A row repeats another if both its identifier
    and its text are the same.
    """
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col, key_bits)
    slots = materialize(rows.groupBy("key").agg(F.count("*").alias("n")), "slots")
    directory = build_directory(slots, bucket_capacity)

    # The keys grow with the input, so they are merged, never broadcast.
    repeated = directory.locate(slots.where("n > 1").select("key"))
    candidates = directory.locate(rows).join(repeated.hint("merge"), ["bucket", "key"], "left_semi")
    candidates = materialize(candidates, "candidates")
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    owned = (
        candidates.groupBy("bucket", "key", "sha", "text").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .repartitionByRange(owners, "bucket", "key")
    )
    chain = W.Window.partitionBy("bucket", "key").orderBy("sha", "text")
    # Two texts with one digest could not be told apart by the probe, which carries no texts.
    clash = (F.lag("sha").over(chain) == F.col("sha")) & (F.lag("text").over(chain) != F.col("text"))
    entries = owned.select("bucket", "key", F.row_number().over(chain).alias("chain"), "sha", "keep_id", "group_size", clash.alias("clash"))
    sure = F.when(F.coalesce("clash", F.lit(False)), F.raise_error(F.lit("different texts share a digest"))).otherwise(F.col("sha"))
    index = materialize(entries.withColumn("sha", sure).drop("clash"), "index")
    again = not candidates.groupBy("key", "sha", "id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    discard(candidates, slots)
    return directory, index, again


def probe(rows: DataFrame, directory: Directory, index: DataFrame) -> DataFrame:
    """``rows`` with ``keep_id, group_size`` of the entry in their bucket; null where their text occurs once."""
    groups = index.where("group_size > 1").select("bucket", "key", "sha", "keep_id", "group_size")
    return directory.locate(rows).join(groups.hint("merge"), ["bucket", "key", "sha"], "left")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_capacity: int = BUCKET_CAPACITY,
    key_bits: int = 64,
) -> DataFrame:
    """One decision per row of ``docs``: of equal texts the largest identifier stays.

    Returns ``id_col, keep_id, group_size, kept, text_sha256, bucket``.
    """
    directory, index, _ = build_index(docs, id_col, text_col, bucket_capacity, key_bits)
    rows = keyed(docs, id_col, text_col, key_bits).select("id", "key", "sha")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return probe(rows, directory, index).select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "bucket",
    )


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_capacity: int = BUCKET_CAPACITY, key_bits: int = 64
) -> DataFrame:
    """``docs`` with one row of each group of equal texts: that of the largest identifier.

    A null identifier stays only where its group has no other; of rows that repeat the
    identifier as well, one stays. All columns are kept, whatever their names.
    """
    directory, index, again = build_index(docs, id_col, text_col, bucket_capacity, key_bits)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).alias("id"), key_of(text, key_bits).alias("key"), sha_of(text).alias("sha")
    )
    left = probe(rows, directory, index).where("group_size is null or id <=> keep_id")
    if again:  # combined map-side, so a row that a third of all repeat costs a row a task
        left = left.dropDuplicates(["key", "sha"])
    return left.select("row.*")
