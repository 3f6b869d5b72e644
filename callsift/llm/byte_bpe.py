"""Byte-level BPE: higher-order functions fold ranked merges over byte arrays.

A piece of text (a match of the split pattern) starts as the array of its bytes' ids.
``aggregate`` folds one merge per step over it: every adjacent pair is looked up in a
literal rank map, and the lowest rank, leftmost first, is merged, until no pair has a
rank. The map is two literal arrays built from the rank file: row ``a`` of all pairs
``(a, b)`` starts at ``shift[a]`` of a shared table, an entry holds ``a`` and the rank, so
a lookup is two array reads. Ids are ranks, so a merged pair is its rank.

Only distinct words are folded: those that occur at least twice in a bounded sample of
documents once per run (they are kept in a dictionary whose size the sample bounds), all
others once per document that holds them. Which words the dictionary holds changes the
time, never the result. In pieces of more than ``LONG_PIECE`` bytes a step of the fold merges
all places of the lowest pair at once, from the left, wherever that comes to the same as one
after the other, and the fold ends early; so a step costs as much as the piece is long, but
there are as many steps as different merges, not as places. Texts are read where they lie;
only sample words are shuffled.

Decoding concatenates the pieces of bytes that ids stand for. Edge cases: null and empty
texts have no ids; special tokens are ordinary text; very long texts are coded whole, a few
megabytes at a time; rows are never joined by identifier, so repeated and null identifiers
need no care; an empty table has no rows; further columns are never read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from callsift.llm._arrow import map_texts
from callsift.shipping import ship

#: Documents whose words fill the dictionary.
SAMPLE_DOCS = 20_000
#: Bytes beyond which a step merges all places of a pair.
LONG_PIECE = 64
#: A pair's rank and place are one number: the rank in the bits from here on.
PLACE_BITS = 30
#: A short piece's pair: its rank in the bits from here on, then its index while the lowest is sought, then 16 bits of its first id.
ENTRY_BITS = 30
NO_PAIR = 1 << (ENTRY_BITS + 16)
NO_ID = 0xFFFF
#: Slots of the rank table; row ``a`` takes those from ``shift[a]`` on.
SLOTS = 1 << 20
HOLE = 0xFFFF


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    if max(ranks.values()) >= HOLE or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must fit 16 bits and cover all bytes")
    if max(ranks[bytes([b])] for b in range(256)) >= 1 << 15:
        raise ValueError("bytes must have the lowest ranks")
    return ranks


def rank_table(ranks: dict[bytes, int], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``(shift, table)``: pair ``(a, b)`` has rank ``r`` if ``table[shift[a] + b] == a << 16 | r``."""
    rows: dict[int, list[tuple[int, int]]] = {}
    for token, r in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                rows.setdefault(a, []).append((b, r))
    rng = np.random.default_rng(seed)
    table = np.full(SLOTS, HOLE << 16, np.int64)  # a left id that no token has
    shift = np.zeros(max(ranks.values()) + 1, np.int64)
    for a, entries in sorted(rows.items(), key=lambda x: -len(x[1])):
        bs, rs = np.array(entries).T
        while True:
            d = int(rng.integers(0, SLOTS - HOLE))
            if (table[d + bs] == HOLE << 16).all():
                break
        shift[a], table[d + bs] = d, a << 16 | rs
    return shift, table


def literal(spark: SparkSession, values: np.ndarray) -> Column:
    """A literal ``array<bigint>`` whose plan text stays short, however long it is."""
    from pyspark.sql.classic.column import Column as ClassicColumn

    jvm = spark._jvm
    flat = spark.sparkContext._gateway.new_array(jvm.long, len(values))
    jvm.java.nio.ByteBuffer.wrap(values.astype(">i8").tobytes()).asLongBuffer().get(flat)
    catalyst = jvm.org.apache.spark.sql.catalyst.expressions
    kinds = jvm.org.apache.spark.sql.types
    array = catalyst.UnsafeArrayData.fromPrimitiveArray(flat)
    expression = catalyst.Literal(array, kinds.ArrayType(kinds.DataTypes.LongType, False))
    return ClassicColumn(jvm.org.apache.spark.sql.classic.ExpressionUtils.column(expression))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def folded(ids: Column, shift: Column, table: Column, long: bool = False, begun: bool = False) -> Column:
    """The ids of one piece, given the ids of its bytes (``array<bigint>``); ``long`` chooses the steps, not the result.

    ``begun``: a short piece comes as its first entries, those of ``first_entries``.
    """
    none = F.lit(1 << (PLACE_BITS + 16))

    def rank(a: Column, b: Column) -> Column:
        """The pair's rank; larger than every rank if it has none."""
        return F.get(table, (F.get(shift, a.cast("int")) + b).cast("int")).bitwiseXOR(F.shiftleft(a, 16))

    def lowest(word: Column) -> Column:
        """Rank and place of the lowest pair, leftmost first."""
        pairs = F.slice(word, F.lit(1), F.size(word) - 1)
        return F.array_min(F.transform(pairs, lambda a, i: F.shiftleft(rank(a, F.get(word, i + 1)), PLACE_BITS) + i))

    def merged(word: Column, least: Column) -> Column:
        """``word`` with the one pair merged."""
        at = place(least)
        return F.concat(F.slice(word, F.lit(1), at), F.array(F.shiftright(least, PLACE_BITS)), F.slice(word, at + 3, F.size(word)))

    def place(least: Column) -> Column:
        return least.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")

    def all_places(word: Column, a: Column, b: Column, made: Column) -> Column:
        """``word`` with every pair (a, b) merged, from the left."""

        def twins(own: Column) -> Column:
            # Pairs (a, a): place less number is the same for all of a run; every second one of it goes.
            run = F.transform(own, lambda p, j: p - j)

            def value(p: Column, j: Column) -> Column:
                odd = (j - F.array_position(run, p - j) + 1) % 2 == 1
                return F.struct(p.alias("p"), F.when(odd, F.lit(-1).cast("long")).when(F.get(run, j + 1) == p - j, made).otherwise(a).alias("x"))

            other = F.filter(F.transform(word, lambda x, i: F.struct(i.cast("long").alias("p"), x.alias("x"))), lambda e: e["x"] != a)
            return F.transform(F.array_sort(F.concat(other, F.transform(own, value))), lambda e: e["x"])

        def single(x: Column, i: Column) -> Column:
            left = (x == a) & F.coalesce(F.get(word, i + 1) == b, F.lit(False))
            right = (x == b) & F.coalesce(F.get(word, i - 1) == a, F.lit(False))
            return F.when(left, made).when(right, F.lit(-1).cast("long")).otherwise(x)

        places = F.filter(F.transform(word, lambda x, i: F.when(x == a, i.cast("long")).otherwise(F.lit(-1).cast("long"))), lambda p: p >= 0)
        return F.filter(F.when(a == b, let(places, twins)).otherwise(F.transform(word, single)), lambda x: x >= 0)

    def many(state: Column, _: Column) -> Column:
        def step(word: Column, least: Column) -> Column:
            r, at = F.shiftright(least, PLACE_BITS), place(least)

            def choose(a: Column, b: Column) -> Column:
                # One after the other comes to the same unless a merge makes a lower pair on the way.
                return let(
                    all_places(word, a, b, r),
                    lambda whole: F.when((F.shiftright(F.coalesce(lowest(whole), none), PLACE_BITS) < r) | (rank(r, a) < r), merged(word, least)).otherwise(whole),
                )

            return choose(F.get(word, at), F.get(word, at + 1))

        def go(least: Column) -> Column:
            over = least.isNull() | (least >= none)
            return F.struct(
                F.when(over, state["w"]).otherwise(step(state["w"], least)).alias("w"),
                over.alias("over"),
            )

        return F.when(state["over"], state).otherwise(let(lowest(state["w"]), go))

    # A short piece keeps its pairs' ranks: an entry is the rank of the pair that begins there and its first id; an entry of no pair comes first.
    last = F.lit(NO_PAIR)
    indexes = F.lit([i << 16 for i in range(LONG_PIECE + 1)])

    def entry(a: Column, b: Column) -> Column:
        """The entry of ``a`` before ``b``, which is null at the end."""
        return F.coalesce(F.shiftleft(rank(a, b), ENTRY_BITS), last) + a

    def id_at(word: Column, at: Column) -> Column:
        return F.get(word, at).bitwiseAND(F.lit(NO_ID))

    def one(word: Column, _: Column) -> Column:
        """``word`` with its lowest pair, leftmost first, merged; only the two pairs that this makes are looked up."""

        def merge(least: Column) -> Column:
            made = F.shiftright(least, ENTRY_BITS)
            at = (F.shiftright(least, 16).bitwiseAND(F.lit((1 << (ENTRY_BITS - 16)) - 1))).cast("int")
            new = F.array(entry(id_at(word, at - 1), made), entry(made, id_at(word, at + 2)))
            parts = F.array(F.slice(word, F.lit(1), at - 1), new, F.slice(word, at + 3, F.lit(LONG_PIECE)))
            return F.when(least >= last, word).otherwise(F.flatten(parts))

        # The index comes with the rank: array_position would leave its loop by an exception at every step.
        return let(F.array_min(F.transform(word, lambda e, i: e + F.get(indexes, i))), merge)

    if not long:
        start = ids if begun else F.concat(F.array(F.lit(NO_PAIR + NO_ID)), F.transform(ids, lambda a, i: entry(a, F.get(ids, i + 1))))
        steps = F.sequence(F.lit(1), F.greatest(F.size(start) - 2, F.lit(1)))
        return F.aggregate(steps, start, one, lambda word: F.transform(F.slice(word, 2, LONG_PIECE), lambda e: e.bitwiseAND(F.lit(NO_ID))))
    steps = F.sequence(F.lit(1), F.greatest(F.size(ids) - 1, F.lit(1)))
    start = F.struct(ids.alias("w"), F.lit(False).alias("over"))
    return F.aggregate(steps, start, many, lambda s: s["w"])


def dictionary(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str, id_col: str, maps: tuple[Column, Column], sample_docs: int) -> dict[str, bytes]:
    """Ids, as 16-bit little-endian bytes, of the words that a sample of documents repeats."""
    ids = docs.select(F.col(id_col).alias("__k")).where("__k is not null")
    chosen = ids.orderBy(F.xxhash64("__k"), "__k").limit(sample_docs).distinct()
    sample = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("__k"), "left_semi")  # at most sample_docs identifiers
    start = [ranks[bytes([b])] for b in range(256)]

    def make():
        import regex

        split = regex.compile(pattern).findall

        def run(texts: list[str]) -> dict[str, list]:
            from collections import Counter

            seen = Counter(w for t in texts for w in split(t))
            words = [list(seen)] + [[] for _ in texts[1:]]
            return {"words": words, "counts": [list(seen.values())] + [[] for _ in texts[1:]]}

        return run

    fields = T.StructType([T.StructField("words", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.LongType()))])
    seen = map_texts(sample, make, fields, id_col, text_col).select(F.inline(F.arrays_zip("words", "counts")))
    kept = seen.groupBy("words").agg(F.sum("counts").alias("n")).where(f"n > 1 and octet_length(words) <= {LONG_PIECE}")

    def byte_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0)
            yield pa.RecordBatch.from_arrays(
                [words, pa.array([[start[b] for b in w.as_py().encode()] for w in words], pa.list_(pa.int64()))], ["word", "ids"]
            )

    table = kept.select("words").mapInArrow(byte_ids, "word string, ids array<bigint>").select("word", folded(F.col("ids"), *maps).alias("ids")).toArrow()
    lists = table.column("ids").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int64()))
    data = lists.flatten().to_numpy(zero_copy_only=False).astype("<u2").tobytes()
    cuts = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64) * 2
    return dict(zip(table.column("word").to_pylist(), (data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()))))


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    sample_docs: int = SAMPLE_DOCS, with_decoded: bool = False,
) -> DataFrame:
    """``id_col, ids`` (little-endian unsigned 32-bit), and ``decoded`` bytes if asked for."""
    spark = docs.sparkSession
    ship(spark)
    ranks = read_ranks(path)
    shift, table = rank_table(ranks)
    maps = literal(spark, shift), literal(spark, table)
    known = dictionary(docs, ranks, pattern, text_col, id_col, maps, sample_docs)
    sent = spark.sparkContext.broadcast(([ranks[bytes([b])] for b in range(256)], byte_pairs(ranks), known))
    pieces_of = spark.sparkContext.broadcast(decoding_table(ranks))  # apart, so that the second step holds no dictionary
    hole = np.array([HOLE], "<u2").tobytes()

    def make():
        import regex

        split = regex.compile(pattern).findall
        start, pairs, known = sent.value
        start, get = np.array(start, np.int16), known.get

        def run(texts: list[str]) -> dict[str, list]:
            flat, order = [], []
            found: tuple[list[dict[bytes, int]], ...] = ([], [])  # new pieces of each text: short ones, long ones
            for t in texts:
                pieces = split(t)
                got = list(map(get, pieces))
                short: dict[bytes, int] = {}
                long: dict[bytes, int] = {}
                refs = []
                for i in [i for i, v in enumerate(got) if v is None]:
                    got[i] = hole
                    raw = pieces[i].encode("utf-8", "replace")
                    # Long ones count down from -1 until it is known how many short ones come before them.
                    refs.append(short.setdefault(raw, len(short)) if len(raw) <= LONG_PIECE else -1 - long.setdefault(raw, len(long)))
                flat.append(b"".join(got))
                refs = np.array(refs, np.int64)
                order.append(np.where(refs < 0, len(short) - 1 - refs, refs).astype("<u4").tobytes())
                found[0].append(short)
                found[1].append(long)
            return {"flat": flat, "rare": byte_arrays(found[0], start, pairs), "long": byte_arrays(found[1], start), "refs": order}

        return run

    fields = T.StructType(
        [
            T.StructField("flat", T.BinaryType()),
            T.StructField("rare", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("long", T.ArrayType(T.ArrayType(T.ShortType()))),  # bytes have the lowest ids
            T.StructField("refs", T.BinaryType()),
        ]
    )
    coded = map_texts(docs, make, fields, id_col, text_col)
    short = F.transform("rare", lambda w: folded(w, *maps, begun=True))
    long = F.transform("long", lambda w: folded(w.cast("array<bigint>"), *maps, long=True))
    coded = coded.select(id_col, "flat", "refs", F.concat(short, long).alias("rare"))

    out = [docs.schema[id_col], T.StructField("ids", T.BinaryType())] + [T.StructField("decoded", T.BinaryType())] * with_decoded
    schema = T.StructType(out)
    arrow = to_arrow_schema(schema)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of.value
        for batch in batches:
            made, back = [], []
            for flat, refs, rare in zip(batch.column(1), batch.column(2), batch.column(3)):
                ids = fill_holes(np.frombuffer(flat.as_py(), "<u2"), np.frombuffer(refs.as_py(), "<u4"), rare.values)
                made.append(ids.tobytes())
                if with_decoded:
                    back.append(decode_ids(ids, pieces))
            columns = [batch.column(0).cast(arrow.field(0).type), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(back, pa.binary())] * with_decoded, schema=arrow)

    return coded.mapInArrow(fill, schema)


def byte_pairs(ranks: dict[bytes, int]) -> np.ndarray:
    """``[a, b]``: the entry of byte ``a`` before byte ``b``, ``[a, 256]`` at the end of a piece."""
    own = [ranks[bytes([a])] for a in range(256)]
    return np.array([[(ranks.get(bytes([a, b]), NO_PAIR >> ENTRY_BITS) << ENTRY_BITS) + own[a] for b in range(256)] + [NO_PAIR + own[a]] for a in range(256)], np.int64)


def first_entries(joined: bytes, sizes: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The entries that the fold of short pieces begins with: for each one that of no pair, then those of its bytes."""
    left = np.frombuffer(joined, np.uint8)
    right = np.append(left[1:], 0).astype(np.int64)
    ends = np.cumsum(sizes)
    right[ends - 1] = 256
    return np.insert(pairs[left, right], ends - sizes, NO_PAIR + NO_ID) if len(left) else np.empty(0, np.int64)


def byte_arrays(words: list[dict[bytes, int]], start: np.ndarray, pairs: np.ndarray | None = None) -> pa.Array:
    """For each text its words, each as the ids of its bytes, or as its first entries if ``pairs`` are given."""
    every = [w for own in words for w in own]
    ends = lambda sizes: pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    sizes = np.fromiter(map(len, every), np.int64, len(every))
    joined = b"".join(every)
    values = pa.array(start[np.frombuffer(joined, np.uint8)] if pairs is None else first_entries(joined, sizes, pairs))
    return pa.ListArray.from_arrays(ends([len(own) for own in words]), pa.ListArray.from_arrays(ends(sizes + (pairs is not None)), values))


def fill_holes(flat: np.ndarray, refs: np.ndarray, rare: pa.Array) -> np.ndarray:
    """The document's ids: each hole gives way to the ids of the rare word it refers to."""
    if not len(refs):
        return flat.astype("<u4")
    sizes = rare.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = rare.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    holes = np.flatnonzero(flat == HOLE)
    room = np.ones(len(flat), np.int64)
    room[holes] = sizes[refs]
    at = np.cumsum(room) - room
    out = np.empty(int(room.sum()), "<u4")
    plain = flat != HOLE
    out[at[plain]] = flat[plain]
    n = sizes[refs]
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(at[holes], n) + within] = values[np.repeat(starts[refs], n) + within]
    return out


def decoding_table(ranks: dict[bytes, int]) -> list[bytes]:
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, r in ranks.items():
        pieces[r] = token
    return pieces


def decode_ids(ids: np.ndarray, pieces: list[bytes]) -> bytes:
    return b"".join(map(pieces.__getitem__, ids.tolist()))
