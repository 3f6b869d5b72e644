"""SimHash near-duplicates by Golay-code fuzzy hashing.

A text's 64-bit fingerprint takes the majority of each bit over the hashes of its word
shingles. Two fingerprints link if they differ in at most ``radius`` bits.

Links are found by fuzzy keys. The fingerprint is cut into segments of at most 23 bits;
a segment is a word of the perfect binary Golay code's space, and its keys are the
indices of all codewords within distance 4 of it: one if a codeword lies within two
bits, else six. The positions of those error patterns cover all 23 bits, so two words
that differ in at most two bits always share a codeword (``tests`` check all cosets).
By the pigeonhole principle links within the radius leave at least two segments with
at most two differing bits each: three segments carry a radius of 4, four segments 8.
The fuzzy keys of every pair of segments therefore meet for every link.

Keys travel as packed blobs, a few rows per task and target, and are joined by sorting.
Every candidate is verified on the whole fingerprint. Equal fingerprints are one node
from the start, and all links of a target are reduced to a spanning forest before they
leave the task, so a large group of copies emits fewer links than it has different
fingerprints, not pairs. Components are settled on the cluster.

Edge cases: null and empty texts, or texts of white space only, have fingerprint zero,
which links like any other; texts of fewer words than a shingle are one shingle; rows
with a null identifier take part but never name a component unless all are null; repeated
rows have a row each; very long texts are hashed whole, a block of shingles at a time; an
empty table has no rows; further columns are never read, and the stage keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.llm._arrow import map_texts
from callsift.llm._components import connected_components
from callsift.llm._shared import discard, materialize
from callsift.shipping import ship

SEED = 42
#: Segments of the fingerprint and the radius that they carry (see the module's docstring).
SEGMENTS = {4: 3, 8: 4}
#: Generator polynomial of the (23, 12) Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
#: Shingle hashes whose bits are counted at once.
BLOCK = 65_536
#: Shingles that a task holds before it passes them on.
HELD = 250_000


# --- fingerprints ---------------------------------------------------------------------------


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; none for a text without words."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - size + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    last = ends[min(size, len(words)) - 1 :]
    spans = zip(starts[:n].tolist(), last.tolist())
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """Bit set where more than half of the hashes have it."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].astype("<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fingerprint``; the 64 bits are kept in a signed long."""

    def make():
        def run(texts: list[str]) -> dict[str, list]:
            found = [majority(shingle_hashes(t, shingle)) for t in texts]
            return {"fingerprint": np.array(found, np.uint64).view(np.int64)}

        return run

    fields = T.StructType([T.StructField("fingerprint", T.LongType())])
    return map_texts(docs, make, fields, id_col, text_col)


# --- Golay keys -----------------------------------------------------------------------------


def _remainders(width: int) -> np.ndarray:
    """Remainder of every word of ``width`` bits modulo the generator."""
    x = np.arange(1 << width, dtype=np.int64)
    for bit in range(width - 1, 10, -1):
        x = np.where(x >> bit & 1, x ^ (GENERATOR << (bit - 11)), x)
    return x


class Golay:
    """Error patterns of weight at most 4 by syndrome."""

    def __init__(self) -> None:
        high = _remainders(23)[np.arange(1 << 12) << 11]
        self.high = high
        patterns: list[list[int]] = [[] for _ in range(2048)]
        for weight in range(5):
            for bits in combinations(range(23), weight):
                e = sum(1 << b for b in bits)
                patterns[int(high[e >> 11] ^ (e & 2047))].append(e)
        self.patterns = np.full((2048, 6), -1, np.int64)
        for s, ps in enumerate(patterns):
            self.patterns[s, : len(ps)] = ps

    def keys(self, x: np.ndarray) -> np.ndarray:
        """``(n, 6)`` codeword indices within distance 4 of the words ``x``; -1 pads."""
        x = x.astype(np.int64)
        found = self.patterns[self.high[x >> 11] ^ (x & 2047)]
        return np.where(found < 0, -1, (x[:, None] ^ found) >> 11)


def cut_segments(fp: np.ndarray, n: int) -> list[np.ndarray]:
    """The fingerprint's bits in ``n`` segments of nearly equal width."""
    edges = [64 * i // n for i in range(n + 1)]
    return [(fp >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]


def fuzzy_keys(fp: np.ndarray, segments: int, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """``(key, row)`` of every fuzzy key of the fingerprints."""
    own = [golay.keys(s) for s in cut_segments(fp, segments)]
    keys, rows = [], []
    for p, (i, j) in enumerate(combinations(range(segments), 2)):
        a, b = own[i][:, :, None], own[j][:, None, :]
        both = (a << 12 | b) | p << 24
        row, x, y = np.nonzero((a >= 0) & (b >= 0))
        keys.append(both[row, x, y])
        rows.append(row)
    return np.concatenate(keys).astype(np.uint32), np.concatenate(rows)


# --- links ----------------------------------------------------------------------------------


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Indices of links that span the same components of ``n`` nodes as all links do."""
    root = np.arange(n)
    kept: list[np.ndarray] = []
    rest = np.arange(len(a))
    while len(rest):
        x, y = root[a[rest]], root[b[rest]]
        rest = rest[x != y]
        if not len(rest):
            break
        x, y = np.minimum(root[a[rest]], root[b[rest]]), np.maximum(root[a[rest]], root[b[rest]])
        # Each root joins one smaller root at most, so no two links of a round close a ring.
        _, first = np.unique(y, return_index=True)
        kept.append(rest[first])
        root[y[first]] = x[first]
        while (root[root] != root).any():
            root = root[root]
    return np.sort(np.concatenate(kept)) if kept else np.zeros(0, np.int64)


def links_of(keys: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """Links ``(n, 2)`` that span the components of fingerprints within ``radius`` that share a key.

    A run of one key is searched breadth first, all runs at once: each round takes the first
    fingerprint of what is left of every run, or one that a link has reached, and compares it
    with the rest of the run; what it reaches needs no further link in that run.
    """
    known, node = np.unique(fp, return_inverse=True)
    order = np.lexsort((node, keys))
    keys, node = keys[order], node[order]
    new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (node[1:] != node[:-1])))
    keys, node = keys[new], node[new]
    run = np.cumsum(np.concatenate(([True], keys[1:] != keys[:-1]))) - 1
    many = np.bincount(run)[run] > 1
    run, node = run[many], node[many]
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    reached = np.zeros(len(run), bool)
    while len(run):
        # Members that links have reached go first, so that each component is finished before the next.
        by = np.lexsort((~reached, run))
        run, node, reached = run[by], node[by], reached[by]
        heads = np.concatenate(([True], run[1:] != run[:-1]))
        pivot = node[heads][np.cumsum(heads) - 1]
        near = (np.bitwise_count(known[node] ^ known[pivot]) <= radius) & ~heads
        hit = near & ~reached
        a.append(pivot[hit])
        b.append(node[hit])
        reached |= near
        run, node, reached = run[~heads], node[~heads], reached[~heads]
        if len(run):
            # A run with one member left, or whose members are all reached, is done.
            more = (np.bincount(run) > 1) & (np.bincount(run, ~reached) > 0)
            run, node, reached = run[more[run]], node[more[run]], reached[more[run]]
    first, second = np.concatenate(a), np.concatenate(b)
    kept = forest(first, second, len(known))
    return np.column_stack((known[first[kept]], known[second[kept]])) if len(kept) else np.zeros((0, 2), np.uint64)


def linked(nodes: DataFrame, radius: int) -> DataFrame:
    """``a, b``: links among the distinct ``fingerprint`` values of ``nodes``."""
    spark = nodes.sparkSession
    ship(spark)
    segments = SEGMENTS[radius]
    targets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for at in range(0, len(every), 8192):
                fp = every[at : at + 8192]
                keys, rows = fuzzy_keys(fp, segments, golay)
                target = (keys.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(targets)
                order = np.argsort(target, kind="stable")
                keys, rows, target = keys[order], rows[order], target[order]
                cuts = np.searchsorted(target, np.arange(targets + 1))
                some = [t for t in range(targets) if cuts[t] < cuts[t + 1]]
                blobs = [keys[cuts[t] : cuts[t + 1]].tobytes() + fp[rows[cuts[t] : cuts[t + 1]]].tobytes() for t in some]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(blobs, pa.binary())], ["target", "blob"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(blobs: list[bytes]) -> pa.RecordBatch:
            n = [len(x) // 12 for x in blobs]
            keys = np.concatenate([np.frombuffer(x, np.uint32, m) for x, m in zip(blobs, n)])
            fp = np.concatenate([np.frombuffer(x, np.uint64, m, 4 * m) for x, m in zip(blobs, n)])
            pairs = links_of(keys, fp, radius).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        held: list[bytes] = []
        now = None
        for batch in batches:
            for target, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if target != now and held:
                    yield solve(held)
                    held = []
                now = target
                held.append(blob.as_py())
        if held:
            yield solve(held)

    dealt = nodes.select("fingerprint").mapInArrow(deal, "target int, blob binary")
    dealt = dealt.repartition(targets, "target").sortWithinPartitions("target")
    return dealt.mapInArrow(meet, "a long, b long")


def simhash_components(
    docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, fingerprint, component_id``: the smallest identifier that links reach."""
    rows = materialize(fingerprints(docs, shingle, id_col, text_col).withColumnRenamed(id_col, "id"), "fingerprints")
    nodes = materialize(rows.groupBy("fingerprint").agg(F.min("id").alias("first")), "nodes")
    roots = connected_components(linked(nodes, radius))
    grouped = nodes.join(roots.hint("merge"), nodes["fingerprint"] == roots["node"])
    heads = grouped.groupBy("root").agg(F.min("first").alias("head"))
    named = roots.join(heads.hint("merge"), "root").select(F.col("node").alias("fingerprint"), "head")
    labels = nodes.join(named.hint("merge"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("head", "first").alias("component_id")
    )
    # A table, so that the join below has nothing behind or beside it and a hot fingerprint can be split.
    labels = materialize(labels, "labels")
    discard(nodes)
    return rows.join(labels.hint("merge"), "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "component_id")


# --- near copies, verified on the texts -------------------------------------------------------


def shingle_similarity(a: str, b: str, size: int) -> float:
    """Jaccard similarity of the sets of word shingles of two texts."""
    x, y = set(shingle_hashes(a, size).tolist()), set(shingle_hashes(b, size).tolist())
    return len(x & y) / len(x | y) if x or y else 1.0


def prefix_length(n: int | np.ndarray, similarity: float) -> int | np.ndarray:
    """Two sets of Jaccard ``similarity`` share one of so many first elements of either, in any common order."""
    return n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1


def cut(target: np.ndarray, targets: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    """``target, blob``: the rows of equal-width columns, packed by target."""
    order = np.argsort(target, kind="stable")
    cuts = np.searchsorted(target[order], np.arange(targets + 1))
    some = np.flatnonzero(cuts[1:] > cuts[:-1])
    columns = [c[order] for c in columns]
    blobs = [b"".join(c[cuts[t] : cuts[t + 1]].tobytes() for c in columns) for t in some]
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(blobs, pa.binary())], ["target", "blob"])


def by_target(batches: Iterator[pa.RecordBatch], kinds: list) -> Iterator[list[np.ndarray]]:
    """The columns that ``cut`` packed, whole for each target of sorted batches."""
    width = sum(np.dtype(k).itemsize for k in kinds)

    def unpack(blobs: list[bytes]) -> list[np.ndarray]:
        parts: list[list[np.ndarray]] = [[] for _ in kinds]
        for blob in blobs:
            n, at = len(blob) // width, 0
            for part, k in zip(parts, kinds):
                part.append(np.frombuffer(blob, k, n, at))
                at += n * np.dtype(k).itemsize
        return [np.concatenate(p) for p in parts]

    held: list[bytes] = []
    now = None
    for batch in batches:
        for target, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            if target != now and held:
                yield unpack(held)
                held = []
            now = target
            held.append(blob.as_py())
    if held:
        yield unpack(held)


def shared_shingles(docs: DataFrame, groups: DataFrame, shingle: int, similarity: float, text_col: str = "text") -> DataFrame:
    """``a, b``: links that join every pair of the Jaccard ``similarity`` that ``groups`` leave apart.

    ``groups`` (``node, group``) names the group of a text's digest; all others are groups of their own.
    Links are between groups, none lies within one.

    Prefix filtering with the rarest shingles first: a text's shingles are ordered by the
    number of texts that have them, then by hash, and two similar texts share one of each
    other's ``prefix_length`` first ones. A shingle that one text alone has links nothing,
    so texts with enough of those leave at once. All texts with a shared shingle in their
    prefix are linked to the smallest group of them, a link for each group and not for each pair.
    Nothing is verified here. Texts without words share one shingle.
    """
    spark = docs.sparkSession
    ship(spark)
    # Fewer for what is left after the first exchange, so that blobs do not grow with the square of the partitions.
    fewer = int(spark.conf.get("spark.sql.shuffle.partitions"))
    targets = 4 * fewer
    modulus = np.uint64(targets)

    def packed(hashes: list[np.ndarray], nodes: list[int], sizes: list[int]) -> pa.RecordBatch:
        h, size = np.concatenate(hashes), np.array(sizes, np.uint32)
        # Sizes in two halves: the upper one is nearly always zero and takes no room on disk.
        columns = [np.array(nodes, np.int64), (size & np.uint32(0xFFFF)).astype(np.uint16), (size >> np.uint32(16)).astype(np.uint16)]
        return cut(h % modulus, targets, [h] + [np.repeat(c, size) for c in columns])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, nodes, sizes, held = [], [], [], 0
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.unique(shingle_hashes(text.as_py(), shingle))
                own = own if len(own) else np.zeros(1, np.uint64)
                hashes.append(own)
                nodes.append(node)
                sizes.append(len(own))
                held += len(own)
                if held > HELD:
                    yield packed(hashes, nodes, sizes)
                    hashes, nodes, sizes, held = [], [], [], 0
        if held:
            yield packed(hashes, nodes, sizes)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, node, low, high in by_target(batches, [np.uint64, np.int64, np.uint16, np.uint16]):
            size = low + (high.astype(np.uint32) << np.uint32(16))
            order = np.lexsort((node, h))
            h, node, size = h[order], node[order], size[order]
            # Equal texts are one node.
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (node[1:] != node[:-1])))
            h, node, size = h[new], node[new], size[new]
            starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            counts = np.diff(np.concatenate((starts, [len(h)])))
            count = np.repeat(counts, counts)
            many = count > 1
            if many.any():
                node = node[many]
                yield cut(node.view(np.uint64) % np.uint64(fewer), fewer, [node, h[many], count[many].astype(np.uint32), size[many]])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, h, count, size in by_target(batches, [np.int64, np.uint64, np.uint32, np.uint32]):
            order = np.lexsort((h, count, node))
            node, h, size = node[order], h[order], size[order].astype(np.int64)
            starts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
            shared = np.diff(np.concatenate((starts, [len(node)])))
            rank = np.arange(len(node)) - np.repeat(starts, shared)
            # Before the shared shingles come those that this text alone has.
            first = rank + size - np.repeat(shared, shared) < prefix_length(size, similarity)
            yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(node[first])], ["h", "node"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    dealt = docs.select(F.xxhash64(text).alias("node"), text.alias("text")).mapInArrow(deal, "target int, blob binary")
    met = dealt.repartition(targets, "target").sortWithinPartitions("target").mapInArrow(meet, "target int, blob binary")
    firsts = met.repartition(fewer, "target").sortWithinPartitions("target").mapInArrow(settle, "h long, node long")
    prefixes = materialize(firsts, "prefixes")
    named = prefixes.join(groups.hint("merge"), "node", "left").select("h", F.coalesce("group", "node").alias("node"))
    firsts = materialize(named.distinct(), "firsts")
    discard(prefixes)
    heads = firsts.groupBy("h").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1").select("h", "b")
    return firsts.join(heads.hint("merge"), "h").where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def near_copies(
    docs: DataFrame,
    shingle: int = 5,
    similarity: float = 0.8,
    feature: int = 4,
    radius: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, node, keep_id``: texts whose shingles are similar to those of a smaller identifier that stays.

    ``node`` is the text's digest, which tells rows of one identifier apart.

    SimHash components by Golay keys (``simhash_components``: shingles of ``feature`` words,
    fingerprints within ``radius`` bits) gather the candidates. Fingerprints miss pairs, as with a
    block added or cut, so ``shared_shingles`` then joins the components that hold such pairs:
    every pair that is at least ``similarity`` (Jaccard, shingles of ``shingle`` words) alike
    lies within one candidate group. Identifiers
    then decide in ascending order within a component: one that is that similar to an
    identifier that stays is its copy, all others stay. First every member is compared with
    its component's smallest identifier by a join that spreads over tasks, which settles
    large groups of copies; what is left of a component streams through one task, which
    holds the shingles of those that stay and finds the similar ones among them by their
    smallest hashes (prefix filtering). Rows with a null identifier are not compared.
    """
    digest = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), digest.alias("node"))
    nodes = docs.select(digest.alias("node"), F.col(text_col).alias("text"))
    linked_nodes = simhash_components(nodes, feature, radius, "node", "text").where("node <> component_id")
    groups = materialize(linked_nodes.select("node", F.col("component_id").alias("group")).distinct(), "groups")
    roots = connected_components(shared_shingles(docs, groups, shingle, similarity, text_col)).withColumnRenamed("node", "own")
    # Tables between the joins, so that hot digests and components can be split.
    named = rows.join(groups.hint("merge"), "node", "left").select("id", "node", F.coalesce("group", "node").alias("own"))
    named = materialize(named, "named")
    found = materialize(named.join(roots.hint("merge"), "own", "left").select("id", "node", F.coalesce("root", "own").alias("part")), "parts")
    many = materialize(found.groupBy("part").agg(F.count("*").alias("n")).where("n > 1").select("part"), "counts")
    members = materialize(found.where("id is not null").join(many.hint("merge"), "part"), "many").distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("node"))
    left = materialize(members.join(texts.hint("merge"), ["id", "node"]), "members")

    @F.arrow_udf(T.DoubleType())
    def likeness(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([shingle_similarity(x.as_py(), y.as_py(), shingle) for x, y in zip(a, b)], pa.float64())

    ship(docs.sparkSession)
    first = left.groupBy("part").agg(F.min_by(F.struct("id", "text"), F.struct("id", F.xxhash64("text"))).alias("head"))
    heads = first.select("part", F.col("head.id").alias("keep_id"), F.col("head.text").alias("keep_text"))
    heads = materialize(heads, "heads")
    judged = left.join(heads.hint("merge"), "part").where("id <> keep_id")
    judged = materialize(judged.withColumn("close", likeness("text", "keep_text") >= similarity).drop("keep_text"), "judged")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept = None, Kept(shingle, similarity)
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for part, i, node, text in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if part != now:
                    now, kept = part, Kept(shingle, similarity)
                copy_of = kept.decide(i, text)
                if copy_of is not None:
                    out.append((i, node, copy_of))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ((), (), ()))], ["id", "node", "keep_id"])

    rest = judged.where("not close").select("part", F.col("id").cast("long").alias("id"), "node", "text")
    more = rest.repartition("part").sortWithinPartitions("part", "id", "node").mapInArrow(stream, "id long, node long, keep_id long")
    out = judged.where("close").select("id", "node", "keep_id").unionByName(more)
    return out.select(F.col("id").alias(id_col), "node", "keep_id")


class Kept:
    """The texts of one component that stay, found by similarity.

    Two sets with a Jaccard similarity of ``t`` share one of the ``n - ceil(t n) + 1`` smallest
    elements of either, so only texts that share such an element are compared.
    """

    def __init__(self, shingle: int, similarity: float):
        self.shingle, self.similarity = shingle, similarity
        self.ids: list[int] = []
        self.sets: list[set[int]] = []
        self.index: dict[int, list[int]] = {}

    def decide(self, i: int, text: str) -> int | None:
        """The kept identifier that the text is a copy of; None if it stays, or is the same identifier."""
        own = set(shingle_hashes(text, self.shingle).tolist())
        prefix = sorted(own)[: int(prefix_length(len(own), self.similarity))] if own else [-1]
        for k in sorted({k for h in prefix for k in self.index.get(h, ())}):
            other = self.sets[k]
            shared = len(own & other)
            if shared >= self.similarity * (len(own) + len(other) - shared):
                return self.ids[k] if self.ids[k] != i else None
        for h in prefix:
            self.index.setdefault(h, []).append(len(self.ids))
        self.ids.append(i)
        self.sets.append(own)
        return None


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the copies that ``near_copies`` finds; rows are told apart by identifier and text.

    Rows of a null identifier all stay, and so do rows of one identifier with similar texts.
    """
    out = near_copies(docs, id_col=id_col, text_col=text_col, **options).select(F.col(id_col).alias("__out"), F.col("node").alias("__node")).distinct()
    digest = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return docs.join(out.hint("merge"), (F.col(id_col) == F.col("__out")) & (digest == F.col("__node")), "left_anti")
