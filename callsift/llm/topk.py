"""Exact top-k inner-product search with a ball tree per shard.

A task reads its rows in shards of at most ``shard_rows`` vectors, collapses equal
vectors, and builds a ball tree: a node with centre ``c`` and radius ``r`` can hold no
vector whose inner product with a query ``q`` exceeds ``q.c + |q| r``. Each query walks a
tree best bound first and stops at the first node whose bound is below its current k-th
score. That score is shared: every query starts from the k-th score over a small sample of
the table, and carries what it has reached from shard to shard of a task. Queries come in
packed blocks of bounded size, against all rows, so the driver holds one block at a time;
the best k per task meet in one window per query.

Arithmetic is exact as long as scores stay below 2**53. Edge cases: vectors that are
null or hold null or non-finite components, and rows without an identifier, take no
part; vectors of different length never meet; every row is a candidate of its own, so a
row that repeats an identifier takes a rank of its own; rows with the query's identifier,
however many, are never its neighbours; a repeated query row is asked once; ties go to the
smaller identifier; fewer than k candidates give fewer rows; an empty table gives none;
further columns are never read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from callsift.llm._shared import discard, materialize
from callsift.shipping import ship

#: Vectors per ball tree.
SHARD_ROWS = 32_768
#: Vectors per leaf.
LEAF_ROWS = 128
#: Queries per block; a block travels with each task, and every block costs a pass over the table.
BLOCK_QUERIES = 16_384
#: Rows whose scores give every query its first k-th score.
SEED_ROWS = 2048


class BallTree:
    """Centres, radii and children of all nodes; node 0 is the root."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF_ROWS):
        self.order = np.arange(len(x))
        self.span: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii = [], []
        todo = [(0, len(x), -1, 0)]
        while todo:
            lo, hi, parent, side = todo.pop()
            node = len(self.span)
            if parent >= 0:
                pair = self.children[parent] or (0, 0)
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            rows = x[self.order[lo:hi]]
            c = rows.mean(0)
            d = ((rows - c) ** 2).sum(1)
            self.span.append((lo, hi))
            self.children.append(None)
            centres.append(c)
            radii.append(np.sqrt(d.max()))
            if hi - lo > leaf:
                # Split along the line between the farthest vector and the one farthest from it.
                a = rows[d.argmax()]
                b = rows[((rows - a) ** 2).sum(1).argmax()]
                mid = (hi - lo) // 2
                part = np.argpartition(rows @ (b - a), mid)
                self.order[lo:hi] = self.order[lo:hi][part]
                todo += [(lo + mid, hi, node, 1), (lo, lo + mid, node, 0)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.x = x[self.order]


class Best:
    """The k best (score, id) of one query so far, and its current k-th score."""

    def __init__(self, k: int, floor: float):
        self.k, self.kth = k, floor
        self.found: list[tuple[float, int]] = []  # (-score, id), ascending

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        both = self.found + list(zip((-scores).tolist(), ids.tolist()))
        self.found = heapq.nsmallest(self.k, both)
        if len(self.found) == self.k:
            self.kth = max(self.kth, -self.found[-1][0])


def walk(tree: BallTree, ids: np.ndarray, q: np.ndarray, own: int, best: Best) -> int:
    """Best-bound-first search of one tree; returns the number of leaves read.

    ``ids`` holds the identifiers of each distinct vector, padded with -1 beyond ``ids[:, 0]``.
    """
    # Scores are integers: half a unit covers the rounding of the bounds.
    bound = tree.centres @ q + np.sqrt(q @ q) * tree.radii + 0.5
    heap, leaves = [(-bound[0], 0)], 0
    while heap:
        top, node = heapq.heappop(heap)
        if -top < best.kth:
            break
        pair = tree.children[node]
        if pair is not None:
            for child in pair:
                if bound[child] >= best.kth:
                    heapq.heappush(heap, (-bound[child], child))
            continue
        leaves += 1
        lo, hi = tree.span[node]
        scores = tree.x[lo:hi] @ q
        good = np.flatnonzero(scores >= best.kth)
        if len(good):
            every = ids[tree.order[lo:hi][good]]
            row, col = np.nonzero((every >= 0) & (every != own))
            best.add(scores[good][row], every[row, col])
    return leaves


def collapse(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct vectors and identifiers of each, ascending, padded with -1.

    At most ``k`` rows of one identifier and ``2 k`` of one vector are listed: without any
    one identifier that leaves the ``k`` smallest of the others, or all of them.
    """
    _, group = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True) if x.shape[1] else (0, np.zeros(len(x), np.int64))
    by = np.lexsort((ids, group))
    group, ids, x = group[by], ids[by], x[by]
    place = _places((group[1:] != group[:-1]) | (ids[1:] != ids[:-1]))
    group, ids, x = group[place < k], ids[place < k], x[place < k]
    place = _places(group[1:] != group[:-1])
    first = place == 0
    out = np.full((int(first.sum()), 2 * k), -1, np.int64)
    keep = place < 2 * k
    out[(np.cumsum(first) - 1)[keep], place[keep]] = ids[keep]
    return x[first], out


def _places(new: np.ndarray) -> np.ndarray:
    """Place of every element in its run, given flags of the later runs' first elements."""
    starts = np.flatnonzero(np.concatenate(([True], new)))
    return np.arange(len(new) + 1) - np.repeat(starts, np.diff(np.append(starts, len(new) + 1)))


def _vectors(batch: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """``{length: (ids, matrix)}`` of a batch of ``id, v``."""
    ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    lists = batch.column(1)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    out = {}
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        out[n] = (ids[at], flat[(starts[at][:, None] + np.arange(n)).astype(np.int64)])
    return out


def quantized(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """``id, v``: ``floor(scale * x)`` of every usable vector, as doubles that hold integers."""
    v = F.col(vec_col).cast("array<double>")
    usable = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return vectors.where(usable).select(
        F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * float(scale)).cast("double")).alias("v")
    )


def _packed(queries: DataFrame, size: int) -> DataFrame:
    """``n, length, ids, v``: at most ``size`` queries of one length a row, as numbers in binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, (ids, x) in _vectors(batch).items() if batch.num_rows else ():
                for at in range(0, len(ids), size):
                    own, v = ids[at : at + size], x[at : at + size]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(own)]), pa.array([length]), pa.array([own.tobytes()]), pa.array([v.tobytes()])], ["n", "length", "ids", "v"]
                    )

    return queries.mapInArrow(run, "n long, length long, ids binary, v binary")


def _blocks(packed: DataFrame, size: int) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    held, n = [], 0
    for row in packed.toLocalIterator():
        if held and n + row.n > size:
            yield held
            held, n = [], 0
        held.append((np.frombuffer(row.ids, np.int64), np.frombuffer(row.v).reshape(row.n, row.length)))
        n += row.n
    if held:
        yield held


def start_scores(ids: np.ndarray, x: np.ndarray, sample: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """The k-th score of each query over the sample; none is known where the sample is too small."""
    out = np.full(len(ids), -np.inf)
    own, v = sample.get(x.shape[1], (np.zeros(0, np.int64), x[:0]))
    if len(own) > k:
        for at in range(0, len(ids), 1024):
            scores = x[at : at + 1024] @ v.T
            scores[ids[at : at + 1024, None] == own] = -np.inf
            out[at : at + 1024] = np.partition(scores, -k, axis=1)[:, -k]
    return out


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    block_queries: int = BLOCK_QUERIES,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id, rank, id, score``: each query's k best rows of ``vectors`` but its own."""
    spark = vectors.sparkSession
    ship(spark)
    rows = quantized(vectors, scale, id_col, vec_col)
    asked = materialize(_packed(quantized(queries, scale, id_col, vec_col).distinct(), block_queries), "queries")
    sample: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for row in _packed(rows.limit(SEED_ROWS), SEED_ROWS).collect():
        own, v = np.frombuffer(row.ids, np.int64), np.frombuffer(row.v).reshape(row.n, row.length)
        old = sample.get(row.length, (own[:0], v[:0]))
        sample[row.length] = np.concatenate((old[0], own)), np.concatenate((old[1], v))
    schema = "query_id long, id long, score long"
    answers = spark.createDataFrame([], "query_id long, rank int, id long, score long")
    for block in _blocks(asked, block_queries):
        sent = spark.sparkContext.broadcast([(ids, x, start_scores(ids, x, sample, k)) for ids, x in block])

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = [(int(own), q, Best(k, floor)) for ids, x, floors in sent.value for own, q, floor in zip(ids, x, floors.tolist())]

            def solve(n: int, ids: np.ndarray, x: np.ndarray) -> None:
                x, ids = collapse(ids, x, k)
                tree = BallTree(x)
                for own, q, best in block:
                    if len(q) == n:
                        walk(tree, ids, q, own, best)

            held: dict[int, list] = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                for n, (ids, x) in _vectors(batch).items():
                    for at in range(0, len(ids), shard_rows):
                        held.setdefault(n, []).append((ids[at : at + shard_rows], x[at : at + shard_rows]))
                        if sum(len(i) for i, _ in held[n]) >= shard_rows:
                            solve(n, *map(np.concatenate, zip(*held.pop(n))))
            for n in list(held):
                solve(n, *map(np.concatenate, zip(*held.pop(n))))
            out = [(own, i, int(-s)) for own, _, best in block for s, i in best.found]
            a, b, c = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, c)], ["query_id", "id", "score"])

        order = W.Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        found = rows.mapInArrow(search, schema)
        done = materialize(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "answers")
        sent.destroy()
        answers = answers.unionByName(done.withColumn("rank", F.col("rank").cast("int")))
    discard(asked)
    return answers
