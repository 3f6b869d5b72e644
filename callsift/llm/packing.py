"""Packing documents into training sequences by Karmarkar-Karp differencing.

A document's ids are cut at multiples of the capacity; such full pieces are
sequences by themselves. What is left over is cut into pieces of at most
``max_piece`` ids, and these are packed in groups: for ``k`` windows every piece
starts as a partial partition ``(length, 0, ..., 0)``; the two partitions with the
largest imbalance are merged, the fullest windows of one with the emptiest of the
other, until one partition is left, whose windows are nearly equal. ``k`` starts at
the least number that could hold the group and rises whenever a window exceeds the
capacity.

Ids never leave the task that reads their text: only piece lengths and checksums
are shuffled, by a hash of document and place, so neither a hot source nor a very
long document lands in one task. Edge cases: a null or empty text is the single
closing id; repeated rows are packed once each; an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from callsift.llm._arrow import map_texts
from callsift.shipping import ship

CAPACITY = 2048
#: Leftovers are cut to this many ids at most; smaller pieces pack tighter but split more documents.
MAX_PIECE = 512
#: Leftover pieces that are packed together.
GROUP = 512
#: The id that closes every document.
END_ID = 1

PIECES = T.StructType(
    [
        T.StructField(
            "pieces",
            T.ArrayType(
                T.StructType(
                    [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]
                )
            ),
        ),
        T.StructField("doc_tokens", T.LongType()),
    ]
)


def difference(lengths: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: ``k`` windows of indices into ``lengths`` with near-equal sums."""
    if k == 1:
        return [list(range(len(lengths)))]
    heap = []
    for i, n in enumerate(lengths):
        sums = np.zeros(k, np.int64)
        sums[-1] = n
        heap.append((-n, i, sums, [None] * (k - 1) + [(i, None, None)]))
    heapq.heapify(heap)
    made = len(lengths)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        sums = a + b[::-1]  # the fullest of one with the emptiest of the other
        order = np.argsort(sums, kind="stable")
        joined = [x if y is None else y if x is None else (None, x, y) for x, y in zip(in_a, in_b[::-1])]
        sums = sums[order]
        made += 1
        heapq.heappush(heap, (-int(sums[-1] - sums[0]), made, sums, [joined[j] for j in order.tolist()]))
    windows = []
    for tree in heap[0][3]:
        members, todo = [], [tree]
        while todo:
            node = todo.pop()
            if node is None:
                continue
            if node[0] is not None:
                members.append(node[0])
            else:
                todo += [node[2], node[1]]
        windows.append(members)
    return [w for w in windows if w]


def pack_group(lengths: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``; their number rises until all fit."""
    k = max(1, -(-sum(lengths) // capacity))
    while True:
        windows = difference(lengths, k)
        if max(sum(lengths[i] for i in w) for w in windows) <= capacity:
            return windows
        k += 1


def cut(n: int, capacity: int, max_piece: int) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: full ones, then even leftovers."""
    full = [(s, capacity) for s in range(0, n - n % capacity, capacity)]
    rest, at = n % capacity, n - n % capacity
    parts = -(-rest // max_piece)
    edges = [at + rest * i // parts for i in range(parts + 1)] if parts else []
    return full + [(a, b - a) for a, b in zip(edges, edges[1:])]


def tokenized_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, max_piece: int = MAX_PIECE,
    end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``id_col, start, length, ids_crc32, doc_tokens``: one row per piece, no shuffle."""

    def make():
        from callsift.llm.word_bpe import word_bpe

        encode, closing = word_bpe(vocabulary).encode, np.array([end_id], "<u2").tobytes()

        def run(texts: list[str]) -> dict[str, list]:
            pieces, totals = [], []
            for data in encode(texts):
                ids = np.frombuffer(data + closing, "<u2").astype("<u4").tobytes()
                n = len(ids) // 4
                totals.append(n)
                pieces.append(
                    [{"start": s, "length": m, "ids_crc32": zlib.crc32(ids[4 * s : 4 * (s + m)])} for s, m in cut(n, capacity, max_piece)]
                )
            return {"pieces": pieces, "doc_tokens": totals}

        return run

    made = map_texts(docs, make, PIECES, id_col, text_col)
    return made.select(id_col, "doc_tokens", F.explode("pieces").alias("p")).select(
        id_col, "p.start", "p.length", "p.ids_crc32", "doc_tokens"
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, id_col: str = "doc_id") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; see the module's docstring."""
    ship(pieces.sparkSession)
    schema = T.StructType(
        list(pieces.schema.fields) + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    arrow = to_arrow_schema(schema)
    length_at = pieces.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        next_id = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []
        n_held = 0

        def emit(rows: pa.Table, windows: list[list[int]], lengths: list[int]) -> pa.RecordBatch:
            nonlocal next_id
            order, seq, off = [], [], []
            for w in windows:
                at = 0
                for i in w:
                    order.append(i)
                    seq.append(next_id)
                    off.append(at)
                    at += lengths[i]
                next_id += 1
            taken = rows.take(pa.array(order, pa.int64())).combine_chunks()
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in taken.columns]
            columns = [c.cast(arrow.field(i).type) for i, c in enumerate(columns)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(seq, pa.int64()), pa.array(off, pa.int64())], schema=arrow)

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            lengths = table.column(length_at).to_pylist()
            small = [i for i, n in enumerate(lengths) if n < capacity]
            full = [[i] for i, n in enumerate(lengths) if n == capacity]
            windows = full
            if small:
                windows = full + [[small[j] for j in w] for w in pack_group([lengths[i] for i in small], capacity)]
            yield emit(table, windows, lengths)

        for batch in batches:
            for at in range(0, batch.num_rows, group):
                part = batch.slice(at, group)
                held.append(part)
                n_held += part.num_rows
                while n_held >= group:
                    table = pa.Table.from_batches(held)
                    yield from flush(table.slice(0, group))
                    held = table.slice(group).to_batches()
                    n_held -= group
        if n_held:
            yield from flush(pa.Table.from_batches(held))

    dealt = pieces.repartition(id_col, "start").sortWithinPartitions(F.col("length") == capacity, id_col, "start", "ids_crc32")
    return dealt.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its sequence and offset."""
    return pack(tokenized_pieces(docs, vocabulary, capacity, id_col=id_col, text_col=text_col), capacity, id_col=id_col)
