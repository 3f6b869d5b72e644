"""Removal of repeated substrings with deep-shallow sorted suffix arrays.

A byte is removed if a ``length``-byte string that covers it also starts in a document
with a smaller identifier. The strings to compare are found by content-defined anchors:
a window's anchor is the smallest hash among its ``GRAM``-byte grams, so equal windows have
equal anchors. The steps:

1. every document's anchors go, packed in blobs, to the anchor's owner, which tells the
   documents' groups which anchors occur in more than one document;
2. the runs of windows (segments) under such anchors are collected per group of documents,
   equal ones once with their smallest identifier, and go to the anchor's owner;
3. the owner, in blocks of whole anchors, builds the suffix array of its distinct segments'
   windows, ordered to ``length`` bytes by deep-shallow sorting: multikey quicksort (three-way
   partition around a pivot character, all groups of a level at once) down to a shallow depth,
   then a blind trie per remaining group. A member walks down by branching bytes only, is
   compared once with the leaf it reaches, joins it if they agree to ``length`` bytes, else
   splits the edge at their first difference; the tries are read out in order. Neighbours
   with a common prefix of ``length`` bytes are equal, and where a smaller identifier holds a
   window than the group's own, the group is told;
4. the groups mark, in every document, the windows that a smaller identifier holds.

A passage that a third of all documents share reaches its owner once per group of
documents, not once per document, and is sorted once. Texts are dealt to their groups once.

Edge cases: null texts are empty; texts shorter than ``length`` lose nothing; rows with a
null identifier neither lose bytes nor are a source, and are not dealt; rows that repeat an
identifier are one document's versions and never remove each other's bytes; very long texts
are taken whole; an empty table gives no rows; further columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm._shared import materialize
from callsift.shipping import ship

LENGTH = 50
#: Bytes of a gram; a window has LENGTH - GRAM + 1 of them.
GRAM = 16
#: Longest run of windows kept as one segment.
LONGEST = 128
#: Depth of the multikey quicksort; deeper groups go to blind tries.
SHALLOW = 16
#: Bytes of text whose anchors are found at once.
BLOCK = 1_000_000
#: Windows that are sorted at once, rounded up to whole anchors.
SORTED = 1_000_000


# --- anchors --------------------------------------------------------------------------------


def _grams(x: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A mixed 64-bit hash of every ``size``-byte gram (``size`` a power of two)."""
    table = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = np.uint64(0x9E3779B97F4A7C15)
    h, power, width = table[x], base, 1
    while width < size:
        h = h[:-width] * power + h[width:]
        power = np.uint64(int(power) ** 2 % 2**64)
        width *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    m, done = h, 1
    while 2 * done <= width:
        m = np.minimum(m[:-done], m[done:])
        done *= 2
    rest = width - done
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def segments(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text number, first window, number of windows, anchor)`` of all segments of the texts."""
    parts: list[list[np.ndarray]] = [[], [], [], []]
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= BLOCK):
            size += len(texts[stop])
            stop += 1
        sizes = np.fromiter((len(t) for t in texts[at:stop]), np.int64, stop - at)
        x = np.frombuffer(b"".join(texts[at:stop]), np.uint8)
        if len(x) >= length:
            m = _sliding_min(_grams(x), length - GRAM + 1)  # one entry per window
            first = np.cumsum(sizes) - sizes
            doc = np.repeat(np.arange(stop - at), sizes)[: len(m)]
            place = np.arange(len(m)) - first[doc]
            ok = place + length <= sizes[doc]
            new = np.ones(len(m), bool)
            new[1:] = (m[1:] != m[:-1]) | (doc[1:] != doc[:-1]) | ~ok[:-1]
            new |= place % LONGEST == 0
            starts = np.flatnonzero(new & ok)
            edges = np.flatnonzero(new | ~ok)
            nxt = np.append(edges, len(m))[np.searchsorted(edges, starts) + 1]
            for store, value in zip(parts, (doc[starts] + at, place[starts], nxt - starts, m[starts])):
                store.append(value)
        at = stop
    kinds = (np.int64, np.int64, np.int64, np.uint64)
    return tuple(np.concatenate(p) if p else np.zeros(0, k) for p, k in zip(parts, kinds))


# --- deep-shallow sorting -------------------------------------------------------------------


def _words(buf: np.ndarray) -> np.ndarray:
    """The eight bytes at every place, as big-endian numbers; the buffer is padded with zeros."""
    b = np.concatenate((buf, np.zeros(8, np.uint8)))
    out = np.zeros(len(buf), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | b[j : j + len(buf)]
    return out


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Flags of the first element of each run of equal keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def deep_shallow(
    buf: np.ndarray, starts: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW, apart: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at ``starts`` in order of their first ``length`` bytes, and flags of new classes.

    ``order[i]`` is an index into ``starts``; ``first[i]`` says that suffix ``i`` differs from
    the one before within ``length`` bytes. Every suffix has at least ``length`` bytes. With
    ``apart`` (ascending) only suffixes of equal value are sorted among each other.
    """
    n = len(starts)
    order, first = np.arange(n), np.zeros(n, bool)
    if not n:
        return order, first
    words = _words(np.concatenate((buf, np.zeros(length, np.uint8))))
    group = np.zeros(n, np.int64) if apart is None else np.cumsum(_runs(apart)) - 1
    first[_runs(group)] = True
    deep = multikey_quicksort(words, starts, order, first, group, shallow)
    for where, group in deep:
        blind_tries(buf, words, starts, order, first, where, group, length)
    return order, first


def multikey_quicksort(
    words: np.ndarray, starts: np.ndarray, order: np.ndarray, first: np.ndarray, group: np.ndarray, shallow: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sort in place to ``shallow`` bytes, by characters of eight bytes.

    Each round partitions every open group into what is less than, equal to and greater than
    its pivot, the median of three members' characters; only what is equal moves on to the
    next character. Returns ``(places, group)`` of what is still alike at ``shallow``.
    """
    where, depth = np.arange(len(order)), np.zeros(len(order), np.int64)
    deep = []
    while len(where):
        heads = np.flatnonzero(_runs(group))
        sizes = np.diff(np.append(heads, len(where)))
        group = np.repeat(np.arange(len(heads)), sizes)
        own = order[where]
        key = words[starts[own] + depth]
        pivot = _middle(key[heads], key[heads + sizes // 2], key[heads + sizes - 1])[group]
        part = 3 * group + (key >= pivot) + (key > pivot)
        by = np.argsort(part, kind="stable")
        order[where], part = own[by], part[by]
        new = _runs(part)
        first[where] |= new
        depth = depth[by] + 8 * (part % 3 == 1)
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        done = many & (depth >= shallow)
        if done.any():
            deep.append((where[done], group[done]))
        many &= depth < shallow
        where, group, depth = where[many], group[many], depth[many]
    return deep


def _middle(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))


def common_prefix(words: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int, length: int) -> np.ndarray:
    """Bytes, at most ``length``, that the suffixes at ``a`` and ``b`` share; ``depth`` are known to."""
    out = np.full(len(a), length)
    open_ = np.arange(len(a))
    for d in range(depth, length, 8):
        x = words[a[open_] + d] ^ words[b[open_] + d]
        differs = x != 0
        if differs.any():
            # Smear the highest set bit down; the bits above it are the equal ones.
            y = x[differs]
            for s in (1, 2, 4, 8, 16, 32):
                y |= y >> np.uint64(s)
            out[open_[differs]] = np.minimum(d + (64 - np.bitwise_count(y).astype(np.int64)) // 8, length)
            open_ = open_[~differs]
    return out


class Tries:
    """Blind tries of many groups: nodes with the byte's place that they branch at, and a leaf below."""

    def __init__(self, leaves: np.ndarray, length: int):
        n = len(leaves)  # one leaf to begin with in each
        self.depth, self.leaf = np.full(n, length), leaves
        self.root = np.arange(n)
        self.parent, self.byte = np.full(n, -1), np.zeros(n, np.int64)
        self.keys, self.child = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Child of each node by a byte; -1 if it has none."""
        key = node * 256 + byte
        if not len(self.keys):
            return np.full(len(node), -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.child[at], -1)

    def grow(self, depth: np.ndarray, leaf: np.ndarray, parent: np.ndarray, byte: np.ndarray) -> np.ndarray:
        made = np.arange(len(self.depth), len(self.depth) + len(depth))
        self.depth, self.leaf = np.concatenate((self.depth, depth)), np.concatenate((self.leaf, leaf))
        self.parent, self.byte = np.concatenate((self.parent, parent)), np.concatenate((self.byte, byte))
        return made

    def link(self) -> None:
        """The table of children, from parents and bytes."""
        inner = np.flatnonzero(self.parent >= 0)
        keys = self.parent[inner] * 256 + self.byte[inner]
        by = np.argsort(keys)
        self.keys, self.child = keys[by], inner[by]


def blind_tries(
    buf: np.ndarray, words: np.ndarray, starts: np.ndarray, order: np.ndarray, first: np.ndarray,
    where: np.ndarray, group: np.ndarray, length: int,
) -> None:
    """Order the members of each group at the places ``where``; members wait in turns for an edge."""
    heads = _runs(group)
    group = np.cumsum(heads) - 1
    own = order[where]
    at = starts[own]
    trie = Tries(np.flatnonzero(heads), length)
    node = np.full(len(own), -1)  # the leaf node of each member
    node[heads] = trie.root
    left = np.flatnonzero(~heads)
    while len(left):
        # Down by branching bytes, to any leaf where there is no such child.
        now, walking = trie.root[group[left]], np.arange(len(left))
        while len(walking):
            walking = walking[trie.depth[now[walking]] < length]
            to = trie.step(now[walking], buf[at[left[walking]] + trie.depth[now[walking]]].astype(np.int64))
            now[walking[to >= 0]] = to[to >= 0]
            walking = walking[to >= 0]
        reached = trie.leaf[now]
        common = common_prefix(words, at[left], at[reached], 0, length)
        same = common == length
        node[left[same]] = node[reached[same]]
        left, reached, common = left[~same], reached[~same], common[~same]
        if not len(left):
            break
        # Down again to the edge that the first difference lies on.
        now, walking = trie.root[group[left]], np.arange(len(left))
        while len(walking):
            walking = walking[trie.depth[now[walking]] < common[walking]]
            now[walking] = trie.step(now[walking], buf[at[left[walking]] + trie.depth[now[walking]]].astype(np.int64))
        byte = buf[at[left] + common].astype(np.int64)
        branch = trie.depth[now] == common
        # One member for each edge, and for each new byte of a node that branches there.
        _, chosen = np.unique(now * 257 + np.where(branch, byte, 256), return_index=True)
        now, common, byte, branch, new = now[chosen], common[chosen], byte[chosen], branch[chosen], left[chosen]
        above = now.copy()
        cut = np.flatnonzero(~branch)
        if len(cut):
            old = now[cut]
            made = trie.grow(common[cut], trie.leaf[old], trie.parent[old], trie.byte[old])
            trie.root[group[new[cut]][trie.parent[old] < 0]] = made[trie.parent[old] < 0]
            trie.parent[old], trie.byte[old] = made, buf[at[trie.leaf[old]] + common[cut]]
            above[cut] = made
        node[new] = trie.grow(np.full(len(new), length), new, above, byte)
        trie.link()
        rest = np.ones(len(left), bool)
        rest[chosen] = False
        left = left[rest]
    # Read out: members below each node, from the deepest up, then places from the roots down.
    count = np.bincount(node, minlength=len(trie.depth))
    levels = [np.flatnonzero(trie.depth == d) for d in range(length + 1)]
    for nodes in reversed(levels):
        nodes = nodes[trie.parent[nodes] >= 0]
        np.add.at(count, trie.parent[nodes], count[nodes])
    place = np.zeros(len(trie.depth), np.int64)
    place[trie.root] = np.flatnonzero(heads)
    if len(trie.keys):
        held = count[trie.child]
        before = np.cumsum(held) - held
        sibling = _runs(trie.keys // 256)
        offset = np.zeros(len(trie.depth), np.int64)
        offset[trie.child] = before - before[sibling][np.cumsum(sibling) - 1]
        for nodes in levels:
            nodes = nodes[trie.parent[nodes] >= 0]
            place[nodes] = place[trie.parent[nodes]] + offset[nodes]
    by = np.argsort(place[node], kind="stable")
    order[where] = own[by]
    first[where] |= _runs(node[by])


# --- packing of blobs -----------------------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    return np.int64(len(arrays[0])).tobytes() + b"".join(a.tobytes() for a in arrays)


def _unpack(blob: bytes, *kinds: str) -> tuple[list[np.ndarray], bytes]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    out, at = [], 8
    for k in kinds:
        a = np.frombuffer(blob, k, n, at)
        out.append(a)
        at += a.nbytes
    return out, blob[at:]


def _split(target: np.ndarray, n: int, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    by = np.argsort(target, kind="stable")
    cuts = np.searchsorted(target[by], np.arange(n + 1))
    for t in range(n):
        if cuts[t] < cuts[t + 1]:
            rows = by[cuts[t] : cuts[t + 1]]
            yield t, [a[rows] for a in arrays]


def _home(ids: np.ndarray, n: int) -> np.ndarray:
    """Group of documents that an identifier belongs to: ``pmod(xxhash64(id), n)`` as Spark has it."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    h = np.full(len(ids), 42 + 8, np.uint64) + p5
    h ^= turn(ids.astype(np.int64).view(np.uint64) * p2, 31) * p1
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    h ^= h >> np.uint64(32)
    return np.mod(h.view(np.int64), n)


def _key(anchor: np.ndarray, n: int) -> np.ndarray:
    """Owner and 32 bits of an anchor. An owner's share of anchors stays the same as data and
    owners grow, so the chance that two of them meet does, too; it costs a comparison, no result."""
    return ((anchor >> np.uint64(40)) % np.uint64(n)) << np.uint64(32) | (anchor & np.uint64(0xFFFFFFFF))


def _by_key(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[int, list[list]]]:
    """Rows of sorted batches, gathered by their first column."""
    now, held = None, [[] for _ in range(columns)]
    for batch in batches:
        for row in zip(*(batch.column(i) for i in range(columns + 1))):
            key = row[0].as_py()
            if key != now and held[0]:
                yield now, held
                held = [[] for _ in range(columns)]
            now = key
            for store, value in zip(held, row[1:]):
                store.append(value.as_py())
    if held[0]:
        yield now, held


def _batch(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


# --- the operator ---------------------------------------------------------------------------


def _group_segments(ids: np.ndarray, texts: list[bytes], shared: list[np.ndarray], length: int, n: int):
    """Shared segments of one group's documents, and their distinct texts.

    Returns ``(doc, start, windows, which)`` per segment and ``(text, smallest id, key)`` per distinct text.
    """
    doc, start, count, anchor = segments(texts, length)
    key = _key(anchor, n)
    wanted = np.zeros(len(doc), bool)
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
    for d, own in enumerate(shared):
        a, b = cuts[d], cuts[d + 1]
        if a < b and len(own):
            at = np.minimum(np.searchsorted(own, key[a:b]), len(own) - 1)
            wanted[a:b] = own[at] == key[a:b]
    doc, start, count, key = doc[wanted], start[wanted], count[wanted], key[wanted]
    seen: dict[bytes, int] = {}
    which = np.empty(len(doc), np.int64)
    for i, (d, s, c) in enumerate(zip(doc.tolist(), start.tolist(), count.tolist())):
        which[i] = seen.setdefault(texts[d][s : s + c + length - 1], len(seen))
    least = np.full(len(seen), np.iinfo(np.int64).max)
    np.minimum.at(least, which, ids[doc])
    owner = np.zeros(len(seen), np.uint64)
    owner[which] = key
    return (doc, start, count, which), (list(seen), least, owner)


def _read_group(left: pa.Table, right: pa.Table) -> tuple[list, np.ndarray, list[bytes], list[np.ndarray]]:
    """A group's documents in a fixed order: identifiers (also as numbers), texts, shared keys."""
    rows = sorted(zip(left.column("id").to_pylist(), left.column("text").to_pylist()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    # One sort over the blobs of all owners: an identifier has rows in nearly as many as it has anchors.
    all_ids, all_keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for kind, blob in zip(right.column("kind").to_pylist(), right.column("blob").to_pylist()):
        if kind == SHARED:
            (ids, low), owner = _unpack(blob, "i8", "u4")
            all_ids.append(ids)
            all_keys.append(np.uint64(int.from_bytes(owner, "little") << 32) | low.astype(np.uint64))
    ids, key = np.concatenate(all_ids), np.concatenate(all_keys)
    by = np.lexsort((key, ids))
    by = by[_runs(ids[by], key[by])]
    ids, key = ids[by], key[by]
    heads = np.flatnonzero(_runs(ids))
    keys = {i: key[a:b] for i, a, b in zip(ids[heads].tolist(), heads.tolist(), np.append(heads, len(ids))[1:].tolist())}
    none = np.zeros(0, np.uint64)
    own = [r[0] for r in rows]
    return own, np.array([i or 0 for i in own], np.int64), [r[1] for r in rows], [keys.get(i, none) for i in own]


#: Kinds of blobs that come back to a group of documents.
SHARED, ANSWER = 0, 1


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, spans, kept`` of every row of ``docs``; spans are maximal removed runs of bytes.

    The documents are dealt to their groups once; both visits to a group read that one exchange.
    """
    spark = docs.sparkSession
    ship(spark)
    # Groups and owners exchange a blob each, so their number is kept near that of partitions.
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text")
    )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["target", "blob"], [pa.int32(), pa.binary()]
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size < 4 * BLOCK):
                    size += len(texts[stop])
                    stop += 1
                doc, _, _, anchor = segments(texts[at:stop], length)
                key = _key(anchor, n)
                low, target = key.astype(np.uint32), (key >> np.uint64(32)).astype(np.int64)
                yield _batch(names, kinds, [(t, _pack(a, d)) for t, (a, d) in _split(target, n, low, ids[at + doc])])
                at = stop

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["home", "kind", "blob"], [pa.int32(), pa.int32(), pa.binary()]
        for target, (blobs,) in _by_key(batches, 1):
            parts = [_unpack(b, "u4", "i8")[0] for b in blobs]
            low, ids = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            by = np.argsort(low, kind="stable")
            low, ids = low[by], ids[by]
            cut = np.flatnonzero(_runs(low))
            several = np.minimum.reduceat(ids, cut) != np.maximum.reduceat(ids, cut)
            keep = np.repeat(several, np.diff(np.append(cut, len(low))))
            low, ids = low[keep], ids[keep]
            owner = target.to_bytes(8, "little")
            yield _batch(names, kinds, [(h, SHARED, _pack(d, a) + owner) for h, (d, a) in _split(_home(ids, n), n, ids, low)])

    def pick(key, left: pa.Table, right: pa.Table) -> pa.Table:
        _, ids, texts, shared = _read_group(left, right)
        _, (distinct, least, owner) = _group_segments(ids, texts, shared, length, n)
        target = (owner >> np.uint64(32)).astype(np.int64)
        home = left.column("home")[0].as_py() if left.num_rows else 0
        made = []
        for t, (which,) in _split(target, n, np.arange(len(distinct))):
            own = [distinct[i] for i in which.tolist()]
            sizes = np.fromiter(map(len, own), np.uint16, len(own))
            made.append((t, home, _pack(which.astype(np.uint32), least[which], sizes, owner[which].astype(np.uint32)) + b"".join(own)))
        return pa.Table.from_batches([_batch(["target", "home", "blob"], [pa.int32(), pa.int32(), pa.binary()], made)])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["home", "kind", "blob"], [pa.int32(), pa.int32(), pa.binary()]
        for _, (homes, blobs) in _by_key(batches, 2):
            # Segments of all groups, equal ones once.
            seen: dict[bytes, int] = {}
            parts, low = [], []
            while blobs:
                (which, least, sizes, anchor), raw = _unpack(blobs.pop(0), "u4", "i8", "u2", "u4")
                ends = np.cumsum(sizes.astype(np.int64)).tolist()
                new = len(seen)
                own = np.array([seen.setdefault(raw[e - s : e], len(seen)) for s, e in zip(sizes.tolist(), ends)], np.int64)
                parts.append((which, least, own))
                _, at = np.unique(own, return_index=True)
                low.append(anchor[at[own[at] >= new]])
            least = np.full(len(seen), np.iinfo(np.int64).max)
            for _, ids, own in parts:
                np.minimum.at(least, own, ids)
            runs = _smaller_runs(list(seen), np.concatenate(low), least, length)
            del seen
            made = []
            for home, (which, ids, own) in zip(homes, parts):
                seg, place, count, best = _expand(runs, own)
                gone = best < ids[seg]
                made.append((home, ANSWER, _pack(which[seg[gone]], place[gone].astype(np.uint16), count[gone].astype(np.uint16))))
            yield _batch(names, kinds, made)

    def mark(key, left: pa.Table, right: pa.Table) -> pa.Table:
        own, ids, texts, shared = _read_group(left, right)
        (doc, start, windows, which), (_, least, _) = _group_segments(ids, texts, shared, length, n)
        parts = [_unpack(b, "u4", "u2", "u2")[0] for k, b in zip(right.column("kind").to_pylist(), right.column("blob").to_pylist()) if k == ANSWER]
        seg, place, count = (np.concatenate([p[i] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64) for i in range(3))
        # A smaller identifier of the group itself holds the whole segment; others as the owner says.
        inside = ids[doc] > least[which]
        by = np.argsort(seg, kind="stable")
        seg, place, count = seg[by], place[by], count[by]
        lo, hi = np.searchsorted(seg, which), np.searchsorted(seg, which, "right")
        n_runs = np.where(inside, 0, hi - lo)
        member = np.repeat(np.arange(len(doc)), n_runs)
        run = np.arange(len(member)) - np.repeat(np.cumsum(n_runs) - n_runs, n_runs) + lo[member]
        d = np.concatenate((doc[member], doc[inside]))
        a = np.concatenate((start[member] + place[run], start[inside]))
        b = a + np.concatenate((count[run], windows[inside])) - 1 + length
        order = np.lexsort((a, d))
        d, a, b = d[order], a[order], b[order]
        cuts = np.searchsorted(d, np.arange(len(ids) + 1))
        sizes, spans, kept = [], [], []
        for i, t in enumerate(texts):
            merged: list[list[int]] = []
            for x, y in zip(a[cuts[i] : cuts[i + 1]].tolist(), b[cuts[i] : cuts[i + 1]].tolist()):
                if merged and x <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], y)
                else:
                    merged.append([x, y])
            at, left_over = 0, []
            for x, y in merged:
                left_over.append(t[at:x])
                at = y
            sizes.append(len(t))
            spans.append([{"start": x, "end": y} for x, y in merged])
            kept.append(b"".join([*left_over, t[at:]]))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"id": pa.array(own, pa.int64()), "n_bytes": pa.array(sizes, pa.int64()), "spans": pa.array(spans, span), "kept": pa.array(kept, pa.binary())})

    known = rows.where("id is not null")
    shared = (
        known.where(F.octet_length("text") >= length).mapInArrow(send, "target int, blob binary")
        .repartition(n, "target").sortWithinPartitions("target").mapInArrow(meet, "home int, kind int, blob binary")
    )
    shared = materialize(shared, "shared")  # read by both visits
    placed = known.withColumn("home", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    answers = (
        placed.groupBy("home").cogroup(shared.groupBy("home")).applyInArrow(pick, "target int, home int, blob binary")
        .repartition(n, "target").sortWithinPartitions("target", "home").mapInArrow(solve, "home int, kind int, blob binary")
    )
    back = shared.unionByName(answers)
    span = "array<struct<start:long,end:long>>"
    done = placed.groupBy("home").cogroup(back.groupBy("home")).applyInArrow(mark, f"id long, n_bytes long, spans {span}, kept binary")
    nameless = rows.where("id is null").select("id", F.octet_length("text").cast("long").alias("n_bytes"), F.array().cast(span).alias("spans"), F.col("text").alias("kept"))
    return done.unionByName(nameless)


def _smaller_runs(texts: list[bytes], anchor: np.ndarray, least: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(bounds, first window, windows, smallest identifier)``: runs of equal minima in all segments.

    The runs of segment ``i`` are those from ``bounds[i]`` to ``bounds[i + 1]``. Segments are sorted in blocks of whole anchors, so what is held at once does not grow with an owner.
    """
    by = np.argsort(anchor, kind="stable")
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))[by]
    ends = np.cumsum(sizes - length + 1)
    cuts, heads = [0], np.flatnonzero(_runs(anchor[by]))
    for h in heads[1:].tolist():
        if ends[h - 1] - (ends[cuts[-1] - 1] if cuts[-1] else 0) >= SORTED:
            cuts.append(h)
    out = [[np.zeros(0, np.int64)] for _ in range(4)]
    for a, b in zip(cuts, cuts[1:] + [len(by)]):
        own, size = by[a:b], sizes[a:b]
        buf = np.frombuffer(b"".join([texts[i] for i in own.tolist()]), np.uint8)
        counts = size - length + 1
        seg = np.repeat(np.arange(len(own)), counts)
        within = np.arange(len(seg)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = (np.cumsum(size) - size)[seg] + within
        order, first = deep_shallow(buf, starts, length, apart=anchor[own][seg])
        cut = np.flatnonzero(first)
        best = np.empty(len(starts), np.int64)
        best[order] = np.repeat(np.minimum.reduceat(least[own][seg[order]], cut), np.diff(np.append(cut, len(order)))) if len(cut) else 0
        at = np.flatnonzero(_runs(seg, best))
        runs = (own[seg[at]], within[at], np.diff(np.append(at, len(best))), best[at])
        for store, value in zip(out, runs):
            store.append(value)
    seg, *rest = (np.concatenate(x) for x in out)
    by = np.argsort(seg, kind="stable")
    bounds = np.concatenate(([0], np.cumsum(np.bincount(seg, minlength=len(texts)))))
    return bounds, *(x[by] for x in rest)


def _expand(runs: tuple[np.ndarray, ...], own: np.ndarray) -> tuple[np.ndarray, ...]:
    """``runs`` of the segments ``own``, numbered by their place there.

    Called once for every group that an owner answers, so its time must be that of ``own`` alone.
    """
    bounds, place, count, best = runs
    lo = bounds[own]
    n = bounds[own + 1] - lo
    member = np.repeat(np.arange(len(own)), n)
    run = np.arange(len(member)) - np.repeat(np.cumsum(n) - n, n) + lo[member]
    return member, place[run], count[run], best[run]


def substring_report(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``."""
    found = remove_repeats(docs, length, id_col, text_col)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])
    return found.select(
        F.col("id").alias(id_col), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
