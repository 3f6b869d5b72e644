"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every token is masked in turn and predicted from the ``SIDE`` tokens before and after it. A
token is a lower-cased run without white space; its *cell* is its ending (one of ``ENDINGS``,
a hash of the last two letters) and ``CELL_BITS`` bits of its own hash. The probability of a
token is that of its cell:

    p(token | both sides) = p(class | both sides) * p(cell | class)

The network (embeddings of the neighbours, one hidden layer, a softmax) gives the class: each of
the ``SINGLES`` most frequent cells is a class of its own, all other cells have their ending's. Within
a class a cell has its share of the tokens, counted over all documents. A document's score is
the sum of its tokens' log-probabilities, also given per token.

The network is trained here, in numpy, on every token of every document. Documents are dealt
to trainers by a hash of identifier and text, about ``TRAINER_TOKENS`` tokens each however large
the corpus; each trainer takes its documents in the hash's order, in minibatches of fixed size, from
a start that the documents with the smallest hashes give, and the networks are averaged in the
trainers' order, ``FAN_IN`` at a time, weighted by tokens. So the scores are a function of the
documents, however these are partitioned (but for the rounding of sums in single precision).

Cell counts and networks have a fixed size; counts are summed in ranges of cells, and only
ranges, sums and counts of tokens reach the driver. Scoring covers every token of every whole text and needs no
shuffle. Edge cases: null and empty texts have no tokens, a sum of 0 and a mean of 0; a null
identifier is hashed like any other; repeated rows are trained on and scored each; fitting an
empty table gives the untrained network; an empty table has no scores; further columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.llm._arrow import chunks, map_texts
from callsift.llm._shared import discard, materialize
from callsift.shipping import ship

SIDE = 2
OFFSETS = [*range(-SIDE, 0), *range(1, SIDE + 1)]
#: Classes of endings, and bits of a token's own hash within one.
ENDINGS, CELL_BITS = 48, 16
CELLS = ENDINGS << CELL_BITS
#: Cells that are classes of their own, and those that the network reads as themselves.
SINGLES, READ = 16, 4096
CLASSES = SINGLES + ENDINGS
#: Input ids: the cells read as themselves, then the endings, then the place beyond a text's ends.
PAD = READ + ENDINGS
EMBED, HIDDEN = 16, 32
#: Tokens of an unseen cell, for its share of its class.
UNSEEN = 0.01
BATCH = 4096
RATE = 0.01
TRAINER_TOKENS = 4_000_000
#: Documents of the start, on average, and the times it goes through them.
START_DOCS, START_ROUNDS = 400, 2
#: Networks that are averaged at once.
FAN_IN = 32
#: Tokens whose cells are counted before a task passes them on.
FLUSH_TOKENS = 4_000_000
#: Different tokens whose cells a worker remembers.
REMEMBERED = 400_000


# --- tokens ---------------------------------------------------------------------------------


class Cells:
    """Cells of texts' tokens."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def _learn(self, word: str) -> int:
        raw = word.encode("utf-8", "replace")
        ending = zlib.crc32(word[-2:].encode("utf-8", "replace")) % ENDINGS
        cell = self.known[word] = ending << CELL_BITS | zlib.crc32(raw, 7) & (1 << CELL_BITS) - 1
        return cell

    def of(self, text: str) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        get, learn = self.known.get, self._learn
        return np.array([c if (c := get(w)) is not None else learn(w) for w in text.lower().split()], np.int32)


class Vocabulary:
    """What the cell counts of a corpus say: input id, class and share of every cell."""

    def __init__(self, counts: np.ndarray):
        self.total = int(counts.sum())
        top = np.lexsort((np.arange(CELLS), -counts))[:READ]
        top = top[counts[top] > 0]
        ending = np.arange(CELLS) >> CELL_BITS
        self.input = (READ + ending).astype(np.uint16)
        self.input[top] = np.arange(len(top))
        self.klass = (SINGLES + ending).astype(np.uint8)
        singles = top[:SINGLES]
        self.klass[singles] = np.arange(len(singles))
        rest = counts.astype(np.float64)
        rest[singles] = 0
        per_class = rest.reshape(ENDINGS, -1).sum(1)[ending]
        self.share = np.log((rest + UNSEEN) / (per_class + UNSEEN * (1 << CELL_BITS))).astype(np.float32)
        self.share[singles] = 0
        #: Class by input id.
        self.class_of_input = np.concatenate((np.zeros(READ), SINGLES + np.arange(ENDINGS), [0])).astype(np.int64)
        self.class_of_input[: len(top)] = self.klass[top]


def cell_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Tokens of every cell over all documents."""
    spark = docs.sparkSession
    ship(spark)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = [CELLS * i // ranges for i in range(ranges + 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[np.ndarray]) -> pa.RecordBatch:
            cells, n = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(cells, edges)
            some = [r for r in range(ranges) if cuts[r] < cuts[r + 1]]
            blobs = [cells[cuts[r] : cuts[r + 1]].astype("<u4").tobytes() + n[cuts[r] : cuts[r + 1]].astype("<u4").tobytes() for r in some]
            return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(blobs, pa.binary())], ["range", "blob"])

        cells, held, size = Cells(), [], 0
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                for t in texts:
                    held.append(cells.of(t))
                    size += len(held[-1])
                if size > FLUSH_TOKENS:
                    yield out(held)
                    held, size = [], 0
        if size:
            yield out(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for r, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                cells, n = np.frombuffer(blob.as_py(), "<u4").reshape(2, -1)
                if r not in totals:
                    totals[r] = np.zeros(edges[r + 1] - edges[r], np.int64)
                totals[r][cells - edges[r]] += n
        for r, own in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([own.tobytes()], pa.binary())], ["range", "blob"])

    counted = docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(count, "range int, blob binary")
    counts = np.zeros(CELLS, np.int64)
    for r in counted.repartition(ranges, "range").mapInArrow(add, "range int, blob binary").collect():
        counts[edges[r.range] : edges[r.range + 1]] = np.frombuffer(r.blob, np.int64)
    return counts


# --- network --------------------------------------------------------------------------------


SHAPES = {
    "embed": (PAD + 1, EMBED), "inner": (2 * SIDE * EMBED, HIDDEN), "inner_bias": (HIDDEN,), "klass": (HIDDEN, CLASSES), "klass_bias": (CLASSES,),
}


class Network:
    def __init__(self, flat: np.ndarray | None = None, seed: int = 3):
        n = sum(int(np.prod(s)) for s in SHAPES.values())
        self.flat = np.random.default_rng(seed).normal(0, 0.1, n).astype(np.float32) if flat is None else flat
        at = 0
        for name, shape in SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + size].reshape(shape))
            at += size

    def layers(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input, hidden layer, and exponentials of the classes' scores."""
        x = self.embed[context].reshape(len(context), -1)
        h = np.tanh(x @ self.inner + self.inner_bias)
        return x, h, np.exp(h @ self.klass + self.klass_bias)

    def log_probabilities(self, context: np.ndarray, klass: np.ndarray) -> np.ndarray:
        _, _, a = self.layers(context)
        return np.log(a[np.arange(len(a)), klass] / a.sum(1))

    def gradient(self, context: np.ndarray, klass: np.ndarray) -> "Network":
        """Gradient of the mean loss, shaped as a network."""
        g = Network(np.zeros_like(self.flat))
        n = len(klass)
        x, h, a = self.layers(context)
        a /= a.sum(1, keepdims=True)
        a[np.arange(n), klass] -= 1
        a /= n
        g.klass[:], g.klass_bias[:] = h.T @ a, a.sum(0)
        dz = (a @ self.klass.T) * (1 - h * h)
        g.inner[:], g.inner_bias[:] = x.T @ dz, dz.sum(0)
        dx = (dz @ self.inner.T).reshape(-1, EMBED)
        flat = context.ravel()
        order = np.argsort(flat, kind="stable")
        heads = np.flatnonzero(np.concatenate(([True], np.diff(flat[order]) != 0)))
        g.embed[flat[order[heads]]] = np.add.reduceat(dx[order], heads, axis=0)
        return g


class Trainer:
    """Adam over minibatches of ``BATCH`` tokens, as they come."""

    def __init__(self, network: Network, vocabulary: Vocabulary, rate: float = RATE):
        self.net, self.vocabulary, self.rate, self.steps, self.seen = network, vocabulary, rate, 0, 0
        self.m, self.v = np.zeros_like(network.flat), np.zeros_like(network.flat)

    def train(self, line: np.ndarray) -> None:
        """Every token of a line of documents that ``joined`` gives."""
        places = np.flatnonzero(line != PAD)
        for at in range(0, len(places), BATCH):
            p = places[at : at + BATCH]
            self.step(line[p[:, None] + np.array(OFFSETS)], self.vocabulary.class_of_input[line[p]])

    def step(self, context: np.ndarray, klass: np.ndarray) -> None:
        g = self.net.gradient(context, klass).flat
        self.steps += 1
        self.seen += len(klass)
        self.m += 0.1 * (g - self.m)
        self.v += 0.001 * (g * g - self.v)
        rate = self.rate / np.sqrt(1 + self.steps / 200)
        scale = np.float32(rate / (1 - 0.9**self.steps))
        self.net.flat -= scale * self.m / (np.sqrt(self.v / np.float32(1 - 0.999**self.steps)) + np.float32(1e-8))


def joined(documents: list[np.ndarray]) -> np.ndarray:
    """Input ids of documents in one line, with ``SIDE`` pads around each."""
    gap = np.full(SIDE, PAD, np.uint16)
    return np.concatenate([gap] + [y for x in documents for y in (x, gap)])


def _average(networks: DataFrame) -> np.ndarray | None:
    """Weighted mean of ``trainer, n, net`` rows, in the trainers' order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, n = None, None, 0

        def out() -> pa.RecordBatch:
            mean = (total / n).astype(np.float32).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([n], pa.int64()), pa.array([mean], pa.binary())], ["trainer", "n", "net"])

        for batch in batches:
            for group, weight, net in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if group != now and n:
                    yield out()
                    total, n = None, 0
                now = group
                part = np.frombuffer(net.as_py(), np.float32).astype(np.float64) * weight
                total = part if total is None else total + part
                n += weight
        if n:
            yield out()

    while True:
        rows = networks.count()
        if rows <= 1:
            found = networks.collect()
            return np.frombuffer(found[0].net, np.float32).copy() if found else None
        grouped = networks.withColumn("group", F.floor(F.col("trainer") / FAN_IN).cast("long"))
        parts = max(1, -(-rows // FAN_IN))
        means = grouped.repartition(parts, "group").sortWithinPartitions("group", "trainer").select("group", "n", "net").mapInArrow(run, "trainer long, n long, net binary")
        means = materialize(means, "networks")
        discard(networks)
        networks = means


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trainer_tokens: int = TRAINER_TOKENS) -> tuple[Vocabulary, Network]:
    """Vocabulary and network; both rest on every token of all documents."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(cell_counts(docs, text_col))
    if not vocabulary.total:
        return vocabulary, Network()
    trainers = max(1, -(-vocabulary.total // trainer_tokens))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"))
    # Documents below this hash are the start: a share of the documents, not of the rows' order.
    share = min(1.0, START_DOCS / max(1, docs.count()))
    limit = min(int(share * 2**64) - 2**63, 2**63 - 1)
    sent = spark.sparkContext.broadcast(vocabulary.input)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, inputs = Cells(), sent.value
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, texts in chunks(batch.column(1)):
                own = keys[first : first + len(texts)]
                coded = [inputs[cells.of(t)] for t in texts]
                target = (own.view(np.uint64) % np.uint64(trainers)).astype(np.int64)
                some, blobs = [], []
                for t in np.unique(target).tolist():
                    at = np.flatnonzero(target == t)
                    sizes = np.array([len(coded[i]) for i in at], np.uint32)
                    some.append(t)
                    blobs.append(np.int64(len(at)).tobytes() + own[at].tobytes() + sizes.tobytes() + b"".join(coded[i].tobytes() for i in at))
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(blobs, pa.binary())], ["trainer", "blob"])

    def documents(blobs: list[bytes]) -> list[np.ndarray]:
        """All documents of the blobs by hash; those of equal hash are equal."""
        keys, found = [], []
        for blob in blobs:
            n = int(np.frombuffer(blob, np.int64, 1)[0])
            keys.append(np.frombuffer(blob, np.int64, n, 8))
            sizes = np.frombuffer(blob, np.uint32, n, 8 + 8 * n)
            found += np.split(np.frombuffer(blob, np.uint16, -1, 8 + 12 * n), np.cumsum(sizes.astype(np.int64))[:-1])
        order = np.lexsort((np.array([len(x) for x in found]), np.concatenate(keys)))
        return [found[i] for i in order.tolist()]

    dealt = rows.where(F.octet_length("text") > 0).mapInArrow(deal, "trainer long, blob binary")
    first = rows.where(F.col("key") <= limit).dropDuplicates(["key"]).mapInArrow(deal, "trainer long, blob binary").collect()
    start = Trainer(Network(), vocabulary)
    if first:
        line = joined(documents([bytes(r.blob) for r in first]))
        for _ in range(START_ROUNDS):
            start.train(line)
    begun = spark.sparkContext.broadcast((vocabulary.class_of_input, start.net.flat))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(trainer: int, blobs: list[bytes]) -> pa.RecordBatch:
            known = Vocabulary.__new__(Vocabulary)
            known.class_of_input = begun.value[0]
            own = Trainer(Network(begun.value[1].copy()), known, RATE / 3)
            own.train(joined(documents(blobs)))
            return pa.RecordBatch.from_arrays(
                [pa.array([trainer], pa.int64()), pa.array([own.seen], pa.int64()), pa.array([own.net.flat.tobytes()], pa.binary())], ["trainer", "n", "net"]
            )

        now, held = None, []
        for batch in batches:
            for trainer, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if trainer != now and held:
                    yield out(now, held)
                    held = []
                now = trainer
                held.append(blob.as_py())
        if held:
            yield out(now, held)

    placed = dealt.repartition(2 * trainers, "trainer").sortWithinPartitions("trainer")
    networks = materialize(placed.mapInArrow(train, "trainer long, n long, net binary"), "networks")
    flat = _average(networks.where("n > 0"))
    discard(networks)
    return vocabulary, Network(flat) if flat is not None else start.net


def score(docs: DataFrame, vocabulary: Vocabulary, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, log_likelihood, mean_log_likelihood`` for every row."""
    held = docs.sparkSession.sparkContext.broadcast((vocabulary.input, vocabulary.klass, vocabulary.share, net.flat))

    def make():
        inputs, klass, share, flat = held.value
        net, cells = Network(flat), Cells()

        def run(texts: list[str]) -> dict[str, list]:
            coded = [cells.of(t) for t in texts]
            sizes = np.array([len(x) for x in coded])
            every = np.concatenate(coded)
            line = joined([inputs[x] for x in coded])
            places = np.flatnonzero(line != PAD)
            logs = share[every].astype(np.float64)
            for at in range(0, len(places), 8 * BATCH):
                p = places[at : at + 8 * BATCH]
                logs[at : at + 8 * BATCH] += net.log_probabilities(line[p[:, None] + np.array(OFFSETS)], klass[every[at : at + 8 * BATCH]])
            ends = np.concatenate(([0.0], np.cumsum(logs)))
            cuts = np.concatenate(([0], np.cumsum(sizes)))
            total = ends[cuts[1:]] - ends[cuts[:-1]]
            return {"n_tokens": sizes, "log_likelihood": total, "mean_log_likelihood": total / np.maximum(sizes, 1)}

        return run

    fields = T.StructType(
        [T.StructField("n_tokens", T.LongType()), T.StructField("log_likelihood", T.DoubleType()), T.StructField("mean_log_likelihood", T.DoubleType())]
    )
    return map_texts(docs, make, fields, id_col, text_col)
