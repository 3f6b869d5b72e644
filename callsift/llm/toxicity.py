"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated models, one of toxic and one of ordinary texts, are trained from labelled
rows. Each gives a distribution over the word ``w`` after ``h``, in three levels:

    p_c(w | h) = e_c(h, w) + l_c(h) * p_c(w)
    p_c(w)     = e_c(w)    + l_c    * p_shared(w)

``e_c`` are discounted relative frequencies, ``max(count - discount, 0) / total``, and the
weights ``l_c`` hand the discounted mass to the next level, so both sum to one. ``p_shared``
is one Kneser-Ney unigram for both classes: a word's share of the *continuation counts*,
the number of different words it follows, itself discounted towards the uniform. The
discount of a word or pair is a constant plus ``THETA`` times the count that the other class,
given as many more texts as the constant, would lead one to expect in this one: what is rare,
or as common in either, is left to the shared backoff, and only a class's own expressions
keep mass of their own.
A word or pair counts once a text. Words that are rare in training fall back to the class of
their first letters, then to a common unknown word.

A text is judged by the length-normalised difference of its log-likelihoods, toxic less
ordinary, per word and per root of the number of words (a word without evidence counts as
zero in both); a logistic curve, fitted on texts that the models had not seen, turns the two
into a score between 0 and 1. Nothing but the text enters a score.

The models are fitted on a bounded sample of labelled rows (``max_docs``, the rows with
the smallest hashed identifiers, so the sample is the same on every run); their size is
bounded with it, and they travel with the task. Scoring reads every whole text where it
lies, without a shuffle. Edge cases: null and empty texts have no evidence, like a text
of ordinary words only; null labels and labels without a document train nothing; of an identifier's
labels the largest counts; rows that repeat identifier and text train once, and a bound of
``max_docs`` rows holds however often identifiers repeat; with no labelled rows of
one class every score is the share of toxic rows seen (0 if none were); an empty table has
no scores; further columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.llm._arrow import map_texts, text_column
from callsift.shipping import ship

#: Bound on the labelled documents that are fitted.
MAX_DOCS = 6000
#: Scores from here on reject a document.
THRESHOLD = 0.7
#: Kneser-Ney discount of the continuation counts.
DISCOUNT = 0.75
#: Texts discounted from a word's and from a pair's count in a class.
WORD_DISCOUNT, PAIR_DISCOUNT = 3.0, 6.0
#: Times the expected count that is discounted as well.
THETA = 3.0
#: Texts below which a word falls back to its first letters.
LEAST_COUNT = 3
#: Parts of the training texts; each is judged by models of the others to fit the curve.
FOLDS = 5
#: Letters of the class that a rare word falls back to.
PREFIX = 5

WORDS = re.compile(r"\w+")
UNKNOWN, START = 0, 1


@dataclass
class Model:
    """Both classes' tables, ordinary first; ``pairs`` are sorted keys ``before * size + word``."""

    vocabulary: dict[str, int]
    shared: np.ndarray
    word: np.ndarray
    word_rest: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray
    pair_rest: np.ndarray
    curve: np.ndarray

    def ids(self, text: str) -> list[int]:
        get = self.vocabulary.get
        return [get(w) or get("\n" + w[:PREFIX], UNKNOWN) for w in WORDS.findall(text.lower())]

    def log_probabilities(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """``(2, n)``: log p(word | before) in either class."""
        own = np.zeros((2, len(word)))
        if len(self.pairs):
            key = before * len(self.shared) + word
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            own = np.where(self.pairs[at] == key, self.pair[:, at], 0.0)
        back = self.word[:, word] + self.word_rest[:, None] * self.shared[word]
        return np.log(own + self.pair_rest[:, before] * back)

    def features(self, texts: list[str]) -> np.ndarray:
        coded = [self.ids(t) for t in texts]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        w = np.fromiter((i for ids in coded for i in ids), np.int64, int(lengths.sum()))
        if not len(w):
            return np.zeros((len(texts), 2))
        before = np.concatenate(([START], w[:-1]))
        first = np.cumsum(lengths) - lengths
        before[first[lengths > 0]] = START
        ordinary, toxic = self.log_probabilities(before, w)
        ratio = toxic - ordinary - np.log(self.word_rest[1] / self.word_rest[0])
        total = np.add.reduceat(np.concatenate((ratio, [0.0])), np.minimum(first, len(ratio))) * (lengths > 0)
        n = np.maximum(lengths, 1)
        return np.column_stack((100 * total / n, total / np.sqrt(n)))

    def score(self, texts: list[str]) -> np.ndarray:
        z = self.features(texts) @ self.curve[1:] + self.curve[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def vocabulary_of(texts: list[str]) -> dict[str, int]:
    """Ids of words in at least ``LEAST_COUNT`` texts, and of the others' common beginnings."""
    totals: Counter[str] = Counter()
    for t in texts:
        totals.update(set(WORDS.findall(t.lower())))
    kept = {w for w, n in totals.items() if n >= LEAST_COUNT}
    prefixes: Counter[str] = Counter()
    for w, n in totals.items():
        if w not in kept:
            prefixes[w[:PREFIX]] += n
    names = sorted(kept) + ["\n" + p for p in sorted(p for p, n in prefixes.items() if n >= LEAST_COUNT)]
    return {w: i + 2 for i, w in enumerate(names)}


def count_models(texts: list[str], toxic: np.ndarray) -> Model:
    """The tables of both classes, without the curve."""
    vocabulary = vocabulary_of(texts)
    size = len(vocabulary) + 2
    model = Model(vocabulary, np.full(size, 1 / size), np.zeros((2, size)), np.ones(2), np.zeros(0, np.int64), np.zeros((2, 0)), np.ones((2, size)), np.zeros(3))
    keys: list[list[np.ndarray]] = [[], []]
    for text, t in zip(texts, toxic):
        ids = np.array([START, *model.ids(text)], np.int64)
        keys[int(t)].append(np.unique(ids[:-1] * size + ids[1:]))
    flat = [np.concatenate(k) if k else np.zeros(0, np.int64) for k in keys]
    every = np.unique(np.concatenate(flat))
    if not len(every):
        return model
    before, word = every // size, every % size
    kinds = np.bincount(word, minlength=size)
    model.shared = (np.maximum(kinds - DISCOUNT, 0) + DISCOUNT * (kinds > 0).sum() / size) / kinds.sum()
    counts = np.zeros((2, len(every)))
    for c in range(2):
        own, n = np.unique(flat[c], return_counts=True)
        counts[c, np.searchsorted(every, own)] = n
    words = np.array([np.bincount(word, n, size) for n in counts])
    context = np.array([np.bincount(before, n, size)[before] for n in counts])
    pair = np.zeros((2, len(every)))
    for c in range(2):
        total, other = words[c].sum(), 1 - c
        if not total:
            continue
        expected = total * (words[other] + WORD_DISCOUNT) / (words[other].sum() + WORD_DISCOUNT)
        model.word[c] = np.maximum(words[c] - WORD_DISCOUNT - THETA * expected, 0) / total
        expected = context[c] * (counts[other] + PAIR_DISCOUNT) / (context[other] + PAIR_DISCOUNT)
        pair[c] = np.maximum(counts[c] - PAIR_DISCOUNT - THETA * expected, 0) / np.maximum(context[c], 1)
        model.word_rest[c] -= model.word[c].sum()
        model.pair_rest[c] -= np.bincount(before, pair[c], size)
    some = pair.any(0)
    model.pairs, model.pair = every[some], pair[:, some]
    return model


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton's method."""
    x = np.column_stack((np.ones(len(x)), x))
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (y - p) - ridge * b
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(h, g)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    return b


def fit(texts: list[str], toxic: list[int]) -> Model:
    """Both models and the curve; copies of a text train once."""
    distinct = sorted(set(zip(texts, toxic)))
    texts, toxic = [t for t, _ in distinct], [y for _, y in distinct]
    y = np.array(toxic, np.int64)
    if len(set(toxic)) < 2:
        model = count_models(texts, y)
        share = float(y.mean()) if len(y) else 0.0
        model.curve = np.array([np.log(share + 1e-9) - np.log(1 - share + 1e-9), 0.0, 0.0])
        return model
    # Folds within each class, so that every fold knows both classes.
    fold = np.zeros(len(y), np.int64)
    for c in (0, 1):
        fold[y == c] = np.arange((y == c).sum()) % FOLDS
    x = np.zeros((len(y), 2))
    if min((y == 1).sum(), (y == 0).sum()) >= 2:
        for f in range(FOLDS):
            part = count_models([t for t, g in zip(texts, fold) if g != f], y[fold != f])
            x[fold == f] = part.features([t for t, g in zip(texts, fold) if g == f])
    model = count_models(texts, y)
    model.curve = fit_curve(x, y)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, max_docs: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """At most ``max_docs`` labelled texts, by hashed identifier; ``labels`` holds training rows only."""
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    chosen = known.where("id is not null").orderBy(F.xxhash64("id"), "id").limit(max_docs)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(F.broadcast(chosen), "id")
    # More than max_docs rows only where identifiers repeat.
    return found.orderBy("id", F.xxhash64("text")).limit(max_docs)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> Model:
    rows = training_rows(docs, labels, max_docs, id_col, text_col, label_col)
    local = sorted((r.id, r.text, r.y) for r in rows.collect())
    return fit([t for _, t, _ in local], [y for _, _, y in local])


def score_toxicity(
    docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, score, predicted`` for every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = held.value

        def run(texts: list[str]) -> dict[str, list]:
            scores = m.score(texts)
            return {"score": scores, "predicted": (scores >= threshold).astype(np.int32)}

        return run

    fields = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return map_texts(docs, make, fields, id_col, text_col)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    score = text_column(lambda: lambda texts: held.value.score(texts).tolist(), T.DoubleType())
    return docs.where(score(F.col(text_col).cast("string")) < threshold)
