"""The window network against finite differences, plain loops and other partitionings."""

from collections import Counter

import numpy as np
import pytest

from callsift.llm import lm_score as m


def test_gradient():
    rng = np.random.default_rng(0)
    net = m.Network((rng.normal(0, 0.3, m.Network().flat.shape)).astype(np.float64))
    context, klass = rng.integers(0, m.PAD + 1, (7, 2 * m.SIDE)), rng.integers(0, m.CLASSES, 7)
    context[1] = context[0]  # an input that several windows share
    g = net.gradient(context, klass).flat
    for i in rng.choice(np.flatnonzero(g), 60):
        old = net.flat[i]
        losses = []
        for d in (1e-5, -1e-5):
            net.flat[i] = old + d
            losses.append(-net.log_probabilities(context, klass).mean())
        net.flat[i] = old
        assert abs((losses[0] - losses[1]) / 2e-5 - g[i]) < 1e-6


@pytest.fixture(scope="module")
def fitted(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1, None), (-2, ""), (None, "the of the"), (None, "the of the"), (-3, "x")], "doc_id long, text string")
    docs = docs.union(more)
    return docs, *m.fit(docs)


def test_counts_and_probabilities(fitted):
    docs, vocabulary, net = fitted
    cells = m.Cells()
    counts = Counter(c for r in docs.collect() for c in cells.of(r.text or "").tolist())
    got = m.cell_counts(docs)
    assert {c: int(got[c]) for c in np.flatnonzero(got)} == counts and vocabulary.total == sum(counts.values())
    # p(class) and p(cell | class) are distributions, so p(cell) is one for any neighbours.
    context = np.array([[m.PAD, 0, 5, m.READ + 3]])
    p = np.exp([net.log_probabilities(context, np.array([k]))[0] for k in range(m.CLASSES)])
    assert abs(p.sum() - 1) < 1e-5
    whole = np.bincount(vocabulary.klass, np.exp(vocabulary.share.astype(np.float64)), m.CLASSES)
    singles = vocabulary.klass < m.SINGLES
    assert singles.sum() == m.SINGLES and np.allclose(whole, 1, atol=1e-3)


def test_scores_by_a_plain_loop(spark, fitted):
    docs, vocabulary, net = fitted
    out = m.score(docs, vocabulary, net).collect()
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert len(out) == len(texts)
    by = {r.doc_id: r for r in out}
    assert (by[-1].n_tokens, by[-1].log_likelihood, by[-1].mean_log_likelihood) == (0, 0.0, 0.0)
    cells = m.Cells()
    for i, t in texts[:10] + texts[-3:]:
        own = cells.of(t)
        line = [m.PAD] * 2 + [int(vocabulary.input[c]) for c in own] + [m.PAD] * 2
        want = 0.0
        for k, c in enumerate(own):
            context = np.array([[line[k], line[k + 1], line[k + 3], line[k + 4]]])
            want += net.log_probabilities(context, vocabulary.klass[[c]].astype(int))[0] + vocabulary.share[c]
        assert by[i].n_tokens == len(t.split()) and abs(by[i].log_likelihood - want) < 1e-2 + 1e-5 * abs(want)
    # Better than the shares of classes and cells without any neighbours.
    n = m.cell_counts(docs)
    n = n[n > 0]
    alone = (n * np.log(n / n.sum())).sum() / n.sum()
    mean = sum(r.log_likelihood for r in out) / sum(r.n_tokens for r in out)
    assert mean > alone
    assert m.score(spark.createDataFrame([], "doc_id long, text string, n_tokens int"), vocabulary, net).count() == 0


def test_every_token_trains_and_partitions_do_not_matter(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    total = sum(len((r.text or "").split()) for r in docs.collect())
    _, one = m.fit(docs.repartition(1), trainer_tokens=20_000)
    _, many = m.fit(docs.repartition(7).orderBy("text"), trainer_tokens=20_000)
    assert total > 40_000 and np.array_equal(one.flat, many.flat)
    vocabulary = m.Vocabulary(m.cell_counts(docs))
    cells = m.Cells()
    trainer = m.Trainer(m.Network(), vocabulary)
    trainer.train(m.joined([vocabulary.input[cells.of(r.text or "")] for r in docs.collect()]))
    assert trainer.seen == total


def test_fitting_nothing(spark):
    vocabulary, net = m.fit(spark.createDataFrame([], "doc_id long, text string"))
    assert vocabulary.total == 0 and np.array_equal(net.flat, m.Network().flat)
