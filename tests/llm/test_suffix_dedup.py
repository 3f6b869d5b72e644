"""Substring removal against a dictionary of all windows."""

import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from callsift.llm import suffix_dedup as m


def plain(rows, length=50):
    least = {}
    for i, t in rows:
        if i is None:
            continue
        x = (t or "").encode()
        for p in range(len(x) - length + 1):
            w = x[p : p + length]
            least[w] = min(least.get(w, i), i)
    out = []
    for i, t in rows:
        x = (t or "").encode()
        gone = bytearray(len(x))
        for p in range(len(x) - length + 1 if i is not None else 0):
            if least[x[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(x, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(x), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_report(spark, sf):
    rng = random.Random(4)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(120).collect()]
    passage = "a passage that very many documents of this small table share, word for word, with ünïcode"
    rows += [(1000 + i, f"start {i} {passage} and end {i}") for i in range(40)]
    rows += [(2000, "ab" * 400), (1999, "ab" * 60), (2001, "x" * 500), (2002, "x" * 49), (2003, "x" * 50), (3000, None), (3001, ""), rows[0], (None, passage)]
    rows += [(4000 + i, rows[5][1][k:] + "tail") for i, k in enumerate((0, 1, 7))]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = m.substring_report(docs).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)
    assert sum(r.n_spans for r in out) > 40


def test_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, home int, id string")
    assert m.substring_report(docs).count() == 0


@given(st.lists(st.text("ab", min_size=50, max_size=90) | st.sampled_from(["ab" * 40, "a" * 60, "a" * 30 + "b" * 30, "\x00" * 55 + "a"]), min_size=1, max_size=12))
@settings(max_examples=150, deadline=None)
def test_deep_shallow_order(texts):
    raw = [t.encode() for t in texts]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    starts, at = [], 0
    for t in raw:
        starts += [at + i for i in range(len(t) - 49)]
        at += len(t)
    starts = np.array(starts)
    for shallow in (0, 8, 16, 48):  # from tries almost alone to quicksort almost alone
        order, first = m.deep_shallow(buf, starts, shallow=shallow)
        assert sorted(order.tolist()) == list(range(len(starts)))
        strings = [bytes(buf[starts[i] : starts[i] + 50]) for i in order]
        assert strings == sorted(strings)
        assert first.tolist() == [k == 0 or strings[k] != strings[k - 1] for k in range(len(strings))]


@given(st.lists(st.binary(max_size=300) | st.sampled_from([b"ab" * 200, b"x" * 400]), max_size=6))
@settings(max_examples=100, deadline=None)
def test_segments_cover_every_window_once(texts):
    doc, start, count, anchor = m.segments(texts)
    seen = {}
    for d, s, c, a in zip(doc.tolist(), start.tolist(), count.tolist(), anchor.tolist()):
        for p in range(s, s + c):
            assert (d, p) not in seen
            seen[d, p] = a
    assert set(seen) == {(d, p) for d, t in enumerate(texts) for p in range(len(t) - 49)}
    by = {}
    for (d, p), a in seen.items():
        assert by.setdefault(texts[d][p : p + 50], a) == a


def test_answers_cost_what_they_hold():
    """An owner answers every group of documents, so answers must not read all of its runs each time."""
    import time

    rng = random.Random(6)
    texts = [rng.randbytes(50 + k % 9) for k in range(60_000)]
    least = np.array([rng.randrange(1000) for _ in texts])
    runs = m._smaller_runs(texts, np.array([rng.randrange(1 << 32) for _ in texts], np.uint32), least, 50)
    groups = [np.array(rng.sample(range(len(texts)), 12)) for _ in range(5000)]
    began = time.process_time()
    answers = [m._expand(runs, own) for own in groups]
    assert time.process_time() - began < 3
    for own, (member, place, count, best) in zip(groups, answers):
        assert member.tolist() == list(range(12)) and not place.any()
        assert count.tolist() == [1 + i % 9 for i in own.tolist()] and (best == least[own]).all()
