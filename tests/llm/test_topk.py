"""Ball-tree search against plain inner products."""

import numpy as np
import pytest


def plain(rows, queries, k):
    usable = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    vs = [(i, np.floor(256 * np.array(v, np.float64))) for i, v in usable]
    out = set()
    for i, q in vs:
        if queries(i):
            best = sorted(((-(x @ q), j) for j, x in vs if j != i and len(x) == len(q)))[:k]
            out |= {(i, r + 1, j, int(-s)) for r, (s, j) in enumerate(best)}
    return out


@pytest.mark.parametrize("shard", [50, 100_000])
def test_top_k(spark, shard):
    from callsift.llm.topk import top_k

    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(150)]  # one hot vector
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (None, [1.0] * 6), (904, [1.0, 2.0]), (950, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]  # as single precision
    out = top_k(df, df.where("vec_id % 50 = 0"), k=5, block_queries=4, shard_rows=shard).collect()
    assert {tuple(r) for r in out} == plain(rows, lambda i: i % 50 == 0, 5) and len(out) == len({tuple(r) for r in out})


def test_repeated_rows_are_candidates_each(spark):
    """Rows as SQL joins them: those of the query's own identifier never, all others by themselves."""
    from callsift.llm.topk import top_k

    rows = [(0, [1.0, 0.5])] * 6 + [(i, [1.0, 0.5]) for i in range(1, 6)]
    rows += [(7, [2.0, 2.0]), (7, [2.0, 2.0]), (8, [2.0, 2.0])] + [(9, [0.5, 1.0])] * 9 + [(9, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2)
    for own in (0, 7, 9):
        q = next(v for i, v in rows if i == own)
        vs = [(i, np.floor(256 * np.array(v)) @ np.floor(256 * np.array(q))) for i, v in rows if i != own]
        want = [(i, int(s)) for i, s in sorted(vs, key=lambda x: (-x[1], x[0]))[:5]]
        queries = df.where(f"vec_id = {own}").dropDuplicates()
        if own == 9:
            queries = queries.where("embedding[0] < 1")
        got = sorted((r.rank, r.id, r.score) for r in top_k(df, queries, k=5).collect())
        assert [(i, s) for _, i, s in got] == want and [r for r, _, _ in got] == [1, 2, 3, 4, 5]


def test_top_k_of_nothing(spark):
    from callsift.llm.topk import top_k

    df = spark.createDataFrame([], "vec_id long, embedding array<float>, score int")
    assert top_k(df, df).columns == ["query_id", "rank", "id", "score"]
    assert top_k(df, df).count() == 0
