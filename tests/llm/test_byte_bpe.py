"""Byte-level BPE against the tiktoken library."""

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from callsift.llm import byte_bpe

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = byte_bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_long_pieces_are_folded(spark):
    """Pieces beyond LONG_PIECE, where a step merges all places of a pair, against one at a time."""
    import random

    rng = random.Random(5)
    pieces = [b"a" * 65, b"=" * 400, b"ab" * 90, b"aab" * 80, b" " * 200, "日本語のテキスト".encode() * 12, b"the" * 60 + b"a" * 31, bytes(range(256))]
    pieces += ["".join(rng.choices(c, k=rng.randint(65, 180))).encode() for c in ("ab", "aA1", "the ", "etaoinshrdlu", "=-", "éü日ab") for _ in range(12)]
    pieces += [rng.randbytes(120) for _ in range(10)]
    maps = [byte_bpe.literal(spark, x) for x in byte_bpe.rank_table(RANKS)]
    rows = spark.createDataFrame([(i, [RANKS[bytes([b])] for b in p]) for i, p in enumerate(pieces)], "i int, ids array<bigint>")
    for r in rows.select("i", byte_bpe.folded(rows["ids"], *maps, long=True).alias("out")).collect():
        assert r.out == LIBRARY._encode_single_piece(pieces[r.i]), pieces[r.i]


@pytest.mark.parametrize("sample", [3, 20_000])
def test_encode_and_decode(spark, sf, sample):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(80).collect()]
    odd = [None, "", "   \n\n x", "don't DON'T 's", "日本語 тест ١٢٣ 👍🏽", "a" * 5000, " \x85 \x1c x", "<|endoftext|>", "x" * 70 + " y"]
    rows += [(10_000 + i, t) for i, t in enumerate(odd)] + [rows[0], (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = byte_bpe.encode(docs, PATH, P.PATTERN, sample_docs=sample, with_decoded=True).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        t = texts[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == LIBRARY.encode_ordinary(t)
        assert bytes(r.decoded) == t.encode()


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, ids int")
    assert byte_bpe.encode(docs, PATH, P.PATTERN).count() == 0


def test_short_pieces_keep_their_ranks(spark):
    """Short pieces, from the ids of their bytes and from first entries with ranks, against the library."""
    import random

    rng = random.Random(7)
    pieces = [b"a", b"ab", b"aaa", b"aaaa", b"a" * 63, b"a" * 64, b"ab" * 32, b"\xff\x00" * 9, " ththedeash".encode(), " наречие".encode()]
    pieces += ["".join(rng.choices(c, k=rng.randint(1, 16))).encode()[:64] for c in ("ab", "aA1", "the ", "etaoinshrdlu", "=-", "éü日ab") for _ in range(40)]
    pieces += [rng.randbytes(rng.randint(1, 64)) for _ in range(60)]
    maps = [byte_bpe.literal(spark, x) for x in byte_bpe.rank_table(RANKS)]
    sizes = np.array([len(p) for p in pieces])
    entries = byte_bpe.first_entries(b"".join(pieces), sizes, byte_bpe.byte_pairs(RANKS))
    cuts = np.concatenate(([0], np.cumsum(sizes + 1)))
    rows = [(i, [RANKS[bytes([b])] for b in p], entries[a:e].tolist()) for i, (p, a, e) in enumerate(zip(pieces, cuts, cuts[1:]))]
    frame = spark.createDataFrame(rows, "i int, ids array<bigint>, entries array<bigint>")
    plain, begun = byte_bpe.folded(frame["ids"], *maps), byte_bpe.folded(frame["entries"], *maps, begun=True)
    for r in frame.select("i", plain.alias("a"), begun.alias("b")).collect():
        assert r.a == r.b == LIBRARY._encode_single_piece(pieces[r.i]), pieces[r.i]
