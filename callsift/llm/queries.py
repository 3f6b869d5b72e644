"""The thin ``opN_<name>`` queries over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callsift.llm.topk import top_k

    vectors = _table(spark, sf_dir, "embeddings")
    found = top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callsift.llm.suffix_dedup import substring_report

    return substring_report(_table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callsift.llm.sharding import LAW, interleave

    docs = _table(spark, sf_dir, "documents")
    return interleave(docs, n_shards=24).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callsift.llm.lm_score import fit, score

    docs = _table(spark, sf_dir, "documents")
    return score(docs, *fit(docs))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callsift.llm.exact_dedup import exact_dedup

    docs = _table(spark, sf_dir, "documents")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _spans_text(found):
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callsift.llm.secrets import find_secrets

    found = find_secrets(_table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("found", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(_spans_text(base), 256).alias("base_sha256"),
        _spans_text(F.col("found")).alias("spans"),
    )


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; the files are never copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from callsift.llm.byte_bpe import encode

    docs = _table(spark, sf_dir, "documents")
    coded = encode(docs, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_decoded=True)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callsift.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def held_out(id_col):
    """Rows whose labels must not be learnt from."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callsift.llm.toxicity import fit_toxicity, score_toxicity

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callsift.llm.simhash import simhash_components

    found = simhash_components(_table(spark, sf_dir, "documents"), shingle=4, radius=4)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


QUERIES = {
    "op1_topk": op1_topk,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_sharding": op3_sharding,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_lm_score": op7_lm_score,
    "op8_exact_dedup": op8_exact_dedup,
    "op10_simhash": op10_simhash,
    "op9_secret_scan": op9_secret_scan,
}

ORACLE_SQL = {
    "op2_suffix_dedup": """
        WITH t AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), w AS (
            -- windows of 50 bytes, by way of blocks of 500
            SELECT doc_id, 500 * q + i AS p, substr(part, 2 * i + 1, 100) AS s
            FROM (SELECT doc_id, q, part, unnest(range(len(part) // 2 - 49)) AS i
                  FROM (SELECT doc_id, q, substr(h, 1000 * q + 1, 1098) AS part FROM (SELECT doc_id, h, unnest(range((greatest(len(h) // 2 - 49, 0) + 499) // 500)) AS q FROM t)))
        ), m AS (
            SELECT s, min(doc_id) AS least FROM w GROUP BY s
        ), g AS (
            SELECT DISTINCT doc_id, p FROM w JOIN m USING (s) WHERE least < doc_id
        ), b AS (
            SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS opens FROM g
        ), r AS (
            SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS k FROM b
        ), x AS (
            SELECT doc_id, k, min(p) AS a, max(p) + 50 AS e FROM r GROUP BY doc_id, k
        ), y AS (
            SELECT doc_id, a, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM x
        ), z AS (
            SELECT doc_id, sum(e - a) AS gone, count(*) AS spans, max(e) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
            FROM y JOIN t USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
               sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM t LEFT JOIN z USING (doc_id)
    """,
    "op3_sharding": """
        WITH k AS (
            -- the sixteen steps of a CRC-32 by half bytes, from its polynomial
            SELECT list_transform(range(16), lambda n: list_reduce([n, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
        ), t AS (
            SELECT doc_id, source, coalesce(text, '') AS text, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d, md5('17:' || coalesce(source, '')) AS p FROM documents
        ), h AS (
            SELECT doc_id, source, octet_length(encode(text)) + 8 AS size, string_split(lower(hex(encode(text))), '') AS c,
                   CAST('0x' || substr(d, 1, 15) AS BIGINT) AS draw, (CAST('0x' || substr(p, 1, 5) AS BIGINT) + 0.5::DOUBLE) / 1048576 AS phase FROM t
        ), x AS (
            SELECT h.*, xor(4294967295, list_reduce(
                list_prepend(4294967295, CASE WHEN size = 8 THEN [] ELSE list_transform(range(CAST(2 * (size - 8) AS BIGINT)), lambda i: CAST(instr('0123456789abcdef', c[1 + xor(i, 1)]) - 1 AS BIGINT)) END),
                lambda v, b: xor(steps[1 + (xor(v, b) & 15)], v >> 4))) AS crc
            FROM h, k
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY draw, doc_id) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM x
        ), l AS (
            SELECT *, row_number() OVER (ORDER BY (r + phase) / n, draw, doc_id) - 1 AS place, count(*) OVER () AS total FROM r
        ), s AS (SELECT *, place * 24 // total AS shard FROM l)
        SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
               CAST(place - (shard * total + 23) // 24 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard, source
        FROM s
    """,
    "op1_topk": """
        WITH t AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM t q JOIN t c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op8_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY text) AS keep_id,
               count(*) OVER (PARTITION BY text) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text) AS kept,
               sha256(text) AS text_sha256
        FROM t
    """,
}
