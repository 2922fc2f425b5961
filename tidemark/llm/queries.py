"""The numbered queries over the corpus tables, and SQL that checks them where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe_stream,
    importance,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    pivot_search,
    quality_classifier,
    sharding,
    spelling,
    token_counts,
    vector_dedup,
)
from tidemark.llm import quality_rules as rules

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512
BIN_BYTES = 16_384
SHARD_BYTES = 1 << 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def quality_model(spark: SparkSession, sf_dir: str) -> quality_classifier.Model:
    """Fitted on the rows outside the held-out fold."""
    labels = _table(spark, sf_dir, "labels").where(_fold() != 1)
    return quality_classifier.fit(_table(spark, sf_dir, "documents"), labels)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality_model(spark, sf_dir)
    scored = quality_classifier.score(_table(spark, sf_dir, "documents"), model)
    held_out = F.coalesce(_fold() == 1, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(_table(spark, sf_dir, "documents"), BIN_BYTES)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_classes(_table(spark, sf_dir, "documents"))


def op5_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "`line counts`.n_lines",
        "`line counts`.n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), VOCABULARY, TOKEN_LIMIT)


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.round_trip(_table(spark, sf_dir, "documents"), VOCABULARY)


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op10_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_table(spark, sf_dir, "documents"), SHARD_BYTES)


def op11_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, target = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return importance.resample(documents, target)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = spelling.spelling_variants(_table(spark, sf_dir, "documents"), damage=199)
    return variants.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = [
    op1_license_scan,
    op2_quality_classifier,
    op3_best_fit_packing,
    op4_ngram_join,
    op5_compression_bands,
    op6_line_dedup,
    op7_token_counts,
    op8_bpe_round_trip,
    op9_nn_descent,
    op10_extendible_shards,
    op11_pivot_search,
    op12_importance_resampling,
    op13_spelling_variants,
]

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# The 256 steps of CRC-32 from its polynomial, and the checksum of a text's UTF-8 bytes.
_CRC_TABLE = """
        step AS (
          SELECT list(list_reduce([v, 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
                 ORDER BY v) AS steps
          FROM (SELECT unnest(range(0, 256)) AS v)
        )"""


def _crc32(text: str) -> str:
    """The checksum as a number; `steps` must be a column."""
    digits = f"hex(encode({text}))"
    byte = f"CAST('0x' || substr({digits}, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)"
    return f"""xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(range(0, length({digits}) // 2), lambda i: {byte})),
            lambda c, b: xor(c // 256, steps[xor(c, b) % 256 + 1])))"""


ORACLE_SQL: dict[str, str] = {
    "op11_pivot_search": """
        WITH whole AS (
          SELECT row_number() OVER () AS place, vec_id,
                 list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
          FROM embeddings
          WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), ranked AS (
          SELECT q.vec_id AS query_id, q.place, c.vec_id,
                 CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
          FROM whole q JOIN whole c ON q.place <> c.place WHERE q.vec_id % 20 = 0
        ), numbered AS (
          SELECT *, row_number() OVER (
            PARTITION BY place ORDER BY score DESC, vec_id NULLS LAST) AS "rank" FROM ranked
        )
        SELECT query_id, CAST("rank" AS INTEGER) AS "rank", vec_id, score
        FROM numbered WHERE "rank" <= 20""",
    "op12_importance_resampling": f"""
        WITH {_CRC_TABLE}, word AS (
          SELECT doc_id, unnest(regexp_extract_all(translate(text, {_A_TO_Z}),
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM documents
        ), wanted AS (
          SELECT unnest(regexp_extract_all(translate(text, {_A_TO_Z}),
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark
        ), hashed AS (
          SELECT word, {_crc32("word")} % 10000 AS bucket
          FROM (SELECT word FROM word UNION SELECT word FROM wanted), step
        ), corpus AS (
          SELECT bucket, count(*) AS s FROM word JOIN hashed USING (word) GROUP BY bucket
        ), target AS (
          SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket
        ), gain AS (
          SELECT bucket, CAST(floor(1000 * ln(
                   (coalesce(t, 0) + 1) * (CAST((SELECT sum(s) FROM corpus) AS DOUBLE) + 10000)
                   / ((coalesce(s, 0) + 1) * (CAST((SELECT sum(t) FROM target) AS DOUBLE) + 10000))
                 )) AS BIGINT) AS gain
          FROM corpus FULL JOIN target USING (bucket)
        ), weighed AS (
          SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS w
          FROM word JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id
        ), scored AS (
          SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(w, 0) AS weight,
                 coalesce(w, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' ||
                   substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5)
                   / 4294967296.0))) AS BIGINT) AS score
          FROM documents d LEFT JOIN weighed USING (doc_id)
        ), numbered AS (
          SELECT *, n_features >= 20 AS fits, row_number() OVER (
            PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scored
        )
        SELECT doc_id, n_features, weight, score,
               CASE WHEN fits AND place <= (SELECT 10 * count(*) // 100 FROM numbered WHERE fits)
                    THEN place END AS "rank"
        FROM numbered""",
    "op13_spelling_variants": f"""
        WITH RECURSIVE {_CRC_TABLE}, run AS (
          SELECT doc_id, unnest(regexp_extract_all(
                   translate(text, {_A_TO_Z}), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
          FROM documents
        ), hashed AS (
          SELECT run, k, {_crc32("doc_id || ':' || run")} AS h
          FROM (SELECT doc_id, run, count(*) AS k FROM run WHERE length(run) >= 6
                GROUP BY ALL), step
        ), vocabulary AS (
          SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
                        || substr(run, CAST(h % length(run) + 2 AS INTEGER))
                      ELSE run END AS word, CAST(sum(k) AS BIGINT) AS n
          FROM hashed GROUP BY 1 HAVING sum(k) >= 5 AND length(word) >= 6
        ), cut AS (
          SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
          FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS INTEGER) AS place
                FROM vocabulary)
        ), pair AS (
          SELECT a.word, a.n, b.word AS other, b.n AS m
          FROM cut a JOIN cut b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
          UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN vocabulary b ON a.rest = b.word
          UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN vocabulary b ON a.rest = b.word
        ), near AS (
          SELECT word, count(*) AS n_near,
                 first(other ORDER BY m DESC, encode(other)) FILTER (m >= 5 * n) AS form,
                 max(m) FILTER (m >= 5 * n) AS form_n
          FROM pair GROUP BY word
        ), reached AS (
          SELECT word, word AS root FROM vocabulary
          UNION ALL SELECT reached.word, form FROM reached JOIN near ON near.word = root
          WHERE form IS NOT NULL
        )
        SELECT v.word, form, r.root, n, coalesce(n_near, 0) AS n_near, form_n
        FROM vocabulary v LEFT JOIN near USING (word)
        JOIN (SELECT word, root FROM reached
              LEFT JOIN (SELECT word AS root, form FROM near WHERE form IS NOT NULL) USING (root)
              WHERE form IS NULL) r ON r.word = v.word""",
    "op6_line_dedup": f"""
        WITH line AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
          FROM documents
        ), keyed AS (
          SELECT *, translate(trim(line, {_BLANKS}), {_A_TO_Z}) AS key FROM line
        ), holder AS (
          SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
          GROUP BY key HAVING count(DISTINCT doc_id) > 1
        ), judged AS (
          SELECT doc_id, line, place, coalesce(doc_id <> first_doc, false) AS dropped
          FROM keyed LEFT JOIN holder USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                               FILTER (NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op10_extendible_shards": f"""
        WITH keyed AS (
          SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes,
                 CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)
                   AS h
          FROM documents
        ), bucket AS (
          SELECT depth, h >> (60 - depth) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes
          FROM keyed, (SELECT unnest(range(0, 41)) AS depth) GROUP BY ALL
        ), leaf AS (
          SELECT * FROM bucket b WHERE shard_bytes <= {SHARD_BYTES} AND (depth = 0 OR EXISTS (
            SELECT 1 FROM bucket p WHERE p.depth = b.depth - 1 AND p.prefix = b.prefix >> 1
              AND p.shard_bytes > {SHARD_BYTES}))
        )
        SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes,
               's' || CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(prefix), 64, '0'), depth) END
                 AS shard,
               shard_bytes, true AS fits
        FROM keyed JOIN leaf ON keyed.h >> (60 - depth) = prefix""",
}
