"""The text operators as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import (
    alignment,
    clustering,
    decontamination,
    exact_dedup,
    jaccard,
    language,
    licenses,
    lm,
    mixing,
    record_files,
    sharding,
    toxicity,
    warc,
)
from tapeline.llm.common import table

SHARDS = 24
MIX_SHARES = {"src0": 6, "src1": 4, "src2": 4, "src3": 3}
MIX_DEFAULT = 2
# Files of public tokenizers that the token queries use.
BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.leaks(docs, benchmark)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.byte_shards(table(spark, sf_dir, "documents"), SHARDS)
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.scored(docs, lm.train(docs)).drop("text")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents"))


def not_in_fold(parts: int, held: int) -> Column:
    """Whether a document may be learnt from, by the CRC-32 of its id as text."""
    return F.crc32(F.col("doc_id").cast("string")) % parts != held


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = not_in_fold(3, 1)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learn)
    return toxicity.scored(docs, model).select(
        "doc_id",
        F.coalesce(~learn, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "offending",
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.notices(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = not_in_fold(4, 2)
    filters = language.train(docs, learn)
    return language.detected(docs.select("doc_id", "text"), filters).select(
        "doc_id", F.coalesce(~learn, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mix = mixing.mixed(docs, MIX_SHARES, MIX_DEFAULT)
    return mix.select("doc_id", "source", "source_block", "position")


def tokenizer_file(name: str) -> str:
    """Where the file of a public tokenizer lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op11_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.alignments(docs, tokenizer_file(BPE), tokenizer_file(PIECES))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(table(spark, sf_dir, "embeddings"), vector_col="embedding")


def op13_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_files.token_records(table(spark, sf_dir, "documents"), tokenizer_file(BPE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spaced_seeds": op1_spaced_seeds,
    "op2_warc": op2_warc,
    "op3_byte_shards": op3_byte_shards,
    "op4_pseudo_likelihood": op4_pseudo_likelihood,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_toxicity": op6_toxicity,
    "op7_licenses": op7_licenses,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_language": op9_language,
    "op10_mix": op10_mix,
    "op11_align_tokenizers": op11_align_tokenizers,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_token_records": op13_token_records,
}

ORACLE: dict[str, str] = {
    "op2_warc": """
        SELECT page_id, strlen(t) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((('0x' || substr(sha1(t), (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4)))
                    % 32)::INT + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> f THEN f END AS refers_to
        FROM (SELECT page_id, t, min(page_id) OVER (PARTITION BY t) AS f
              FROM (SELECT page_id, coalesce(html, '') AS t FROM pages))
    """,
    # CRC-32 byte by byte, with the table of 256 remainders made from the polynomial
    "op3_byte_shards": """
        WITH polynomial AS (
            SELECT list_transform(range(256), lambda b: list_reduce(
                range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384)
                                            ELSE c >> 1 END, b)) AS t),
        texts AS (
            SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h
            FROM documents),
        sized AS (
            SELECT doc_id, n + 8 AS size, xor(list_reduce(
                list_transform(regexp_extract_all(h, '..'), lambda b: ('0x' || b)::BIGINT),
                lambda c, b: xor(c >> 8, t[(xor(c, b) % 256 + 1)::INT]), 4294967295::BIGINT),
                4294967295) AS text_crc32
            FROM texts, polynomial),
        placed AS (
            SELECT *, sum(size) OVER (ORDER BY doc_id, size, text_crc32
                                      ROWS UNBOUNDED PRECEDING) AS stop,
                   sum(size) OVER () AS total
            FROM sized)
        SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY stop) - 1 AS slot,
               NULL::INT AS grown_shard
        FROM (SELECT *, (24 * (2 * stop - size) // (2 * total))::INT AS shard FROM placed)
    """,
    "op5_ngram_jaccard": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(
                CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
                     ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS g
            FROM d),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        e AS MATERIALIZED (
            SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * c >= 75 * (x.n + y.n - c)),
        r(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
        SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
        FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
    """,
    "op8_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
              FROM documents)
        WINDOW same AS (PARTITION BY t)
    """,
}
