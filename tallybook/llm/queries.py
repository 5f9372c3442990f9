"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import align, bpe, decontam, jaccard, langid, lines, packing, quality, scratch, spelling, substring, tiers, vectors, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, of: int) -> F.Column:
    """The unsigned CRC-32 of an id written as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(of))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(fold("doc_id", 4) != 2))
    held = docs.select("doc_id", "text")
    out = langid.identify(held, model)
    return out.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(fold("doc_id", 5) != 0))
    out = quality.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup(_table(spark, sf_dir, "documents"), least=1)
    return out.select("doc_id", "n_lines", "n_removed", "kept_sha256")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), TOKENIZER)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.assign(_table(spark, sf_dir, "documents"), shards=16)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, path = _table(spark, sf_dir, "pages"), scratch.folder(spark)
    warc.write(pages, path)
    records = warc.read(spark, path).where("kind = 'record'")
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    return records.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align.align(_table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiers.pack(_table(spark, sf_dir, "documents"), BYTE_LEVEL)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_quality": op4_quality,
    "op5_line_dedup": op5_line_dedup,
    "op6_bpe": op6_bpe,
    "op7_sharding": op7_sharding,
    "op8_vector_dedup": op8_vector_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_warc": op10_warc,
    "op11_alignment": op11_alignment,
    "op12_packing": op12_packing,
    "op13_spelling": op13_spelling,
}

#: Windows of 35 words that start at more than one place, and the words they leave uncovered.
_WINDOWS = """
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), places AS (
    SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs
), starts AS (
    SELECT doc_id, i, words[i] AS word,
           CASE WHEN i + 34 <= len(words) THEN array_to_string(words[i:i + 34], ' ') END AS run
    FROM places
), repeated AS (
    SELECT run FROM starts WHERE run IS NOT NULL GROUP BY run HAVING count(*) > 1
), marked AS (
    SELECT doc_id, i, word, CAST(r.run IS NOT NULL AS INT) AS hit FROM starts s LEFT JOIN repeated r ON s.run = r.run
), covered AS (
    SELECT doc_id, i, word, max(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
    FROM marked
), sums AS (
    SELECT doc_id, count(*) AS n_words, CAST(sum(gone) AS BIGINT) AS n_removed,
           string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept
    FROM covered GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs d LEFT JOIN sums s ON s.doc_id = d.doc_id
"""

_RECORDS = """
WITH held AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS response_id FROM held
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> response_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> response_id THEN response_id END AS refers_to
FROM firsts
"""

#: SQL for the queries that it can express at the size of the correctness tables.
ORACLE: dict[str, str] = {"op1_substring_dedup": _WINDOWS, "op10_warc": _RECORDS}
