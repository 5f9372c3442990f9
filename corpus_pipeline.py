"""A corpus pipeline of five stages over the table ``documents``.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return
the columns of documents. Stages are independent of how the one before was computed: ``run`` writes each
result as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import bpe, decontam, jaccard, langid, lines, scratch
from tallybook.llm.queries import TOKENIZER, fold

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: The stages are models and text rewriting that SQL can't express; tests compare them with plain Python.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is known; null and letterless texts go. Labels train, the text decides."""
    model = langid.fit(docs.where(fold("doc_id", 4) != 2))
    row = F.struct(*[F.col(c) for c in COLUMNS]).alias("row")
    out = langid.identify(docs.select(row, "text"), model, id_col="row")
    return out.where(F.col("lang_pred") != langid.UNKNOWN).select(*[F.col(f"row.{c}").alias(c) for c in COLUMNS])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that are like an earlier one; documents that lose every line go."""
    row = F.struct("doc_id", "lang", "source").alias("row")
    cut = lines.dedup(docs.select("doc_id", "text", row), keep="row", least=1)
    kept = cut.where(F.col("kept_text").rlike(r"\S"))
    return kept.select(
        "doc_id", F.col("kept_text").alias("text"), "row.lang", "row.source", F.length("kept_text").cast("long").alias("n_chars")
    )


def near_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates the document with the smallest id.

    Rows that share that id all stay, so a row that repeats another wholly is not removed here.
    """
    keep = jaccard.link(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["_id"]), "left_semi").select(*COLUMNS)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    row = F.struct(*[F.col(c) for c in COLUMNS]).alias("row")
    out = decontam.find_leaks(docs.select(row, "text"), benchmark, id_col="row")
    return out.where("not leaked").select(*[F.col(f"row.{c}").alias(c) for c in COLUMNS])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded text."""
    return bpe.encode_decode(docs, TOKENIZER)


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_documents),
    ("decontamination", clean_of_benchmark),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.stored(stage(spark, docs, sf_dir))
    return docs
