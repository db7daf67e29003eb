"""A training corpus from raw documents, stage by stage.

Every stage takes what the one before it kept, and all but the last hand on the columns of
the documents. A stage's result is stored before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.llm import line_dedup, near_dedup, packing, quality_rules, secrets
from tracemill.llm.queries import tokenizer
from tracemill.llm.verdicts import keep_rows
from tracemill.sources.staging import release_paths, stage, stored_tables

# Documents are near duplicates from this share of common shingles of five words on.
NEAR_PERCENT = 80


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now, where documents carry it."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    size = F.coalesce(F.length("text"), F.col("n_chars")).cast(kind)
    return docs.withColumn("n_chars", size)


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the others go.

    Null and empty texts go too. Copies, ties and rows without id are judged one by one.
    """
    return quality_rules.passing_documents(docs)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones; those left empty go.

    Null and empty texts lose nothing and stay. Equal rows are one document here: none of them
    is the other's copy. Earlier means a smaller id; rows without id come last.
    """
    return _sized(line_dedup.dedup_lines(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id.

    Texts without a word have no duplicates and stay. Equal rows stay together; of several
    rows without id in a group that has an id none stays.
    """
    return keep_rows(docs, near_dedup.near_duplicates(docs, percent=NEAR_PERCENT))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret.

    Null and empty texts stay as they are, copies are masked alike.
    """
    return _sized(secrets.redact_secrets(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences.

    A null or empty text is one piece of its end mark; repeated rows are packed each.
    """
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", judge_quality),
    ("line_dedup", cut_lines),
    ("near_dedup", drop_copies),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack),
]
# SQL can express neither learned formats nor tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of ``sf_dir``.

    Once a stage's result is stored, what it has read and stored on the way is deleted.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    done: list[str] = []
    for name, step in first:
        with stored_tables() as paths:
            docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        *inner, result = paths
        release_paths(spark, done + inner)
        done = [result]
    return last(spark, docs, sf_dir)
