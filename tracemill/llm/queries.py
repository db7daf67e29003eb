"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.llm import (
    bpe,
    conversation_repair,
    fingerprints,
    hard_negatives,
    line_dedup,
    near_dedup,
    packing,
    quality_rules,
    rule_ensemble,
    secrets,
    slots,
    token_counts,
    url_rules,
)

Query = Callable[[SparkSession, str], DataFrame]

# The rules that op1 applies.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
SHARDS = 8


def tokenizer(name: str) -> str:
    """The file of a public tokenizer, by the package that holds them."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_url_rules(spark, sf_dir):
    rules = url_rules.rule_table(spark, URL_RULES)
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


@query
def op2_rule_ensemble(spark, sf_dir):
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return rule_ensemble.score_quality(docs, labels)


@query
def op3_virtual_slots(spark, sf_dir):
    sharded = slots.shard_records(table(spark, sf_dir, "documents"), SHARDS)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "part",
    )


@query
def op5_quality_rules(spark, sf_dir):
    judged = quality_rules.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op9_secrets(spark, sf_dir):
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


@query
def op10_forced_boundaries(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return bpe.encode_texts(documents, tokenizer("word_bpe_49k.json"))


@query
def op6_configuration_packing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return packing.pack_documents(documents, tokenizer("byte_bpe_50k.json"))


@query
def op4_bottom_k_near_dedup(spark, sf_dir):
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op8_line_dedup(spark, sf_dir):
    """Every document without the lines that repeat earlier ones."""
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


@query
def op7_bottom_k_fingerprints(spark, sf_dir):
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op11_edit_lattice(spark, sf_dir):
    return conversation_repair.repair_report(table(spark, sf_dir, "conversations"))


@query
def op12_shared_lists(spark, sf_dir):
    return hard_negatives.negatives_of_embeddings(table(spark, sf_dir, "embeddings"))


@query
def op13_whole_tokens(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
