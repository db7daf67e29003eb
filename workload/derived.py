"""Problem, trace, completion and prediction tables derived from ``documents``.

The driver's tables hold no boxed answers, so the inputs are made from whole
documents, row by row: one problem and one trace per document, and one completion
per labelled document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_MODEL = "writer-1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _answer() -> Column:
    doc, size = F.col("doc_id"), F.col("n_chars")
    bits = F.lpad(F.bin(size % 256), 8, "0")
    whole, cents = F.expr("cast(n_chars div 100 as string)"), (size % 100).cast("string")
    decimal = F.concat(whole, F.lit("."), F.lpad(cents, 2, "0"))
    words = F.concat(F.col("lang"), F.lit(" "), F.col("source"), F.lit(" book"))
    distance = F.concat(size.cast("string"), F.lit(" km"))
    kind = doc % 4
    return F.when(kind == 0, bits).when(kind == 1, decimal).when(kind == 2, words).otherwise(distance)


def _reasoning() -> Column:
    body, answer = F.col("text"), F.col("answer")
    box = F.concat(F.lit(r"\boxed{"), answer, F.lit("}"))
    escaped = F.replace(answer, F.lit(" "), F.lit("\\ "))
    shapes = [
        F.concat(body, F.lit("\n\nTherefore, the answer is "), box, F.lit(".")),
        F.concat(body, F.lit(r" so \boxed{"), escaped, F.lit("}")),
        F.concat(F.lit(r"First \boxed{wrong} then "), body, F.lit(" "), box),
        F.concat(body, F.lit(r"\boxed{wrong}")),
        body,
        F.concat(body, F.lit(r" \boxed{"), answer),
        F.concat(body, F.lit(r"。 . \boxed{ "), answer, F.lit("  } done")),
        F.concat(body, F.lit(r"\boxed{\frac{1}{2}}")),
        F.lit(""),
        box,
    ]
    shape = F.lit(None)
    for number, text in reversed(list(enumerate(shapes))):
        shape = F.when(F.col("doc_id") % 10 == number, text).otherwise(shape)
    return shape


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id",
        "text",
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
        _answer().alias("answer"),
    )


def problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("id", F.col("text").alias("prompt"), "answer")


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select(
        "id", F.col("text").alias("prompt"), "answer", _reasoning().alias("reasoning")
    )


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct()
    written = _documents(spark, sf_dir).join(labelled, "doc_id", "left_semi")
    return written.select(
        "id", _reasoning().alias("completion"), F.lit(SOURCE_MODEL).alias("source_model")
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.col("answer")
    box = F.concat(F.lit(r"\boxed{"), answer, F.lit("}"))
    kind = F.col("doc_id") % 5
    prediction = (
        F.when(
            kind == 0,
            F.concat(F.lit("  "), F.replace(answer, F.lit(" "), F.lit("   ")), F.lit(" ")),
        )
        .when(kind == 1, F.concat(F.col("text"), F.lit(" so "), box))
        .when(kind == 2, F.concat(F.lit(r"\boxed{0} no, \boxed{"), answer, F.lit("04}")))
        .when(kind == 3, F.concat(box, F.col("text"), F.lit(r" \boxed{wrong}")))
    )
    return _documents(spark, sf_dir).select("id", "answer", prediction.alias("prediction"))
