"""Applying verdicts about rows to whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_rows(docs: DataFrame, verdicts: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``verdicts`` (id, ``text_hash``, ``kept``) keeps.

    Rows are found again by id and a hash of the text, as an id may come with several
    texts. A null id is an id here. All columns are handed on as they are.
    """
    kept = verdicts.filter("kept").select(F.col(id_column).alias("name"), "text_hash")
    whole = docs.select(F.struct(*docs.columns).alias("document"))
    whole = whole.select("document", F.xxhash64(F.col("document")[text]).alias("hash"))
    same = (whole.hash == kept.text_hash) & whole["document"][id_column].eqNullSafe(kept.name)
    found = whole.join(kept, same, "left_semi")
    return found.select(*(F.col("document")[name].alias(name) for name in docs.columns))
