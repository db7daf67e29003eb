"""Document fingerprints: bottom-k sketches of shingle hashes.

A fingerprint holds the ``k`` smallest hashes of a text's distinct word shingles, as
hexadecimal digits, smallest first. Fingerprints of parts can be merged into that of
the whole. Two of them estimate how alike the shingle sets are and how much of one lies
in the other; one alone estimates how many distinct shingles there are. Sets of fewer than
``k`` shingles are held whole, and all answers about them are exact.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tracemill.llm.batches import map_slices
from tracemill.llm.shingles import shingle_set, union_sketch

SKETCH = 128
DIGITS = 16
# Characters of an edited text that come from elsewhere: one in so many.
EDITED_PART = 3
LOWEST = -(2**63)


def sketch(text: str | None, size: int = SKETCH) -> np.ndarray:
    return shingle_set(text)[:size]


def write(values: np.ndarray) -> str:
    """Sixteen digits per value; big-endian, so that texts sort like values."""
    return values.astype(">u8").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def likeness(one: np.ndarray, other: np.ndarray, size: int = SKETCH) -> float:
    """Estimated resemblance of two sets; 1 for two empty ones."""
    shared, seen = union_sketch(one, other, size)
    return shared / seen if seen else 1.0


def distinct_shingles(values: np.ndarray, size: int = SKETCH) -> float:
    """Estimated size of the set, exact below ``size``."""
    if len(values) < size:
        return float(len(values))
    return (size - 1) / (float(values[-1]) / 2.0**64)


def containment(one: np.ndarray, other: np.ndarray, size: int = SKETCH) -> float:
    """Estimated part of the first set that the second also holds; 1 if it is empty."""
    if not len(one):
        return 1.0
    merged = merge(one, other, size)
    common = likeness(one, other, size) * distinct_shingles(merged, size)
    return min(1.0, common / distinct_shingles(one, size))


def merge(one: np.ndarray, other: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.union1d(one, other)[:size]


def fingerprint_documents(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", size: int = SKETCH
) -> DataFrame:
    """``fingerprint`` and ``distinct_shingles`` of every whole text.

    A null or empty text, and one of white space only, has an empty fingerprint.
    Equal texts have equal ones; each row is returned once, rows without id too.
    Columns other than the two named are not looked at.
    """

    def make():
        def step(names, texts):
            found = [sketch(whole, size) for whole in texts]
            return [names, [write(f) for f in found], [distinct_shingles(f, size) for f in found]]

        return step

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, fingerprint string, distinct_shingles double"
    return map_slices(docs.select(id_column, text), make, schema)


def merge_fingerprints(
    fingerprints: DataFrame, groups: list[str], column: str = "fingerprint", size: int = SKETCH
) -> DataFrame:
    """One fingerprint per group, that of all its texts together.

    Values are made distinct and cut to the smallest ``size`` before they are shuffled by
    group, so a group of any size sends each task's smallest values only.
    """
    values = F.transform(
        F.sequence(F.lit(0), F.floor(F.length(column) / DIGITS) - 1),
        lambda at: F.substr(column, (at * DIGITS + 1).cast("int"), F.lit(DIGITS)),
    )
    held = F.when(F.length(column) > 0, values)
    single = fingerprints.select(*groups, F.explode_outer(held).alias("_value")).distinct()
    smallest = Window.partitionBy(*groups).orderBy(F.col("_value").asc_nulls_last())
    first = single.withColumn("_rank", F.row_number().over(smallest)).filter(F.col("_rank") <= size)
    return first.groupBy(*groups).agg(F.array_join(F.array_sort(F.collect_list("_value")), "").alias(column))


Key = tuple[int, int]


def _range_bounds(keys: DataFrame, ranges: int) -> list[Key]:
    """Keys (``place, hash``) that begin ranges of about equal size, ascending.

    Cuts are made by place; a place with several cuts has very many rows and is cut by
    hash as often. At most ``ranges`` cuts of either sort reach the driver.
    """
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    cut = lambda name: F.percentile_approx(name, shares, 100 * ranges)
    cuts = Counter(keys.agg(cut("place")).first()[0] or [])
    bounds = {(place, LOWEST) for place in cuts}
    hot = [place for place, times in cuts.items() if times > 1]
    if hot:
        inside = keys.filter(F.col("place").isin(hot)).groupBy("place").agg(cut("hash").alias("cuts"))
        for place, hashes in inside.collect():
            times = cuts[place]
            bounds |= {(place, hashes[i * len(hashes) // times]) for i in range(1, times)}
    return sorted(bounds)


def compare_with_next(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", size: int = SKETCH
) -> DataFrame:
    """Every document's fingerprint beside those of an edited text and the next document.

    The next document is the one with the next smaller id, after the last the first. The
    edited text has its last third replaced by the beginning of the next text.
    ``n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Ids are whole numbers; rows without id come last. Rows with one id follow each other
    by a hash of their text. A null text is empty. Documents are dealt out in ranges of
    ids and hashes, so rows of one id may lie in many, and the first of each range is also sent
    to the end of the range before: one shuffle and one pass over each range do. Only exact
    copies of a row, id included, stay together. Other columns are not looked at.
    """
    # Large ids come first: the bitwise complement turns their order round.
    place = F.bitwise_not(F.coalesce(F.col(id_column).cast("long"), F.lit(LOWEST)))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        place.alias("place"), F.xxhash64(body).alias("hash"), F.col(id_column).isNull().alias("unnamed"), body.alias("text")
    )
    keys = rows.select("place", "hash")
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _range_bounds(keys, ranges)

    def ranges_of(batch: pa.RecordBatch) -> list[int]:
        both = zip(batch.column("place").to_pylist(), batch.column("hash").to_pylist())
        return [bisect_right(bounds, key) for key in both]

    def number(batches):
        for batch in batches:
            own = pa.array(ranges_of(batch), pa.int64())
            yield pa.RecordBatch.from_arrays([own, *batch.columns], ["range", "place", "hash"])

    heads = keys.mapInArrow(number, "range long, place long, hash long").groupBy("range")
    heads = heads.agg(F.min(F.struct("place", "hash")).alias("head"))
    # One row per range.
    first = sorted((row.range, tuple(row.head)) for row in heads.collect())
    before = {head: first[at - 1][0] for at, (_, head) in enumerate(first)}
    routed = T._parse_datatype_string("range long, tail boolean, place long, hash long, unnamed boolean, text string")
    arrow = to_arrow_schema(routed)

    def route(batches):
        for batch in batches:
            own = pa.array(ranges_of(batch), pa.int64())
            tail = pa.array(np.zeros(batch.num_rows, dtype=bool))
            yield pa.RecordBatch.from_arrays([own, tail, *batch.columns], schema=arrow)
            both = list(zip(batch.column("place").to_pylist(), batch.column("hash").to_pylist()))
            at = [i for i, key in enumerate(both) if key in before]
            if at:
                copies = batch.take(pa.array(at))
                to = pa.array([before[both[i]] for i in at], pa.int64())
                tails = pa.array(np.ones(len(at), dtype=bool))
                yield pa.RecordBatch.from_arrays([to, tails, *copies.columns], schema=arrow)

    dealt = rows.mapInArrow(route, routed).repartitionById(len(bounds) + 1, F.col("range").cast("int"))
    ordered = dealt.sortWithinPartitions("range", "tail", "place", "hash")

    def make():
        kept: list = []

        def step(parts, tails, names, unnamed, texts):
            found = []
            for part, tail, name, without, whole in zip(parts, tails, names, unnamed, texts):
                if tail and not (kept and kept[0] == part):
                    continue
                values = sketch(whole, size)
                if kept:
                    _, own, missing, body, mine = kept
                    cut = len(body) // EDITED_PART
                    edited = body[: len(body) - cut] + whole[:cut]
                    changed = sketch(edited, size)
                    found.append(
                        (
                            None if missing else ~own,
                            len(body),
                            hashlib.sha256(edited.encode()).hexdigest(),
                            write(mine),
                            write(changed),
                            likeness(mine, changed, size),
                            likeness(mine, values, size),
                        )
                    )
                kept[:] = [] if tail else [part, name, without, whole, values]
            return [list(column) for column in zip(*found)] or [[] for _ in range(7)]

        return step

    schema = (
        f"`{id_column}` long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return map_slices(ordered.select("range", "tail", "place", "unnamed", "text"), make, schema)
