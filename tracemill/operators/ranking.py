"""Exact cuts of a table at a rank, without sorting it.

``orderBy(key).limit(n)`` sends ``n`` rows of every task to a single one. That is
fine for a handful of rows and breaks down for thousands of rows out of many
partitions. Here the key of the wanted rank is found first: rows are counted by the
leading digits of a hexadecimal key, then again by more digits inside the one
bucket that holds the rank, until the cut falls between two buckets. Each pass is a
map-side aggregation over the narrow key with at most 4096 result rows, and three
passes settle 60 billion rows. The cut itself is then a plain filter.
"""

from __future__ import annotations

import os.path
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# More digits would mean fewer passes, but every task sends a count per bucket.
DIGITS_PER_PASS = 3
# A bucket of no more rows, or of one key, is counted by whole keys.
SMALL_BUCKET = 16**DIGITS_PER_PASS
WHOLE_KEY = 2**31 - 1
# Rows one task writes out when identical rows are multiplied.
COPIES_PER_TASK = 10_000


def order_key(df: DataFrame, name: str) -> Column:
    """A hexadecimal key that sorts like the text or integer column ``name``.

    Nulls come first, as in an ascending Spark sort.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        digits = F.hex(F.encode(F.col(name), "UTF-8"))
    elif isinstance(kind, T.IntegralType):
        # Flipping the sign bit makes the unsigned digits sort like the numbers.
        flipped = F.col(name).cast("bigint").bitwiseXOR(F.lit(-(2**63)))
        digits = F.lpad(F.hex(flipped), 16, "0")
    else:
        raise TypeError(f"cannot order by {name}: {kind.simpleString()}")
    return F.when(F.col(name).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), digits))


def seeded_key(seed: int, *columns: str | Column) -> Column:
    """A uniform, engine-independent order: the MD5 of seed and key columns."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))


# Without these, JSON would cut time stamps at milliseconds.
EXACT_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_EXACT_TYPES = (
    T.StringType,
    T.BinaryType,
    T.BooleanType,
    T.NumericType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.NullType,
)


def _exact_in_json(kind: T.DataType) -> bool:
    """Whether different values of the type are always written differently."""
    if isinstance(kind, T.StructType):
        return all(_exact_in_json(field.dataType) for field in kind)
    if isinstance(kind, T.ArrayType):
        return _exact_in_json(kind.elementType)
    return isinstance(kind, _EXACT_TYPES)


def content_key(df: DataFrame) -> Column:
    """MD5 over all columns: equal for exact copies only.

    Columns of types that JSON does not tell apart, such as maps and intervals, are
    refused.
    """
    for field in df.schema:
        if not _exact_in_json(field.dataType):
            raise TypeError(f"cannot compare {field.name}: {field.dataType.simpleString()}")
    return F.md5(F.to_json(F.struct(*df.columns), EXACT_JSON))


@dataclass(frozen=True)
class Cut:
    """Rows below ``bound``, and ``extra`` of the ``tied`` rows whose key equals it.

    ``bound`` is None where the rank reaches the end of the table.
    """

    bound: str | None
    extra: int = 0
    tied: int = 0


def common_start(df: DataFrame, key: Column) -> str:
    """The digits that all keys begin with, so that no pass is spent on them."""
    ends = df.select(key.alias("key")).agg(F.min("key"), F.max("key")).first()
    return os.path.commonprefix([end or "" for end in ends])


def find_cut(
    df: DataFrame, key: Column, rank: int | Callable[[int], int], start: str = ""
) -> Cut:
    """Locate the cut behind the first ``rank`` rows in key order.

    ``rank`` may be a function of the row count, which the first pass yields. All
    keys begin with ``start``.
    """
    inside = keys = df.select(key.alias("key"))
    digest = F.xxhash64("key")
    width, missing = len(start) + DIGITS_PER_PASS, None
    while True:
        buckets = inside.groupBy(F.substring("key", 1, width).alias("bucket")).agg(
            F.count("*").alias("rows"), (F.min(digest) == F.max(digest)).alias("one_key")
        )
        counts = sorted(map(tuple, buckets.collect()))
        if missing is None:
            total = sum(count for _, count, _ in counts)
            missing = rank(total) if callable(rank) else rank
            if missing >= total:
                return Cut(None)
            if missing <= 0:
                return Cut("")
        for bucket, count, one_key in counts:
            if missing < count:
                break
            missing -= count
        if missing == 0:
            return Cut(bucket)
        if len(bucket) < width:
            return Cut(bucket, missing, count)
        inside = keys.filter(F.col("key").startswith(bucket))
        if one_key or count <= SMALL_BUCKET:
            width = WHOLE_KEY
            continue
        # Uniform keys fall into many buckets. A bucket with most of the rows points to
        # keys with a long start in common, which one look skips at once.
        crowded = 2 * count > sum(rows for _, rows, _ in counts)
        shared = common_start(inside, F.col("key")) if crowded else bucket
        width = max(width, len(shared)) + DIGITS_PER_PASS


def _copies(identical: DataFrame, count: int) -> DataFrame:
    """``count`` rows like the given ones, which are all the same."""
    one = identical.limit(1)
    if count <= COPIES_PER_TASK:
        return one.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), count))).drop("_copy")
    whole, rest = divmod(count, COPIES_PER_TASK)
    full = one.withColumn("_part", F.explode(F.sequence(F.lit(1), F.lit(whole))))
    # One row per part travels; the multiplying happens behind the shuffle.
    full = full.repartition("_part")
    full = full.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), COPIES_PER_TASK)))
    full = full.drop("_part", "_copy")
    return full.unionByName(_copies(identical, rest)) if rest else full


def split_at(
    df: DataFrame,
    keys: Sequence[Column],
    rank: int | Callable[[int], int],
    start: str = "",
) -> tuple[DataFrame, DataFrame]:
    """The first ``rank`` rows in the order of ``keys``, and all the others.

    Rows that tie on one key are cut by the next. Rows that tie on all of them
    must be exact copies; it does not matter which of those go where, so they are
    multiplied from one of them.
    """
    key, *further = keys
    cut = find_cut(df, key, rank, start)
    if cut.bound is None:
        return df, df.filter(F.lit(False))
    head, tail = df.filter(key < cut.bound), df.filter(key >= cut.bound)
    if not cut.extra:
        return head, tail
    tied, tail = df.filter(key == cut.bound), df.filter(key > cut.bound)
    if further:
        first, second = split_at(tied, further, cut.extra)
    else:
        first, second = _copies(tied, cut.extra), _copies(tied, cut.tied - cut.extra)
    return head.unionByName(first), tail.unionByName(second)


def first_rows(df: DataFrame, count: int, key: Column, uniform: bool = False) -> DataFrame:
    """The first ``count`` rows in key order, ties by content, as an unordered table.

    The rule is one for all counts, so fewer rows are always among more. ``uniform``
    keys, such as hashes, are spread evenly over all digits.
    """
    if count < 0:
        raise ValueError(f"row count must not be negative: {count}")
    start = "" if uniform else common_start(df, key)
    return split_at(df, [key, content_key(df)], count, start)[0]
