"""Excluding, attaching, repeating and uniting rows.

No join here is hinted as a broadcast. Adaptive execution broadcasts a side when
its measured size is under the session's threshold, and otherwise splits skewed
partitions; the join types are chosen so that it can split the side that may be
skewed. Rows without a usable id never enter a join: they match nothing, and as
one null key they would all land in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.operators.running import running_start
from tracemill.sources.staging import stage


def _usable(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


def _unusable(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


def _distinct_ids(df: DataFrame, by: str) -> DataFrame:
    """The usable ids of ``df``, once each.

    Grouped by the id together with its hash: the join above then brings its own
    exchange on the id. Grouped by the id alone, the aggregation would sit between
    exchange and join, and adaptive execution would not split skewed partitions.
    """
    ids = df.filter(_usable(by)).select(by, F.crc32(F.col(by).cast("binary")).alias("id_hash"))
    return ids.distinct().select(by)


def exclude_ids(df: DataFrame, used: DataFrame, by: str = "id") -> DataFrame:
    """Rows of ``df`` whose id does not occur in ``used``; rows without id stay."""
    kept = df.filter(_usable(by)).join(_distinct_ids(used, by), by, "left_anti")
    return kept.unionByName(df.filter(_unusable(by)))


def repeated_ids(df: DataFrame, by: str) -> DataFrame:
    """Usable ids that occur more than once."""
    counts = df.filter(_usable(by)).groupBy(by).agg(F.count("*").alias("rows"))
    return counts.filter("rows > 1").select(by)


def check_repeats(problems: DataFrame, completions: DataFrame, by: str = "id") -> None:
    """Raise if an id is repeated on both sides, for callers whose ids must be unique."""
    both = repeated_ids(problems, by).join(repeated_ids(completions, by), by, "left_semi")
    found = both.limit(3).collect()
    if found:
        named = ", ".join(str(row[0]) for row in found)
        raise ValueError(f"ids repeated among problems and among completions: {named}")


def repeated_on_both(problems: DataFrame, completions: DataFrame, by: str = "id") -> DataFrame:
    """Usable ids that are repeated among the problems and among the completions.

    With the rows of each: ``by, problems, completions``. One aggregation over both tables.
    """
    sides = problems.filter(_usable(by)).select(by, F.lit(1).alias("problems"), F.lit(0).alias("completions"))
    others = completions.filter(_usable(by)).select(by, F.lit(0).alias("problems"), F.lit(1).alias("completions"))
    counts = sides.unionByName(others).groupBy(by).agg(
        F.sum("problems").alias("problems"), F.sum("completions").alias("completions")
    )
    return counts.filter("problems > 1 and completions > 1")


def unknown_completions(problems: DataFrame, completions: DataFrame, by: str = "id") -> DataFrame:
    """Completions that belong to no problem, or to none that can be told."""
    return exclude_ids(completions, problems, by)


def attach_completions(
    problems: DataFrame,
    completions: DataFrame,
    by: str = "id",
    answered: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Pair every completion with its problem; also give the unanswered problems.

    Every problem row counts, copies too. An id may be repeated on one side; for both see
    :func:`pair_occurrences`. ``answered`` may name a cheaper table with the ids of
    ``completions``.

    This is a left join in two parts, because a left join could not split a
    problem with very many completions: the inner part can, and the other part only
    has distinct ids to check against.
    """
    asked = problems.filter(_usable(by))
    pairs = asked.join(completions.filter(_usable(by)), by, "inner")
    ids = _distinct_ids(completions if answered is None else answered, by)
    silent = asked.join(ids, by, "left_anti")
    return pairs, silent.unionByName(problems.filter(_unusable(by)))


def _in_slots(df: DataFrame, repeated: DataFrame, by: str, order: Sequence[str]) -> DataFrame:
    """Rows of repeated ids, stored, with their occurrence modulo the rarer side's rows.

    The occurrence follows the content of the columns in ``order``; copies are told apart by
    their place in the stored table, so that a group of them is spread over tasks.
    """
    parts = [F.coalesce(F.md5(F.col(name).cast("string")), F.lit("")) for name in order]
    rows = df.join(repeated.select(by), by, "left_semi").select(
        "*", F.md5(F.concat_ws(":", *parts)).alias("_digest"), F.monotonically_increasing_id().alias("_row")
    )
    rows = stage(rows, "repeated-rows")
    light = rows.select(by, "_digest", "_row", F.lit(1).alias("_one"))
    light = running_start(light, [by], ["_digest", "_row"], "_one", "_occurrence")
    slot = F.pmod("_occurrence", F.least("problems", "completions")).alias("_slot")
    slots = light.join(repeated, by).select("_row", slot)
    return rows.join(slots, "_row").drop("_row", "_digest")


def pair_occurrences(
    problems: DataFrame,
    completions: DataFrame,
    repeated: DataFrame,
    by: str = "id",
    order: tuple[Sequence[str], Sequence[str]] | None = None,
) -> DataFrame:
    """Pairs of the rows whose ids are repeated on both sides, one by one.

    Of an id with ``m`` problems and ``n`` completions the first meets the first, the second
    the second and so on; the rarer side starts again from its first row. So every row is in
    a pair, and there are as many pairs as the more frequent side has rows, never all.
    Rows are counted in the order of the MD5 of their columns (``order``, or all but the id).
    ``repeated`` is the stored outcome of :func:`repeated_on_both`.
    """
    if order is None:
        order = tuple([name for name in df.columns if name != by] for df in (problems, completions))
    asked, given = (_in_slots(df, repeated, by, names) for df, names in zip((problems, completions), order))
    return asked.join(given, [by, "_slot"]).drop("_slot")


def oversample(df: DataFrame, times: int, copy: str = "copy") -> DataFrame:
    """Every row ``times`` times, numbered from 0 in ``copy``; none for 0."""
    if times < 0:
        raise ValueError(f"times must not be negative: {times}")
    return df.select("*", F.posexplode(F.array_repeat(F.lit(0), times)).alias(copy, "_")).drop("_")


def union_texts(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, duplicates included, columns matched by name."""
    first, *others = parts
    for other in others:
        first = first.unionByName(other)
    return first
