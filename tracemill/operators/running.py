"""Running totals in an order, of groups that may be larger than any task.

A window over a group reads the whole group in one task. Here rows are dealt out by
ranges of group and order first, so a large group lies in many tasks; each task's part
of a group is a chunk. Chunks are summed up, the sums give every chunk its offset, and a
window runs inside a chunk only. A group has at most as many chunks as there are tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.sources.staging import stage


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    """Equality of columns; a null is a value like others."""
    equal = (F.col(f"{left}.`{name}`").eqNullSafe(F.col(f"{right}.`{name}`")) for name in names)
    return reduce(Column.__and__, equal)


def running_start(
    df: DataFrame, group: Sequence[str], order: Sequence[str], amount: str, start: str = "start"
) -> DataFrame:
    """``df`` with the sum of ``amount`` over the rows of its group in front of each row.

    Nulls come first in the order and are a group of their own. Rows that are equal in
    group and order stay in one task, so ``order`` should end in a number of the row where
    there may be very many of them. The rows are stored once, and should be narrow. Without
    a group the total runs over the whole table.
    """
    chunk, place = "_chunk", "_place"
    sort = [F.col(name).asc_nulls_first() for name in (*group, *order)]
    dealt = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    dealt = dealt.withColumn(chunk, F.spark_partition_id()).withColumn(place, F.monotonically_increasing_id())
    dealt = stage(dealt, "dealt-rows")
    keys = [*group, chunk]
    sums = dealt.groupBy(*keys).agg(F.sum(amount).alias("_sum"))
    # One row for each chunk: no more than tasks, even where the whole table is the group.
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy(chunk)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    joined = dealt.alias("d").join(offsets.alias("o"), _same("d", "o", keys)).select("d.*", "_offset")
    inside = Window.partitionBy(*keys).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return joined.withColumn(start, F.col("_offset") + before).drop(chunk, place, "_offset")
