"""Row-wise Python steps over Arrow batches, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows that are Python objects at one time.
ROWS_PER_SLICE = 256

Columns = list[list]
Step = Callable[..., Columns]


def map_slices(df: DataFrame, make: Callable[[], Step], schema: str) -> DataFrame:
    """Apply a step to the columns of ``df``, a few hundred rows at a time.

    ``make`` runs once in every task and returns the step. That takes one list per
    column and returns the columns of ``schema``, with any number of rows. State
    kept between slices sees the rows of a task in their order.
    """
    wanted = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_SLICE):
                part = batch.slice(start, ROWS_PER_SLICE)
                columns = step(*(column.to_pylist() for column in part.columns))
                arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, wanted)
