"""Running a function over Arrow batches of chosen columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from budgetloom.session import map_arrow

#: Rows a function sees at once; it bounds a worker's memory and changes no result.
ROWS_AT_ONCE = 2_000


def over_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int = ROWS_AT_ONCE) -> DataFrame:
    """``df.mapInArrow`` in slices of at most ``rows`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                out = function(batch.slice(start, rows))
                if out is not None and out.num_rows:
                    yield out

    return map_arrow(df, run, schema)


def batch_of(**columns) -> pa.RecordBatch:
    """A record batch of named arrays."""
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], list(columns))
