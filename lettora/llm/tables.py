"""Reading the given tables, and mapping Arrow batches to rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of an Arrow batch that are worked on, and returned, at a time: this bounds a worker's memory.
PIECE_ROWS = 1000


def _typed(column: Iterable, kind: pa.DataType) -> pa.Array:
    if isinstance(column, pa.Array):
        return column if column.type == kind else column.cast(kind)
    return pa.array(column, kind)


def map_batches(df: DataFrame, rows: Callable[..., Iterable[Iterable]], schema: StructType, *args) -> DataFrame:
    """``rows(batch, *args)`` yields tuples of columns for every Arrow batch of ``df``; one tuple makes one batch."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (batch.slice(at, PIECE_ROWS) for batch in batches for at in range(0, batch.num_rows, PIECE_ROWS))
        for piece in pieces:
            for columns in rows(piece, *args):
                arrays = [_typed(c, kind) for c, kind in zip(columns, arrow.types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)
