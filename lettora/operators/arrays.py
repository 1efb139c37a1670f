"""Turning array columns into rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lettora.operators.columns import drop_type, names_of_type, quoted


#: What ``explosion_counts`` counts.
EXPLOSION = ("rows_in", "rows_out", "rows_lost")
#: Rows that one task makes of one row with large arrays.
ROWS_PER_TASK = 1_000_000


def explode_arrays(df: DataFrame, mode: str = "chain", rows_per_task: int | None = ROWS_PER_TASK, tasks: int = 200) -> DataFrame:
    """Explode every array column, then drop columns that are still arrays (arrays of arrays).

    ``chain`` explodes one column after the other: a row gives the product of its array lengths, and vanishes when one of
    its arrays is NULL or empty. ``zip`` walks all arrays of a row side by side: as many rows as the longest array (one at
    least), NULL where an array has ended.

    A row that ``chain`` turns into more than ``rows_per_task`` rows is not exploded in place: the product is cut into
    ranges of that many rows, and these are dealt to at least ``tasks`` tasks. ``None`` leaves all rows in place.
    """
    arrays = names_of_type(df, ArrayType)
    if not arrays:
        return df
    if mode == "chain":
        rows = _explode_product(df, arrays, rows_per_task, tasks)
    elif mode == "zip":
        rows = _explode_side_by_side(df, arrays)
    else:
        raise ValueError(f"mode must be 'chain' or 'zip', not {mode!r}")
    return drop_type(rows, ArrayType)


def _size(name: str) -> Column:
    return F.greatest(F.size(F.col(quoted(name))), F.lit(0)).cast("long")


def _product(arrays: list[str]) -> Column:
    """How many rows ``chain`` makes of a row; NULL beyond what a long holds."""
    return reduce(F.try_multiply, map(_size, arrays), F.lit(1).cast("long"))


def _explode_product(df: DataFrame, arrays: list[str], rows_per_task: int | None, tasks: int) -> DataFrame:
    def in_place(rows: DataFrame) -> DataFrame:
        return reduce(lambda out, name: out.withColumn(name, F.explode(F.col(quoted(name)))), arrays, rows)

    if rows_per_task is None or len(arrays) == 1:
        return in_place(df)
    total = _product(arrays)
    # No table holds 2^63 rows, so that many are an error and not a row less.
    large = df.where(total.isNull() | (total > rows_per_task)).withColumn(
        "_total", F.coalesce(total, F.raise_error(F.lit("a row explodes into more than 2^63 rows")).cast("long"))
    )
    pieces = large.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_total - 1) div {rows_per_task}"))))
    # By number: partitions of a few small rows would be merged again.
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(quoted(field.name)) for field in df.schema if "map<" not in field.dataType.simpleString() and "variant" not in field.dataType.simpleString()]
    dealt = pieces.repartition(max(tasks, shuffles), F.xxhash64(*keys), "_piece")
    first = F.col("_piece") * rows_per_task
    last = F.least(first + rows_per_task, F.col("_total")) - 1
    numbered = dealt.withColumn("_at", F.explode(F.sequence(first, last)))
    # The number of a row, with the sizes of its arrays as places: the last array turns fastest, as in the chain.
    rows, step = {}, "1L"
    for name in reversed(arrays):
        size = f"cast(size({quoted(name)}) as bigint)"
        rows[name] = F.get(F.col(quoted(name)), F.expr(f"cast(_at div ({step}) % {size} as int)"))
        step = f"{step} * {size}"
    decoded = numbered.select(*(rows.get(name, F.col(quoted(name))).alias(name) for name in df.columns))
    return in_place(df.where(total <= rows_per_task)).union(decoded)


def _explode_side_by_side(df: DataFrame, arrays: list[str]) -> DataFrame:
    # A NULL array would make the whole zip NULL, so it counts as empty here.
    kinds = {field.name: field.dataType for field in df.schema.fields}
    safe = [F.coalesce(F.col(quoted(name)), F.array().cast(kinds[name])).alias(name) for name in arrays]
    slot = F.explode_outer(F.arrays_zip(*safe)).alias("_slot")
    positions = {name: number for number, name in enumerate(arrays)}
    rows = df.select("*", slot)
    slot_fields = rows.schema["_slot"].dataType.fieldNames()
    return rows.select(
        [
            F.col("_slot")[slot_fields[positions[name]]].alias(name) if name in positions else F.col(quoted(name))
            for name in df.columns
        ]
    )


def explosion_counts(df: DataFrame, mode: str = "chain") -> list[Column]:
    """Aggregates that say what ``explode_arrays`` does to the rows of ``df``, without exploding anything.

    ``rows_in``, ``rows_out`` and ``rows_lost`` (input rows that vanish).
    """
    arrays = names_of_type(df, ArrayType)
    if mode == "zip" and arrays:
        n = F.greatest(F.lit(1).cast("long"), *map(_size, arrays))
    else:
        n = _product(arrays)
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("rows_out"),
        F.count_if(n == 0).alias("rows_lost"),
    ]


def explosion_report(df: DataFrame, mode: str = "chain") -> DataFrame:
    """``explosion_counts`` as one row."""
    return df.agg(*explosion_counts(df, mode))
