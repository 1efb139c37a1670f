"""Operators driven by the schema: pick, drop, flatten and clean columns by data type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from lettora.functions.text import blank_to_null


def names_of_type(df: DataFrame, kind: type[DataType]) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, kind)]


def drop_type(df: DataFrame, kind: type[DataType]) -> DataFrame:
    return df.drop(*[F.col(quoted(name)) for name in names_of_type(df, kind)])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def flatten_structs(df: DataFrame) -> DataFrame:
    """Every leaf of every nested struct as a column of its own, ``a.b`` named ``a_b``.

    Two leaves with the same flat name (``a_b`` next to ``a.b``) are an error rather than an ambiguous column.
    """
    leaves = _leaves(df.schema, [])
    flat = ["_".join(path) for path in leaves]
    twice = sorted({name for name in flat if flat.count(name) > 1})
    if twice:
        raise ValueError(f"flattening gives the same column name more than once: {twice}")
    return df.select([F.col(".".join(map(quoted, path))).alias(name) for path, name in zip(leaves, flat)])


def _leaves(schema: StructType, above: list[str]) -> list[list[str]]:
    found: list[list[str]] = []
    for field in schema.fields:
        path = [*above, field.name]
        found += _leaves(field.dataType, path) if isinstance(field.dataType, StructType) else [path]
    return found


def null_strings_to(df: DataFrame, value: str = "Unknown") -> DataFrame:
    """NULL -> ``value`` in all string columns."""
    filled = {name: F.coalesce(F.col(quoted(name)), F.lit(value)) for name in names_of_type(df, StringType)}
    return df.withColumns(filled) if filled else df


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim all string columns; blank becomes NULL."""
    cleaned: dict[str, Column] = {
        name: blank_to_null(F.col(quoted(name))) for name in names_of_type(df, StringType)
    }
    return df.withColumns(cleaned) if cleaned else df


def preview(df: DataFrame, rows: int, order_by: list[str] | None = None) -> DataFrame:
    """The first ``rows`` rows; with ``order_by`` always the same ones."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def value_rows(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows where ``column`` equals ``value``."""
    return df.where(F.col(quoted(column)) == F.lit(value))
