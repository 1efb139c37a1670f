"""Data-quality profile: any number of checks in one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettora.operators.columns import quoted


def profile(
    df: DataFrame,
    checks: Mapping[str, Column] | None = None,
    distinct: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row: ``row_count``, the number of rows that meet each check, and the number of distinct non-NULL key tuples."""
    counts = [F.count_if(check).alias(name) for name, check in (checks or {}).items()]
    tuples = [F.count_distinct(*(F.col(quoted(key)) for key in keys)).alias(name) for name, keys in (distinct or {}).items()]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *counts, *tuples)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return profile(df, {f"{name}_nulls": F.col(quoted(name)).isNull() for name in columns})
