"""Duplicates. Copies are combined inside each input task before anything is shuffled, however many there are."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lettora.operators.columns import quoted


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct non-NULL key tuples. Only the keys are kept: which of several rows to keep is not defined."""
    plain = df.select(*map(quoted, keys)).toDF(*(f"_{k}" for k in range(len(keys))))  # na.drop knows no quoted names
    return plain.na.drop().distinct().toDF(*keys)
