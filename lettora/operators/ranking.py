"""Rank of every row by one column, descending, gaps after ties, NULLs last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from lettora.operators.skew import skew_join
from lettora.params import SkewLimits
from lettora.sources.shared import written


# Distinct values that one task sorts.
SLICE_ROWS = 1_000_000


def rank_desc(column: str) -> Column:
    """Plain global rank. It sorts everything in one task, so it is only for inputs of bounded size.

    The gold tables qualify: they have one row per PC4, and there are at most 10,000 four-digit codes.
    """
    return F.rank().over(Window.orderBy(F.col(column).desc()))


def global_rank(
    df: DataFrame,
    column: str,
    alias: str,
    slices: int | None = None,
    limits: SkewLimits | None = SkewLimits(),
) -> DataFrame:
    """The same rank (as a long) for tables of any size; no task sees more than a slice of the distinct values.

    1. Count rows per distinct value: ties, however many, become one row each.
    2. Range-partition the distinct values into ``slices``, by default of about ``SLICE_ROWS`` values, and write them to
       the shared folder. The slice numbers are thereby fixed, whatever is recomputed later.
    3. Rows in earlier slices (one small row per slice) + rows earlier within the slice + 1 = rank of the value.
    4. Join the ranks back, splitting values that very many rows share.
    """
    counts = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    if slices is None:
        counts = written(counts, "rank_counts")
        slices = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), counts.count() // SLICE_ROWS + 1)
    sliced = written(
        counts.repartitionByRange(slices, F.col("_value").desc()).withColumn("_slice", F.spark_partition_id()),
        "rank_values",
    )
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.sum("_n").alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    above = Window.partitionBy("_slice").orderBy(F.col("_value").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # A struct key, unlike a bare value, also matches NULL with NULL.
    ranks = (
        # One row per slice: a row for a million distinct values.
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn(alias, F.col("_before") + F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1)
        .select(F.struct("_value").alias("_key"), alias)
    )
    keyed = df.withColumn("_key", F.struct(F.col(column).alias("_value")))
    counted = sliced.select(F.struct("_value").alias("_key"), F.col("_n").alias("n"))
    return skew_join(keyed, ranks, ["_key"], "inner", limits, counted).select(*df.columns, alias)
