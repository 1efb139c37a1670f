"""Equi-join that splits hot keys of its left side.

The hot keys are counted, not guessed: one aggregation over the key columns alone, combined before its shuffle. There is
no limit on their number, which is at most rows / ``rows_per_task``. The list is written to the shared folder, so that
both sides of the join see the same one, and joined by its measured size: broadcast if small, shuffled otherwise. Left
rows of a hot key are spread over salts, and the right rows of that key are repeated once per salt. Rows with a NULL key
match nothing and are spread as well.

The salt of a row is a hash of its columns and of its input partition, not a random number, so a task that is run again
after the loss of an executor sends each row where it went the first time. Equal rows of one partition stay together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettora.operators.columns import quoted
from lettora.params import SkewLimits
from lettora.sources.shared import written

SALT, SALTS, SPREAD, PIECE = "_salt", "_salts", "_spread", "_piece"


def rows_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct non-NULL keys with their number of rows ``n``."""
    return _with_keys(df, keys).groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("n"))


def _with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(quoted(key)).isNotNull() for key in keys]))


def hot_keys(counted: DataFrame, keys: list[str], limits: SkewLimits = SkewLimits()) -> DataFrame:
    """Keys with more than ``rows_per_task`` of the counted rows ``n``, and into how many salts each is to be split."""
    salts = F.ceil(F.col("n") / F.lit(limits.rows_per_task)).cast("int").alias(SALTS)
    return counted.where(F.col("n") > limits.rows_per_task).select(*map(quoted, keys), salts)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    limits: SkewLimits | None = SkewLimits(),
    counted: DataFrame | None = None,
    split_right: bool = False,
) -> DataFrame:
    """``left.join(right, on, how)`` for ``how`` inner or left; ``limits=None`` is the plain join.

    ``counted`` are the rows per key of ``left`` (columns ``on`` and ``n``), for callers that have them already.
    ``split_right`` (inner only) splits the hot keys of the right side too: left rows are repeated per piece. Building the
    join runs jobs: keys are counted and their list is written.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    if limits is None:
        return left.join(right, on, how)
    if split_right:
        if how != "inner":
            raise ValueError("only an inner join can split its right side")
        pieces = written(hot_keys(rows_per_key(right, on), on, limits), "hot_keys")
        if not pieces.isEmpty():
            every = F.sequence(F.lit(0).cast("long"), F.coalesce(SALTS, F.lit(1)).cast("long") - 1)
            spread = F.xxhash64(*_hashable(right), F.spark_partition_id())
            right = right.withColumn(SPREAD, spread).join(pieces, on, "left")
            right = right.withColumn(PIECE, F.pmod(SPREAD, F.coalesce(SALTS, F.lit(1)).cast("long"))).drop(SALTS, SPREAD)
            left = left.join(pieces, on, "left").withColumn(PIECE, F.explode(every)).drop(SALTS)
            return skew_join(left, right, [*on, PIECE], how, limits).drop(PIECE)
    if how == "inner":
        left = _with_keys(left, on)
    hot = written(hot_keys(counted or rows_per_key(left, on), on, limits), "hot_keys")
    if how == "inner" and hot.isEmpty():
        return left.join(right, on, how)
    no_key = reduce(lambda a, b: a | b, [F.col(quoted(key)).isNull() for key in on])
    # Not a literal: the optimizer would take a literal out of the join keys, and the salt with it.
    zero = F.pmod(F.hash(*map(quoted, on)), F.lit(1)).cast("long")
    spread = left.withColumn(SPREAD, F.xxhash64(*_hashable(left), F.spark_partition_id())).join(hot, on, "left")
    salt = F.when(no_key, F.col(SPREAD)).when(F.col(SALTS).isNull(), zero).otherwise(F.pmod(SPREAD, SALTS))
    salted = spread.withColumn(SALT, salt).drop(SALTS, SPREAD)
    repeats = F.sequence(F.lit(0).cast("long"), F.coalesce(SALTS, F.lit(1)).cast("long") - 1)
    repeated = right.join(hot, on, "left").withColumn(SALT, F.explode(repeats)).drop(SALTS)
    return salted.join(repeated, [*on, SALT], how).drop(SALT)


def _hashable(df: DataFrame) -> list[Column]:
    return [F.col(quoted(field.name)) for field in df.schema if "map<" not in field.dataType.simpleString()]
