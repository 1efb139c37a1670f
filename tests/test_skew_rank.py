import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lettora.operators.ranking import global_rank, rank_desc
from lettora.operators.skew import hot_keys, rows_per_key, skew_join
from lettora.params import SkewLimits

LIMITS = SkewLimits(rows_per_task=50)


def skewed(spark, rows=3000):
    """A third of the rows share a key, a tenth have none."""
    rng = random.Random(1)
    data = []
    for i in range(rows):
        key = "hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{rng.randint(0, 200)}"
        data.append((i, key, "b" if key == "hot" else f"c{i % 2}"))
    return spark.createDataFrame(data, "i int, a string, b string").repartition(8)


def other_side(spark):
    keys = [("hot", "b", 1), ("hot", "b", 2), (None, "c0", 3)] + [(f"k{n}", f"c{n % 2}", n) for n in range(0, 200, 3)]
    return spark.createDataFrame(keys, "a string, b string, v int")


def bag(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limits", [LIMITS, SkewLimits()])
def test_skew_join_equals_join(spark, how, limits):
    left, right = skewed(spark), other_side(spark)
    joined = skew_join(left, right, ["a", "b"], how, limits)
    plain = skew_join(left, right, ["a", "b"], how, None)
    assert joined.columns == plain.columns == ["a", "b", "i", "v"]
    assert bag(joined) == bag(plain)


def test_hot_keys_of_both_sides(spark):
    left, right = skewed(spark), skewed(spark, 700).withColumnRenamed("i", "j")
    joined = skew_join(left, right, ["a", "b"], "inner", LIMITS, split_right=True)
    assert bag(joined) == bag(left.join(right, ["a", "b"]))


def test_copies_of_one_row_are_kept(spark):
    left = spark.range(1000).select(F.lit("x").alias("a"))
    right = spark.createDataFrame([("x", 1), ("x", 2)], "a string, v int")
    assert skew_join(left, right, ["a"], "left", LIMITS).count() == 2000


def test_every_hot_key_is_counted(spark):
    hot = {row.a: row._salts for row in hot_keys(rows_per_key(skewed(spark), ["a", "b"]), ["a", "b"], LIMITS).collect()}
    assert hot == {"hot": 20}
    many = spark.range(1000).select((F.col("id") % 10).alias("a"))
    assert [row.a for row in hot_keys(rows_per_key(many, ["a"]), ["a"], LIMITS).orderBy("a").collect()] == [*range(10)]


def test_few_input_partitions_do_not_bound_the_pieces(spark):
    """A million rows of one key in two partitions reach at least 50 tasks of a hundred."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.adaptive.enabled": False}
    settings["spark.sql.shuffle.partitions"] = 100
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        left = spark.range(0, 1_000_000, 1, 2).select("id", F.lit("x").alias("a"))
        right = spark.createDataFrame([("x", 1)], "a string, v int")
        joined = skew_join(left, right, ["a"], "inner", SkewLimits(rows_per_task=10_000))
        tasks = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(tasks) == 1_000_000 and len(tasks) >= 50 and max(tasks) <= 60_000


@pytest.mark.parametrize("limits, hot_most", [(LIMITS, 200), (SkewLimits(), 1000)])
def test_rows_are_spread(spark, limits, hot_most):
    """With broadcast off, no task of the join holds the whole hot key, nor ever all rows without a key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        joined = skew_join(skewed(spark), other_side(spark).dropDuplicates(["a", "b"]), ["a", "b"], "left", limits)
        by_task = joined.groupBy(F.spark_partition_id().alias("task"), F.coalesce("a", F.lit("none")).alias("a")).count()
        largest = {row.a: row.n for row in by_task.groupBy("a").agg(F.max("count").alias("n")).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert largest["hot"] <= hot_most and largest["none"] <= 120


def test_other_join_kinds_are_refused(spark):
    with pytest.raises(ValueError):
        skew_join(skewed(spark), other_side(spark), ["a"], "full")


@pytest.mark.parametrize("slices", [1, 3, 8])
def test_global_rank_equals_rank(spark, slices):
    rng = random.Random(3)
    values = [None if i % 7 == 0 else 5.0 if i % 3 == 0 else float(rng.randint(0, 400)) for i in range(2000)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double").repartition(8)
    ranked = global_rank(df, "v", "r", slices, SkewLimits(rows_per_task=50))
    plain = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc())).cast("long"))
    assert bag(ranked) == bag(plain)


def test_global_rank_of_strings_and_of_nothing(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "v string")
    assert sorted((r.v or "", r.r) for r in global_rank(df, "v", "r").collect()) == [("", 4), ("a", 3), ("b", 1), ("b", 1)]
    assert global_rank(df.limit(0), "v", "r").count() == 0


def test_rank_desc(spark):
    df = spark.createDataFrame([(3,), (3,), (1,), (None,)], "v int").withColumn("r", rank_desc("v"))
    assert sorted((r.v or 0, r.r) for r in df.collect()) == [(0, 4), (1, 3), (3, 1), (3, 1)]
