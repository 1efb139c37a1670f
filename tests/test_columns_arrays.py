import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from lettora.operators.arrays import explode_arrays, explosion_report
from lettora.operators.columns import (
    drop_type,
    flatten_structs,
    names_of_type,
    null_strings_to,
    preview,
    trim_strings,
    value_rows,
)
from lettora.operators.distinct import distinct_keys, distinct_rows
from lettora.operators.skew import rows_per_key
from lettora.plans.quality import null_counts, profile


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_flatten_structs(spark):
    df = spark.sql("select 1 as id, struct(2 as b, struct('x' as `d.e`) as c) as a")
    assert flatten_structs(df).columns == ["id", "a_b", "a_c_d.e"]
    assert rows(flatten_structs(df)) == [(1, 2, "x")]


def test_flatten_structs_refuses_equal_names(spark):
    with pytest.raises(ValueError, match="a_b"):
        flatten_structs(spark.sql("select 1 as a_b, struct(2 as b) as a"))


def test_by_type(spark):
    df = spark.sql("select 'x' as s, array(1) as l, 2 as n")
    assert names_of_type(df, StringType) == ["s"]
    assert drop_type(df, ArrayType).columns == ["s", "n"]


def test_null_and_blank_strings(spark):
    df = spark.createDataFrame([(None, " a ", None), ("  ", "b", 1)], "p string, q string, n int")
    assert rows(null_strings_to(df)) == [("  ", "b", 1), ("Unknown", " a ", None)]
    assert rows(trim_strings(df)) == [(None, "a", None), (None, "b", 1)]


def test_explode_chain_is_a_product_and_drops_empty(spark):
    df = spark.sql(
        """select * from values (1, array(1, 2), array(3, 4), array(array(9))), (2, array(1), array(), array(array(9))),
        (3, array(1), null, array(array(9))) as t(id, a, b, nested)"""
    )
    out = explode_arrays(df)
    assert out.columns == ["id", "a", "b"]
    assert rows(out) == [(1, 1, 3), (1, 1, 4), (1, 2, 3), (1, 2, 4)]
    assert rows(explosion_report(df)) == [(3, 4, 2)]


def test_explode_zip_keeps_every_row(spark):
    df = spark.sql("select * from values (1, array(1, 2), array(3)), (2, array(1), null), (3, array(), null) as t(id, a, b)")
    assert rows(explode_arrays(df, "zip")) == [(1, 1, 3), (1, 2, None), (2, 1, None), (3, None, None)]


def test_explode_needs_a_known_mode(spark):
    with pytest.raises(ValueError):
        explode_arrays(spark.sql("select array(1) as a"), "other")


def test_distinct(spark):
    df = spark.createDataFrame([("1", "2"), ("1", "2"), ("1", "2.0"), (None, "2")], "a string, b string")
    assert rows(distinct_keys(df, ["a", "b"])) == [("1", "2"), ("1", "2.0")]
    assert distinct_rows(df).count() == 3


def test_value_rows_and_preview(spark):
    df = spark.createDataFrame([(4, "red"), (8, "blue"), (6, None), (2, "red")], "size int, colour string")
    assert value_rows(df, "colour", "red").count() == 2
    assert [r.size for r in preview(df, 3, ["size"]).collect()] == [2, 4, 6]
    assert preview(df, 3).count() == 3


def test_null_safe_names(spark):
    df = spark.createDataFrame([(" x ",)], ["a.b"])
    assert trim_strings(df).first()[0] == "x"
    assert value_rows(df, "a.b", " x ").select(F.count(F.lit(1))).first()[0] == 1
    empty = spark.createDataFrame([(None,), ("x",), ("x",)], "`a.b` string")
    assert sorted(r[0] for r in null_strings_to(empty).collect()) == ["Unknown", "x", "x"]
    assert distinct_keys(empty, ["a.b"]).count() == 1
    assert [r.n for r in rows_per_key(empty, ["a.b"]).collect()] == [2]
    assert null_counts(empty, ["a.b"]).first()["a.b_nulls"] == 1
    assert profile(empty, distinct={"values": ["a.b"]}).first()["values"] == 1


@pytest.mark.parametrize("rows_per_task", [1, 2, 5, 10**6, None])
def test_large_products_are_decoded_from_numbers(spark, rows_per_task):
    rows = [(1, ["a", "b"], [1, 2, 3], [[1], [2, 3]]), (2, ["c"], [], [[]]), (3, None, [1], [[]]), (4, ["d", None], [None], [None, [9]]), (5, ["e"], [7], [[1]])]
    df = spark.createDataFrame(rows, "id int, `a b` array<string>, n array<int>, deep array<array<int>>")
    expected = [(i, a, n) for i, first, second, third in rows for a in first or () for n in second or () for _ in third or ()]
    assert len(expected) == 17
    assert sorted(tuple(r) for r in explode_arrays(df, rows_per_task=rows_per_task).fillna({"a b": "", "n": 0}).collect()) == sorted(
        (i, a or "", n or 0) for i, a, n in expected
    )


def test_one_row_of_large_arrays_is_many_tasks(spark):
    from pyspark.sql import functions as F

    df = spark.range(1).selectExpr("id", "sequence(1, 100) as a", "sequence(1, 100) as b", "sequence(1, 100) as c")
    rows = explode_arrays(df, rows_per_task=5000).select("a", "b", "c", F.spark_partition_id().alias("task"))
    seen = rows.agg(F.count_distinct("a", "b", "c").alias("n"), F.count_distinct("task").alias("tasks")).first()
    assert seen.n == 10**6 and seen.tasks >= 50
    largest = rows.groupBy("task").count().agg(F.max("count")).first()[0]
    assert largest <= 10**6 / 20


def test_a_product_beyond_all_tables_raises(spark):
    df = spark.range(1).select(*(F.expr("sequence(1, 3000000)").alias(name) for name in "abc"))
    with pytest.raises(Exception, match="2\\^63"):
        explode_arrays(df).first()
