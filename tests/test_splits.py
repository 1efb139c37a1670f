"""Records across byte ranges, against readers that take a file whole."""

import csv
import json
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from lettora.sources.files import CORRUPT, read_geojson
from lettora.sources.splits import read_csv_records, read_geojson_split


@contextmanager
def ranges_of(spark, size):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    for name, value in zip(names, (size, 1)):
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


@pytest.mark.parametrize("size", [37, 300, 1 << 27])
def test_csv_with_line_breaks(spark, tmp_path, size):
    rng = random.Random(size)
    texts = ["plain", "", 'with "quotes"', "two\nlines", "a\n\n\nb", '"\n"', "comma, comma", "é\r\nü", "x" * 200 + "\n" + "y" * 200]
    files = []
    for name in ("a", "b"):
        rows = [[f"{name}{i}", rng.choice(texts), rng.choice(texts)] for i in range(60)]
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            writer = csv.writer(file, lineterminator="\n" if name == "a" else "\r\n")
            writer.writerows([["id", "the note", "more"], *rows])
        files += rows
    with ranges_of(spark, size):
        df = read_csv_records(spark, str(tmp_path), None, CORRUPT)
        found = sorted((r.id, r["the note"] or "", r.more or "") for r in df.collect())
        assert df.where(F.col(CORRUPT).isNotNull()).count() == 0 and df.columns == ["id", "the note", "more", CORRUPT]
    assert found == sorted(tuple(row) for row in files)


@pytest.mark.parametrize("size", [20, 1 << 27])
def test_csv_escapes_and_corrupt_records(spark, tmp_path, size):
    file = tmp_path / "a.csv"
    file.write_text('id,note\n1,"say \\"yes\\"\nor no"\n2,"x",surplus\n\n3\n4,"ends with \\\\"\n')
    with ranges_of(spark, size):
        rows = {r.id: r for r in read_csv_records(spark, str(file), None, CORRUPT, escape="\\").collect()}
    assert rows["1"].note == 'say "yes"\nor no' and rows["1"][CORRUPT] is None
    assert rows["2"][CORRUPT] == '2,"x",surplus' and rows["3"][CORRUPT] == "3" and rows["4"][CORRUPT] is None
    assert len(rows) == 4


def test_csv_columns_by_schema(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StructType

    file = tmp_path / "a.csv"
    file.write_text('id,note\n1,"a\nb"\n')
    schema = StructType().add("id", IntegerType())
    assert [tuple(r) for r in read_csv_records(spark, str(file), schema).collect()] == [(1, "a\nb")]
    with pytest.raises(ValueError, match="price"):
        read_csv_records(spark, str(file), StructType().add("price", "string"))
    file.write_text("id,note\n")
    assert read_csv_records(spark, str(file)).collect() == []


def collections(rng):
    def feature(i):
        town = rng.choice(["plain", 'a "quoted" } name', "back\\slash", "{[", "é\n", 'ends in \\"', "]}"])
        ring = [[rng.random() for _ in range(2)] for _ in range(rng.randint(3, 30))]
        return {"type": "Feature", "properties": {"pc4_code": str(i), "town": town}, "geometry": {"type": "Polygon", "coordinates": [ring]}}

    for indent in (None, 1):
        head = {"type": "FeatureCollection", "name": 'all } "areas"', "crs": {"type": "name", "properties": {"name": "x}"}}}
        yield json.dumps(head | {"features": [feature(i) for i in range(40)], "bbox": [1, 2], "others": [{"type": "note"}]}, indent=indent)
    yield json.dumps({"features": [], "type": "FeatureCollection"})


def plain(row):
    f = row.f
    return f.type, sorted(f.properties.items()), f.geometry.type, json.loads(f.geometry.coordinates)


@pytest.mark.parametrize("size", [50, 1000, 1 << 27])
def test_geojson_in_byte_ranges(spark, tmp_path, size):
    for n, text in enumerate(collections(random.Random(1))):
        (tmp_path / f"{n}.geojson").write_text(text)
    whole = read_geojson(spark, str(tmp_path)).select(F.explode("features").alias("f"))
    with ranges_of(spark, size):
        split = read_geojson_split(spark, str(tmp_path)).select(F.explode("features").alias("f"))
        found = sorted(map(plain, split.collect()))
        if size == 1000:
            assert split.select(F.spark_partition_id()).distinct().count() >= 8
    assert found == sorted(map(plain, whole.collect())) and len(found) == 80


def test_a_damaged_feature_raises(spark, tmp_path):
    file = tmp_path / "a.geojson"
    file.write_text('{"features": [{"type": "Feature", "properties": 7 8}]}')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_geojson_split(spark, str(file)).collect()


def test_ranges_of_the_queries_do_not_grow_in_number(spark, tmp_path):
    from parity.queries import LEAST_RANGE, _several_ranges

    tasks = spark.sparkContext.defaultParallelism
    setting = "spark.sql.files.maxPartitionBytes"
    for total in (1000, 8 * tasks * LEAST_RANGE, 80 * tasks * LEAST_RANGE):
        folder = tmp_path / str(total)
        folder.mkdir()
        for part in range(2):
            (folder / f"{part}.txt").write_bytes(b"x" * (total // 2))
        with _several_ranges(spark, str(folder)):
            assert max(LEAST_RANGE, total // (8 * tasks)) == int(spark.conf.get(setting))
