import json
import os

import pytest
from pyspark.sql.types import StructType

from lettora.params import GridSpec, RawFiles, SilverOptions, TableNames
from lettora.plans import jobs
from lettora.sinks.tables import overwrite_table
from lettora.sources.files import (
    CORRUPT,
    LISTINGS_SCHEMA,
    RENTAL_ARRAYS,
    RENTALS_SCHEMA,
    raw_path,
    read_csv,
    read_geojson,
    read_geojson_lines,
)
from lettora.sources.shared import cleaned, fresh_path, shared_folder, written
from lettora.sources.variants import read_json_any


@pytest.fixture
def database(spark, tmp_path):
    name = "db_" + tmp_path.name.replace("-", "_")
    spark.sql(f"create database {name} location '{tmp_path}/tables'")
    yield name
    spark.sql(f"drop database {name} cascade")


def test_raw_path():
    assert raw_path("abc://x/raw/", "a.csv") == raw_path("abc://x/raw", "a.csv") == "abc://x/raw/a.csv"


def test_table_names():
    names = TableNames().under("main", "b", "s", "g")
    assert names.bronze_rentals == "main.b.bronze_rentals"
    assert names.gold_comparison == "main.g.gold_investment_comparison"
    assert TableNames().under(None, "b", "s", "g").silver_listings == "s.silver_airbnb"


def test_csv_columns_are_strings(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("zipcode,latitude,longitude,price,review_scores_value,bedrooms\n1234AB,52.1,4.9,100,,2\n")
    assert {kind for _, kind in read_csv(spark, str(file)).dtypes} == {"string"}
    row = read_csv(spark, str(file), LISTINGS_SCHEMA).first()
    assert (row.zipcode, row.price, row.review_scores_value) == ("1234AB", "100", None)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text(
        "id,price,zipcode,latitude,longitude,bedrooms,review_scores_value,note\n"
        "7,100,9876ZY,51.5,5.5,2,9,x\n8,200,9876ZX,51.5,5.5,2,9,x,surplus\n9,300\n"
    )
    rows = read_csv(spark, str(file), LISTINGS_SCHEMA, CORRUPT).collect()
    assert (rows[0].id, rows[0].zipcode, rows[0].latitude, rows[0].price, rows[0].note) == ("7", "9876ZY", "51.5", "100", "x")
    assert [r[CORRUPT] for r in rows] == [None, "8,200,9876ZX,51.5,5.5,2,9,x,surplus", "9,300"]
    file.write_text("id,price\n1,2\n")
    with pytest.raises(ValueError, match="zipcode"):
        read_csv(spark, str(file), LISTINGS_SCHEMA)


def collection(ring, **properties):
    shape = {"type": "Polygon", "coordinates": [ring]}
    return {"type": "FeatureCollection", "name": "areas", "features": [{"type": "Feature", "properties": properties, "geometry": shape}]}


RING = [[5.0, 51.0], [6.0, 51.0], [6.0, 51.8], [5.0, 51.8], [5.0, 51.0]]


def test_geojson_keeps_all_properties_and_reports_damage(spark, tmp_path, database):
    file = tmp_path / "areas.geojson"
    text = json.dumps(collection(RING, pc4_code="9876", town="Xyz", size=3), indent=1)
    file.write_text(text)
    row = read_geojson(spark, str(file)).first()
    assert row.name == "areas" and row.features[0].type == "Feature"
    assert row.features[0].properties == {"pc4_code": "9876", "town": "Xyz", "size": "3"}
    file.write_text(text[: len(text) // 2])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_geojson(spark, str(file)).collect()
    broken = collection(RING, pc4_code="1")
    broken["features"].append({"properties": {"pc4_code": "2"}, "geometry": {"type": "Polygon", "coordinates": "none"}})
    file.write_text(json.dumps(broken))
    assert jobs.ingest_postcodes(spark, str(file), f"{database}.p").checks == {"features": 2, "unreadable_features": 1}


def test_geojson_lines(spark, tmp_path, database):
    file = tmp_path / "areas.jsonl"
    feature = collection(RING, pc4_code="9876", town="Xyz")["features"][0]
    file.write_text("\n".join([json.dumps(feature)] * 3))
    rows = read_geojson_lines(spark, str(file)).collect()
    assert len(rows) == 3 and rows[0].features[0].properties["town"] == "Xyz"
    assert jobs.ingest_postcodes(spark, str(file), f"{database}.p", lines=True).checks["features"] == 3
    file.write_text(json.dumps(feature)[:50])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_geojson_lines(spark, str(file)).collect()


def test_cleaned_deletes_what_was_written_inside(spark):
    before = written(spark.range(3), "kept")
    with cleaned(spark):
        written(spark.range(3), "gone")
        inside = fresh_path(spark, "gone")
        spark.range(1).write.parquet(inside)
    assert before.count() == 3 and not os.path.exists(inside)


def test_overwrite_counts_and_replaces_schema(spark, database):
    name = f"{database}.t"
    first = overwrite_table(spark.range(10), name)
    assert (first.table, first.row_count, first.column_count) == (name, 10, 1)
    second = overwrite_table(spark.range(3).selectExpr("id", "'x' as other"), name, merge_schema=True)
    assert (second.row_count, second.column_count) == (3, 2)
    assert spark.table(name).columns == ["id", "other"]


def test_overwrite_of_nothing_and_partitioned(spark, database):
    assert overwrite_table(spark.range(0), f"{database}.none").row_count == 0
    parts = spark.range(10).selectExpr("id", "id % 2 as p")
    assert overwrite_table(parts, f"{database}.parts", partition_by=["p"]).row_count == 10
    assert spark.table(f"{database}.parts").where("p = 1").count() == 5


def test_a_plan_may_read_the_table_it_replaces(spark, database):
    overwrite_table(spark.range(10), f"{database}.t")
    overwrite_table(spark.table(f"{database}.t").selectExpr("id * 2 as twice"), f"{database}.t")
    assert sorted(r.twice for r in spark.table(f"{database}.t").collect()) == list(range(0, 20, 2))


def failing(spark):
    """Rows that raise half-way."""
    return spark.range(0, 1000, 1, 4).selectExpr("if(id = 700, raise_error('broken row'), id) as other")


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("partition_by", [None, ["p"]])
def test_a_failed_overwrite_leaves_the_old_table(spark, database, tmp_path, external, partition_by):
    name, path = f"{database}.t", str(tmp_path / "elsewhere") if external else None
    rows = spark.range(10).selectExpr("id", "cast(id % 2 as string) as p")
    overwrite_table(rows, name, path=path, partition_by=partition_by)
    with pytest.raises(Exception, match="broken row"):
        overwrite_table(failing(spark), name, merge_schema=True, path=path)
    assert sorted(tuple(r) for r in spark.table(name).select("id", "p").collect()) == [(i, str(i % 2)) for i in range(10)]
    assert overwrite_table(rows.where("id > 3"), name, path=path, partition_by=partition_by).row_count == 6
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 6 and spark.table(name).where("p = '1'").count() == 3
    left = [t.name for t in spark.catalog.listTables(database)]
    assert left == ["t"]
    assert sorted(os.listdir(tmp_path)) == (["elsewhere", "tables"] if external else ["tables"])


def test_a_failed_swap_puts_the_old_table_back(spark, database, tmp_path, monkeypatch):
    from lettora.sinks import tables

    for path in (None, str(tmp_path / "elsewhere")):
        name = f"{database}.{'external' if path else 'managed'}"
        overwrite_table(spark.range(10), name, path=path)
        renamed = tables._rename

        def broken(session, old, new):
            if "staged" in old:
                raise RuntimeError("lost the catalog")
            renamed(session, old, new)

        with monkeypatch.context() as patch:
            patch.setattr(tables, "_rename", broken)
            if path:
                patch.setattr(tables, "_move", lambda session, old, new, move=tables._move: "staged" not in old and move(session, old, new))
            with pytest.raises(RuntimeError):
                overwrite_table(spark.range(3), name, path=path)
        spark.catalog.refreshTable(name)
        assert spark.table(name).count() == 10


def test_json_of_any_shape(spark, tmp_path, database):
    file = tmp_path / "a.json"
    lines = [
        '{"_id": ["a", "b"], "rent": "x", "n": 1, "o": {"p": 1, "q r": [1.5]}, "we`ird": true, "mix": [1, 2]}',
        '{"_id": "c", "rent": null, "n": 2.5, "tags": ["t"], "mix": "x", "z": {"k": 1}, "big": 12345678901234567890}',
        '{"_id": [1], broken',
        "",
        '{"_id": null, "n": "text", "mix": {"a": 1}, "z": 5, "none": null, "empty": {}}',
        "[1, 2]",
        "7",
        '{"a": 1, "a": 2}',
    ]
    file.write_text("\n".join(lines))
    rows = read_json_any(spark, str(file))
    kinds = dict(rows.dtypes)
    assert kinds["_id"] == kinds["mix"] == kinds["tags"] == "array<string>" and kinds["n"] == kinds["z"] == "string"
    assert kinds["o"] == "struct<p:bigint,q r:array<double>>" and kinds["we`ird"] == "boolean" and kinds["big"] == "double"
    found = sorted((r for r in rows.collect() if r[CORRUPT] is None), key=lambda r: r.n)
    assert [r._id for r in found] == [["a", "b"], ["c"], None]
    assert [r.mix for r in found] == [["1", "2"], ["x"], ['{"a":1}']]
    assert [r.n for r in found] == ["1", "2.5", "text"] and [r.z for r in found] == [None, '{"k":1}', "5"]
    assert found[0].o["q r"] == [1.5] and found[2].none is None and found[2].empty == "{}"
    assert sorted(r[CORRUPT] for r in rows.collect() if r[CORRUPT]) == ["7", "[1,2]", '{"_id": [1], broken', '{"a": 1, "a": 2}']
    assert jobs.ingest_rentals(spark, str(file), f"{database}.r").checks == {"corrupt_rows": 4}
    file.write_text("")
    assert read_json_any(spark, str(file)).collect() == []
    file.write_text("nothing\nreadable")
    assert jobs.ingest_rentals(spark, str(file), f"{database}.r").checks == {"corrupt_rows": 2}


def test_a_schema_never_hides_a_value(spark, tmp_path, database):
    file = tmp_path / "a.json"
    file.write_text('{"_id": ["a"], "rent": "1"}\n{"_id": "b", "rent": "2"}\n{"_id": ["c"')
    schema = StructType([f for f in RENTALS_SCHEMA if f.name in ("_id", "rent")])
    assert jobs.ingest_rentals(spark, str(file), f"{database}.r", schema).checks == {"corrupt_rows": 2}
    kept = {r.rent: r[CORRUPT] for r in spark.table(f"{database}.r").collect()}
    assert kept == {"1": None, "2": '{"_id": "b", "rent": "2"}', None: '{"_id": ["c"'}


def test_default_ingest_counts_corrupt_csv_rows(spark, tmp_path, database):
    file = tmp_path / "a.csv"
    file.write_text("zipcode,price,note\n1234AB,1,x\n1234AB,2,x,surplus\n1234AB\n")
    assert jobs.ingest_listings(spark, str(file), f"{database}.l").checks == {"corrupt_rows": 2}
    kept = sorted(r[CORRUPT] or "" for r in spark.table(f"{database}.l").collect())
    assert kept == ["", "1234AB", "1234AB,2,x,surplus"]


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert written(spark.range(5), "five").count() == 5


def test_all_jobs(spark, tmp_path, database):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "airbnb.csv").write_text(
        "zipcode,latitude,longitude,price,review_scores_value,bedrooms\n"
        "9876ZY,51.4,5.5,100,9,1\n,51.4,5.5,200,8,2\n,60,5.5,300,8,2\n"
    )
    rentals = [
        {"_id": ["a"], "postalCode": "9876ZX", "rent": "€ 1300", "areaSqm": "45"},
        {"_id": ["b", "c"], "postalCode": "4321QR", "rent": "€ 900", "areaSqm": "30"},
    ]
    (raw / "rentals.json").write_text("\n".join(map(json.dumps, rentals)))
    (raw / "post_codes.geojson").write_text(json.dumps(collection(RING, pc4_code="9876"), indent=1))
    rentals_schema = StructType([f for f in RENTALS_SCHEMA if f.name not in RENTAL_ARRAYS[1:]])

    files = RawFiles(f"{raw}/", str(raw), str(raw))
    tables = TableNames().under(None, database, database, database)
    counts = lambda metrics: [(m.row_count, m.column_count) for m in metrics]
    # Lines and rows that cannot be read have a column of their own.
    assert counts(jobs.raw_to_bronze(spark, files, tables, rentals_schema=rentals_schema)) == [(2, 5), (3, 7), (1, 3)]
    assert counts(jobs.raw_to_bronze(spark, files, tables, LISTINGS_SCHEMA)) == [(2, 5), (3, 7), (1, 3)]
    options = SilverOptions(grid=GridSpec(0.05), report=True)
    made = set(os.listdir(shared_folder(spark)))
    metrics = jobs.bronze_to_silver(spark, tables, options)
    assert set(os.listdir(shared_folder(spark))) == made
    assert counts(metrics) == [(2, 10), (3, 9)]
    assert metrics[0].checks["missing_listings"] == 2 and metrics[0].checks["unlocated_listings"] == 1
    assert metrics[1].checks == {"rows_in": 2, "rows_out": 3, "rows_lost": 0}
    assert counts(jobs.silver_to_gold(spark, tables)) == [(1, 8), (2, 6), (1, 18)]
    row = spark.table(tables.gold_comparison).first()
    assert (row.postalcode4, row.avg_nightly_price, row.est_annual_airbnb_revenue) == ("9876", 150.0, 27375.0)
    assert (row.est_annual_rental_revenue, row.revenue_airbnb_minus_rentals, row.revenue_ratio) == (15600.0, 11775.0, 1.75)
    # A second run replaces everything.
    assert counts(jobs.bronze_to_silver(spark, tables, options)) == [(2, 10), (3, 9)]


def test_the_report_is_that_of_the_run(spark, tmp_path, database):
    """Options that change what is filled and exploded change the report with it."""
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "airbnb.csv").write_text("zipcode,latitude,longitude,price,review_scores_value,bedrooms\nabcdef,51.4,5.5,100,9,1\n" * 1 + "abcdef,51.4,5.5,100,9,1\n")
    (raw / "rentals.json").write_text('{"_id": ["a", "b"], "t": ["x", "y", "z"], "postalCode": "1234AB", "rent": "€ 9", "areaSqm": "7"}\n{"_id": ["a"], "postalCode": "?", "rent": "€ 9"}')
    areas = collection(RING, pc4_code="9876")
    areas["features"] *= 2
    (raw / "post_codes.geojson").write_text(json.dumps(areas))
    tables = TableNames().under(None, database, database, database)
    jobs.raw_to_bronze(spark, RawFiles(str(raw), str(raw), str(raw)), tables)

    def report(**options):
        listings, rentals = jobs.bronze_to_silver(spark, tables, SilverOptions(grid=GridSpec(0.05), report=True, **options))
        return listings.checks["missing_listings"], listings.checks["located_rows"], rentals.checks, rentals.row_count

    assert report() == (0, 0, {"rows_in": 1, "rows_out": 6, "rows_lost": 0}, 6)
    assert report(require_digits=True)[:2] == (2, 4)
    assert report(require_digits=True, on_multiple="first")[:2] == (2, 2)
    assert report(explode_mode="zip")[2:] == ({"rows_in": 1, "rows_out": 3, "rows_lost": 0}, 3)


def test_one_line_of_each_kind_says_as_much_as_all(spark, tmp_path):
    """Types are merged over a few lines, however many there are; rare types and names are among them."""
    from lettora.sources.variants import json_fields, one_of_each_kind, read_json_variants

    file = tmp_path / "a.json"
    lines = [f'{{"n": {i}, "t": "x{i}", "a": {"[1]" if i % 3 else i}, "o": {{"p": {i}}}, "none": null}}' for i in range(500)]
    lines += ['{"n": "text", "it\'s": 1}', '{"n": 1.25, "o": {"q": [true]}}', '{"a": ["x"], "": 2}', "{}", "broken"]
    file.write_text("\n".join(lines))
    stored = written(read_json_variants(spark, str(file)), "lines")
    few = one_of_each_kind(stored)
    assert few.count() <= 30
    fields = json_fields(few)
    assert fields == json_fields(stored)
    rows = read_json_any(spark, str(file))
    assert sorted(rows.columns) == sorted([*(f.name for f in fields), CORRUPT])
    assert sorted(r.a for r in rows.collect() if r.a)[-1] == ["x"] and [r["it's"] for r in rows.collect() if r["it's"]] == [1]
