import pytest
from pyspark.sql import functions as F

from lettora.functions.text import to_double
from lettora.params import Economics, GridSpec
from lettora.plans.fill import COORDINATE, fill_profile, fill_zipcodes, unmatched_coordinates
from lettora.plans.gold import gold_comparison, gold_long_term, gold_short_term
from lettora.plans.quality import null_counts, profile
from lettora.plans.silver import silver_listings, silver_rentals

MEMBERS = "array<array<array<array<double>>>>"
LISTINGS = "id int, zipcode string, latitude string, longitude string, price string, review_scores_value string, bedrooms string"
GRID = GridSpec(cell=0.05)


def square(left, bottom, size):
    right, top = left + size, bottom + size
    return [[[[left, bottom], [right, bottom], [right, top], [left, top], [left, bottom]]]]


@pytest.fixture
def areas(spark):
    rows = [("1234", square(4.75, 52.0, 0.25)), ("1300", square(5.0, 52.0, 0.25)), ("1234X", square(5.0, 52.0, 0.25))]
    return spark.createDataFrame(rows, f"postcode string, members {MEMBERS}")


@pytest.fixture
def listings(spark):
    rows = [
        (1, "1234AB", "52.1", "4.9", "100", "9", "1"),  # own zipcode; shares its place with 2
        (2, None, "52.1", "4.9", "200", None, "2"),  # filled by place
        (3, "12345", "52.0", "4.75", "300", "8", "3"),  # a corner: no match
        (4, "", "52.125", "5.125", "400", "7", "x"),  # two areas
        (5, "abcdefg", "52.1", "4.9", "500", "6", "1"),  # useless but not missing
        (6, "1999", None, None, "600", "5", "1"),  # no place, own zipcode
        (7, None, None, "4.9", "700", "5", "1"),  # nowhere
        (8, "1234 AB", "52.10", "4.9", "$8", "5", "1"),  # no price; another text for the same place
        (9, None, "52.1", "4.9", "$9", "5", "1"),  # no price
    ]
    return spark.createDataFrame(rows, LISTINGS)


def column(df, name):
    return sorted((row.id, row[name]) for row in df.collect())


def test_fill_zipcodes(listings, areas):
    filled = fill_zipcodes(listings, areas, GRID)
    assert filled.columns[:2] == COORDINATE
    assert filled.columns[-3:] == ["zipcode_formatted", "postcode", "final_zipcode"]
    assert sorted((r.id, r.postcode or "", r.final_zipcode or "") for r in filled.collect()) == [
        (1, "1234", "1234 AB"), (2, "1234", "1234"), (3, "", ""), (4, "1234X", "1234X"), (4, "1300", "1300"),
        (5, "1234", "abcdefg"), (6, "", "1999"), (7, "", ""), (8, "", "1234 AB"), (9, "1234", "1234"),
    ]


def test_fill_first_and_require_digits(listings, areas):
    filled = fill_zipcodes(listings, areas, GRID, on_multiple="first", require_digits=True)
    assert dict(column(filled, "final_zipcode"))[4] == "1234X"
    assert dict(column(filled, "final_zipcode"))[5] == "1234"
    assert filled.count() == 9
    with pytest.raises(ValueError):
        fill_zipcodes(listings, areas, GRID, on_multiple="last")


def test_silver_listings(listings, areas):
    silver = silver_listings(listings, areas, GRID)
    assert column(silver, "postalcode4") == [(1, "1234"), (2, "1234"), (4, "1234"), (4, "1300"), (6, "1999")]
    assert dict(column(silver, "bedrooms"))[1] == 1.0
    assert [r.bedrooms for r in silver.collect() if r.id == 4] == [None, None]
    assert dict(silver.dtypes)["price"] == "double"


def test_silver_listings_dedupe(listings, areas):
    twice = listings.union(listings)
    assert silver_listings(twice, areas, GRID).count() == 10
    assert silver_listings(twice, areas, GRID, dedupe=True).count() == 5


def test_unmatched_coordinates(listings, areas):
    report = {(r.latitude, r.longitude, r.postcode) for r in unmatched_coordinates(listings, areas, GRID).collect()}
    assert report == {
        ("52.1", "4.9", "1234"), ("52.0", "4.75", None), ("52.125", "5.125", "1300"), ("52.125", "5.125", "1234X"),
    }


def test_fill_profile(listings, areas):
    assert fill_profile(listings, areas, GRID).first().asDict() == {
        "missing_listings": 5, "unplaced_listings": 1, "missing_coordinates": 3, "unlocated_coordinates": 1,
        "shared_coordinates": 1, "unlocated_listings": 1, "located_rows": 4,
    }
    nothing = fill_profile(listings.limit(0), areas, GRID).first().asDict()
    assert set(nothing.values()) == {0}


def test_silver_rentals(spark):
    rows = [
        (1, "1234AB", "€ 1200", "50", ["a", "b"], [["z"]]),
        (2, "12349", "€ 1500 Utilities incl.", "sixty", ["a"], [["z"]]),
        (3, "abcd", "€ 1500", "60", ["a"], [["z"]]),
        (4, "5678CD", "$ 1500", "60", ["a"], [["z"]]),
        (5, "5678CD", "€ 0", "60", ["a"], [["z"]]),
        (6, "5678CD", "€ 900", "60", [], [["z"]]),
        (7, " 5678CD ", "€ 950", "60", ["  "], [["z"]]),
    ]
    bronze = spark.createDataFrame(
        rows, "id int, postalCode string, rent string, areaSqm string, seen array<string>, nested array<array<string>>"
    )
    silver = silver_rentals(bronze)
    assert "nested" not in silver.columns
    assert sorted((r.id, r.seen, r.postalcode4, r.monthly_rent, r.utilities_included) for r in silver.collect()) == [
        (1, "a", "1234", 1200.0, False), (1, "b", "1234", 1200.0, False), (2, "a", "1234", 1500.0, True),
        (7, "  ", "5678", 950.0, False),
    ]
    assert dict(column(silver, "area_sqm"))[2] is None
    assert dict(column(silver, "zipcode_formatted"))[2] is None
    assert dict(column(silver_rentals(bronze, trim=True), "seen"))[7] is None
    assert len(silver_rentals(bronze, explode_mode="zip").collect()) == 5
    assert silver_rentals(bronze.union(bronze), dedupe=True).count() == 4


def test_silver_rentals_whose_rent_is_an_array(spark):
    bronze = spark.sql("select '1234AB' as postalCode, array('€ 10', '$ 10', '€ 0') as rent, '5' as areaSqm")
    assert [(r.rent, r.monthly_rent) for r in silver_rentals(bronze).collect()] == [("€ 10", 10.0)]


def test_silver_rentals_without_arrays(spark):
    bronze = spark.createDataFrame([("1234AB", "€ 1200", "50"), ("5678CD", "€ 1500", "60")], "postalCode string, rent string, areaSqm string")
    assert sorted((r.postalcode4, r.monthly_rent, r.area_sqm) for r in silver_rentals(bronze).collect()) == [
        ("1234", 1200.0, 50.0), ("5678", 1500.0, 60.0),
    ]


@pytest.fixture
def gold(spark):
    short = spark.createDataFrame(
        [("1000", 100.0, 9.0, 1.0), ("1000", 101.0, None, 2.0), ("1001", 10.0, 8.0, 1.0), ("1002", 50.0, 7.0, 1.0), ("1003", 50.0, 7.0, 1.0)],
        "postalcode4 string, price double, review_scores_value double, bedrooms double",
    )
    long = spark.createDataFrame(
        [("1000", 1000.0, 50.0), ("1001", 900.0, None), ("1001", 901.0, 61.0), ("1003", 800.0, 40.0), ("1999", 1.0, 1.0)],
        "postalcode4 string, monthly_rent double, area_sqm double",
    )
    return gold_short_term(short), gold_long_term(long)


def test_gold_short_term(gold):
    out = {r.postalcode4: r for r in gold[0].collect()}
    assert gold[0].columns == [
        "postalcode4", "avg_nightly_price", "avg_review_score", "avg_bedrooms", "airbnb_listing_count",
        "est_annual_airbnb_revenue", "airbnb_revenue_rank", "occupancy_rate",
    ]
    assert tuple(out["1000"])[1:] == (100.5, 9.0, 1.5, 2, 18341.25, 1, 0.5)
    assert [out[k].airbnb_revenue_rank for k in ("1002", "1003", "1001")] == [2, 2, 4]


def test_gold_long_term(gold):
    out = {r.postalcode4: tuple(r)[1:] for r in gold[1].collect()}
    assert out == {
        "1000": (1000.0, 50.0, 1, 12000.0, 1), "1001": (900.5, 61.0, 2, 10806.0, 2), "1003": (800.0, 40.0, 1, 9600.0, 3),
        "1999": (1.0, 1.0, 1, 12.0, 4),
    }


def test_gold_comparison(gold):
    comparison = gold_comparison(*gold)
    assert len(comparison.columns) == 18
    out = comparison.select(
        "postalcode4", "revenue_airbnb_minus_rentals", "revenue_ratio", "total_listings", "recommended_strategy", "investment_rank"
    )
    assert [tuple(row) for row in out.collect()] == [
        ("1000", 6341.25, 1.53, 3, "Airbnb (Short-term)", 1), ("1003", -475.0, 0.95, 2, "Kamernet (Long-term)", 2),
        ("1001", -8981.0, 0.17, 3, "Kamernet (Long-term)", 3),
    ]


def test_gold_types(gold):
    assert dict(gold[0].dtypes)["est_annual_airbnb_revenue"] == "double"
    assert dict(gold[0].dtypes)["airbnb_revenue_rank"] == "int"
    assert dict(gold[1].dtypes)["rental_listing_count"] == "bigint"


def test_occupancy_may_be_a_float(spark):
    short = spark.createDataFrame([("1000", 10.0, 9.0, 1.0)], "postalcode4 string, price double, review_scores_value double, bedrooms double")
    row = gold_short_term(short, Economics(occupancy_rate=0.7)).first()
    assert (row.est_annual_airbnb_revenue, row.occupancy_rate) == (2555.0, 0.7)


def test_profile(listings):
    row = profile(
        listings,
        {"no_zip": F.col("zipcode").isNull(), "no_price": to_double(F.col("price")).isNull()},
        {"places": COORDINATE},
    ).first()
    assert row.asDict() == {"row_count": 9, "no_zip": 3, "no_price": 2, "places": 4}
    assert null_counts(listings, ["zipcode", "latitude"]).first().asDict() == {"row_count": 9, "zipcode_nulls": 3, "latitude_nulls": 2}


def test_fill_plan_has_no_python_and_no_pairing_of_everything(listings, areas, plan_text):
    plan = plan_text(silver_listings(listings, areas, GRID))
    assert not any(word in plan for word in ("CartesianProduct", "NestedLoop", "Python", "Pandas"))


def test_silver_listings_read_bronze_twice(spark, listings, areas, tmp_path):
    """Once for the coordinate counts, once for the result; the polygons are parsed once."""
    listings.write.parquet(str(tmp_path / "bronze"))
    reads = spark.sparkContext.accumulator(0)
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    n_rows = bronze.count()

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    silver_listings(bronze.mapInArrow(counted, bronze.schema), areas, GRID).collect()
    assert reads.value == 2 * n_rows
