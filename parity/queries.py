"""One query per operator or group of operators, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from lettora.functions import geojson, text
from lettora.functions.geometry import inside_any, member_edges
from lettora.operators.arrays import explode_arrays, explosion_report
from lettora.operators.columns import drop_type, flatten_structs, null_strings_to, preview, trim_strings, value_rows
from lettora.operators.distinct import distinct_keys, distinct_rows
from lettora.operators.ranking import global_rank
from lettora.operators.spatial import as_points, containing_polygons, postcode_polygons
from lettora.params import Economics, GridSpec, RawFiles, SilverOptions, SkewLimits, TableNames
from lettora.plans import jobs, silver
from lettora.plans.fill import (
    COORDINATE,
    fill_profile,
    fill_zipcodes,
    missing_coordinates,
    unmatched_coordinates,
    with_formatted_zipcode,
)
from lettora.plans.gold import gold_comparison, gold_long_term, gold_short_term
from lettora.plans.quality import null_counts, profile
from lettora.plans.silver import silver_listings, silver_rentals
from lettora.sinks.tables import WriteMetrics, overwrite_table
from lettora.sources.files import CORRUPT, LISTINGS_SCHEMA, read_csv, read_geojson, read_geojson_lines, read_json_lines
from lettora.sources.shared import content_bytes, fresh_path, written
from lettora.sources.splits import read_csv_records, read_geojson_split
from lettora.sources.variants import read_json_any
from parity import inputs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# The areas are about one unit wide; half a unit is a good cell and saves measuring them.
GRID = GridSpec(cell=0.5)


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def polygons(spark: SparkSession, folder: str) -> DataFrame:
    return postcode_polygons(inputs.postcode_collections(spark, folder))


# --- text functions ---------------------------------------------------------------------------------------------------


@query
def zipcode_format(spark: SparkSession, folder: str) -> DataFrame:
    codes = inputs.rentals(spark, folder, arrays=False)
    return codes.select(
        "order_id",
        "line_no",
        F.length("postalCode").alias("code_length"),
        text.format_zipcode(F.col("postalCode")).alias("zipcode_formatted"),
    )


@query
def pc4_extract(spark: SparkSession, folder: str) -> DataFrame:
    codes = inputs.rentals(spark, folder, arrays=False)
    return codes.select("order_id", "line_no", text.pc4(F.col("postalCode")).alias("postalcode4")).where(
        F.col("postalcode4") != ""
    )


@query
def rent_parse(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.rentals(spark, folder, arrays=False).select(
        "order_id",
        "line_no",
        text.rent_amount(F.col("rent")).alias("monthly_rent"),
        text.area_amount(F.col("areaSqm")).alias("area_sqm"),
        text.utilities_included(F.col("rent")).alias("utilities_included"),
    )


@query
def null_fill_unknown(spark: SparkSession, folder: str) -> DataFrame:
    return null_strings_to(inputs.listings(spark, folder))


@query
def trim_blank_to_null(spark: SparkSession, folder: str) -> DataFrame:
    return trim_strings(inputs.listings(spark, folder))


# --- filters, projections, arrays -------------------------------------------------------------------------------------


@query
def valid_listings(spark: SparkSession, folder: str) -> DataFrame:
    listings = inputs.listings(spark, folder)
    return listings.select(
        "listing_id",
        text.pc4(F.col("zipcode")).alias("postalcode4"),
        text.to_double(F.col("price")).alias("price"),
        text.to_double(F.col("bedrooms")).alias("bedrooms"),
        text.to_double(F.col("review_scores_value")).alias("review_scores_value"),
    ).where((F.col("postalcode4") != "") & F.col("price").isNotNull())


@query
def without_any_null(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.listings(spark, folder).na.drop()


@query
def struct_flatten(spark: SparkSession, folder: str) -> DataFrame:
    nested = inputs.listings(spark, folder).select(
        "listing_id",
        F.struct("zipcode", F.struct("latitude", "longitude").alias("point")).alias("place"),
        F.struct("price").alias("offer"),
    )
    return flatten_structs(nested)


@query
def explode_chain(spark: SparkSession, folder: str) -> DataFrame:
    return explode_arrays(inputs.rentals(spark, folder).select("order_id", "line_no", "crawledAt", "firstSeenAt"))


@query
def explode_zip(spark: SparkSession, folder: str) -> DataFrame:
    rentals = inputs.rentals(spark, folder).select("order_id", "line_no", "crawledAt", "firstSeenAt")
    return explode_arrays(rentals, "zip")


@query
def explode_row_growth(spark: SparkSession, folder: str) -> DataFrame:
    return explosion_report(inputs.rentals(spark, folder))


@query
def rows_with_value(spark: SparkSession, folder: str) -> DataFrame:
    return value_rows(inputs.listings(spark, folder), "bedrooms", "3").select("listing_id", "bedrooms")


@query
def listings_preview(spark: SparkSession, folder: str) -> DataFrame:
    return preview(inputs.listings(spark, folder), 25, ["listing_id"])


@query
def columns_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return drop_type(inputs.rentals(spark, folder), ArrayType)


# --- duplicates -------------------------------------------------------------------------------------------------------


@query
def distinct_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_keys(inputs.listings(spark, folder), COORDINATE)


@query
def distinct_offers(spark: SparkSession, folder: str) -> DataFrame:
    rentals = inputs.rentals(spark, folder, arrays=False)
    return distinct_rows(rentals.select("postalCode", "areaSqm"))


# --- space ------------------------------------------------------------------------------------------------------------


@query
def geojson_polygons(spark: SparkSession, folder: str) -> DataFrame:
    """Areas written as GeoJSON and read back: positions of each ring by postcode and kind of corner."""
    areas = postcode_polygons(read_geojson(spark, inputs.geojson_files(spark, folder)))
    rings = areas.select("postcode", F.size("members").alias("members"), F.explode(F.flatten("members")).alias("ring"))
    positions = rings.select("postcode", "members", F.size("ring").alias("ring_size"), F.explode("ring").alias("at"))
    return positions.select(
        "postcode", "members", "ring_size", F.round(F.col("at")[0], 6).alias("x"), F.round(F.col("at")[1], 6).alias("y")
    )


@query
def geojson_one_file(spark: SparkSession, folder: str) -> DataFrame:
    """``geojson_polygons`` from one file of all areas, read in byte ranges."""
    file = inputs.geojson_file(spark, folder)
    with _several_ranges(spark, file):
        areas = postcode_polygons(read_geojson_split(spark, file))
        rings = areas.select("postcode", F.size("members").alias("members"), F.explode(F.flatten("members")).alias("ring"))
        positions = rings.select("postcode", "members", F.size("ring").alias("ring_size"), F.explode("ring").alias("at"))
        at = [F.round(F.col("at")[axis], 6).alias(name) for axis, name in enumerate(("x", "y"))]
        return written(positions.select("postcode", "members", "ring_size", *at), "positions")


LEAST_RANGE = 65536


def _range_bytes(total: int, tasks: int, most: int) -> int:
    """The size of byte ranges: several per task, but of at least 64 kB, and at most as large as they would be anyway."""
    return max(LEAST_RANGE, min(most, total // (8 * tasks)))


@contextmanager
def _several_ranges(spark: SparkSession, path: str) -> Iterator[None]:
    """Small byte ranges where files are small, so that those of the smallest tables have several; their number does not
    grow with the files, until they are as large as ranges are by the session's own setting."""
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    bytes_per_range = _range_bytes(content_bytes(spark, path), spark.sparkContext.defaultParallelism, most)
    names = {"spark.sql.files.maxPartitionBytes": bytes_per_range, "spark.sql.files.openCostInBytes": 1}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


@query
def geojson_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Areas read as one feature per line: corners of the bounding box of each."""
    areas = postcode_polygons(read_geojson_lines(spark, inputs.geojson_line_files(spark, folder)))
    edges = areas.selectExpr("postcode", f"flatten({member_edges('members')}) as edges")
    return edges.selectExpr(
        "postcode",
        "round(array_min(edges.ylo), 6) as bottom",
        "round(array_max(edges.yhi), 6) as top",
        "round(least(array_min(edges.xlo), array_min(edges.xhi)), 6) as left_side",
    )


@query
def geojson_inferred_schema(spark: SparkSession, folder: str) -> DataFrame:
    """The same through an inferred schema, which leaves quotes to repair; also the repair on JSON text."""
    areas = read_geojson(spark, inputs.geojson_files(spark, folder), schema=None)
    feature = areas.select(F.explode("features").alias("feature")).select(
        F.col("feature.properties.pc4_code").cast("string").alias("postcode"),
        F.col("feature.geometry").alias("geometry"),
    )
    repaired = geojson.unquote_numbers(geojson.unquote_arrays(geojson.geometry_json(F.col("geometry"))))
    parts = F.from_json("geometry", "type string, coordinates string")
    members = geojson.polygon_members(F.col("geometry.type"), F.col("geometry.coordinates"))
    # One step per column, so that the repaired text is made once per feature.
    return (
        feature.select("postcode", repaired.alias("geometry"))
        .select("postcode", parts.alias("geometry"))
        .select("postcode", F.col("geometry.type").alias("kind"), members.alias("members"))
        .selectExpr("postcode", "kind", "aggregate(flatten(members), 0, (n, ring) -> n + size(ring)) as positions")
    )


@query
def contains_test(spark: SparkSession, folder: str) -> DataFrame:
    """Centre and a point off centre of every area against its own polygon."""
    areas = inputs.area_features(spark, folder).select(
        "owner", geojson.polygon_members(F.col("type"), F.col("coordinates")).alias("members")
    )
    mids = inputs.areas(spark, folder).select("owner", "mid_x", "mid_y")
    # Both come from the same rows of one table, by its key.
    edges = areas.join(mids, "owner").selectExpr("owner", "mid_x", "mid_y", f"{member_edges('members')} as edges")
    return edges.selectExpr(
        "owner",
        f"{inside_any('mid_x', 'mid_y', 'edges')} as centre_inside",
        f"{inside_any('(mid_x + 0.26D)', '(mid_y - 0.13D)', 'edges')} as off_centre_inside",
    )


@query
def point_in_polygon(spark: SparkSession, folder: str) -> DataFrame:
    points = as_points(distinct_keys(inputs.listings(spark, folder), COORDINATE))
    return containing_polygons(points, polygons(spark, folder), GRID).select("latitude", "longitude", "postcode")


@query
def point_in_polygon_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The same when the polygon side is too large to broadcast, with a low bound for hot cells."""
    points = as_points(distinct_keys(inputs.listings(spark, folder), COORDINATE))
    return containing_polygons(
        points, polygons(spark, folder), GridSpec(cell=0.5, broadcast_bytes=0), SkewLimits(rows_per_task=4)
    ).select("latitude", "longitude", "postcode")


@query
def point_in_polygon_default_grid(spark: SparkSession, folder: str) -> DataFrame:
    """The same with cells sized by each polygon."""
    points = as_points(distinct_keys(inputs.listings(spark, folder), COORDINATE))
    return containing_polygons(points, polygons(spark, folder)).select("latitude", "longitude", "postcode")


@query
def zipcode_fill(spark: SparkSession, folder: str) -> DataFrame:
    filled = fill_zipcodes(inputs.listings(spark, folder), polygons(spark, folder), GRID)
    return filled.select("listing_id", "latitude", "longitude", "zipcode_formatted", "postcode", "final_zipcode")


@query
def zipcode_fill_first(spark: SparkSession, folder: str) -> DataFrame:
    filled = fill_zipcodes(
        inputs.listings(spark, folder), polygons(spark, folder), GRID, on_multiple="first", require_digits=True
    )
    return filled.select("listing_id", "postcode", "final_zipcode")


@query
def unmatched_coordinate_report(spark: SparkSession, folder: str) -> DataFrame:
    return unmatched_coordinates(inputs.listings(spark, folder), polygons(spark, folder), GRID)


@query
def zipcode_fill_profile(spark: SparkSession, folder: str) -> DataFrame:
    return fill_profile(inputs.listings(spark, folder), polygons(spark, folder), GRID)


# --- silver and gold --------------------------------------------------------------------------------------------------


def _silver_listings(spark: SparkSession, folder: str, **options) -> DataFrame:
    return silver_listings(inputs.listings(spark, folder), polygons(spark, folder), GRID, **options)


@query
def silver_listing_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _silver_listings(spark, folder)


@query
def silver_listing_rows_deduped(spark: SparkSession, folder: str) -> DataFrame:
    # Without its id a listing can be an exact copy of another one.
    listings = inputs.listings(spark, folder).drop("listing_id", "host_note")
    coarse = F.expr("case when price = '$bad' then price else cast(cast(floor(cast(price as double) / 100000) as bigint) as string) end")
    listings = listings.withColumn("price", coarse)
    return silver_listings(listings, polygons(spark, folder), GRID, dedupe=True)


@query
def silver_rental_rows(spark: SparkSession, folder: str) -> DataFrame:
    return silver_rentals(inputs.rentals(spark, folder))


@query
def gold_short_term_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold_short_term(_silver_listings(spark, folder))


@query
def gold_short_term_extremes(spark: SparkSession, folder: str) -> DataFrame:
    """Prices that are no finite number, or too large for an exact sum, count in averages and revenues."""
    price = f"case when listing_id % 97 = 0 then 'NaN' when listing_id % 89 = 0 then 'Infinity' when listing_id % 83 = 0 then '{2**100}' else price end"
    listings = inputs.listings(spark, folder).withColumn("price", F.expr(price)).withColumn("final_zipcode", F.col("zipcode"))
    summary = gold_short_term(silver.valid_listings(listings))
    # NaN is not equal to itself, so it is shown as a flag.
    nan = F.isnan("avg_nightly_price")
    shown = {n: F.when(~nan, F.col(n)) for n in ("avg_nightly_price", "est_annual_airbnb_revenue")}
    return summary.withColumn("not_a_number", F.coalesce(nan, F.lit(False))).withColumns(shown)


@query
def gold_exact_tiny(spark: SparkSession, folder: str) -> DataFrame:
    """Prices just below and above a rounding tie, among prices of other magnitudes: averaged to the last digit."""
    listings = inputs.read(spark, folder, "orders").select(
        F.expr(inputs.TINY["postalcode4"]).alias("postalcode4"),
        F.expr(inputs.TINY["price"]).cast("double").alias("price"),
        *(F.lit(None).cast("double").alias(name) for name in ("review_scores_value", "bedrooms")),
    )
    return gold_short_term(listings).select("postalcode4", "avg_nightly_price", "airbnb_listing_count")


@query
def gold_long_term_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold_long_term(silver_rentals(inputs.rentals(spark, folder)))


@query
def gold_investment_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return gold_comparison(gold_short_term_summary(spark, folder), gold_long_term_summary(spark, folder))


@query
def gold_comparison_other_economics(spark: SparkSession, folder: str) -> DataFrame:
    economics = Economics(occupancy_rate=0.7, days_per_year=360, months_per_year=11)
    return gold_comparison(
        gold_short_term(_silver_listings(spark, folder), economics),
        gold_long_term(silver_rentals(inputs.rentals(spark, folder)), economics),
    )


@query
def global_rank_two_step(spark: SparkSession, folder: str) -> DataFrame:
    """Rank of all lineitems by price, with NULLs and with ties of a seventh of the rows."""
    value = F.expr("case when l_linenumber = 7 then null when l_linenumber = 6 then 1000 else l_extendedprice end")
    items = inputs.read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", value.alias("price"))
    return global_rank(items, "price", "price_rank")


# --- quality ----------------------------------------------------------------------------------------------------------


@query
def quality_profile(spark: SparkSession, folder: str) -> DataFrame:
    listings = with_formatted_zipcode(inputs.listings(spark, folder))
    return profile(
        listings,
        {
            "zipcode_nulls": F.col("zipcode").isNull(),
            "formatted_nulls": F.col("zipcode_formatted").isNull(),
            "price_unreadable": text.to_double(F.col("price")).isNull(),
            "three_bedrooms": F.col("bedrooms") == "3",
        },
        {"distinct_coordinates": COORDINATE},
    )


@query
def missing_coordinate_profile(spark: SparkSession, folder: str) -> DataFrame:
    listings = with_formatted_zipcode(inputs.listings(spark, folder))
    return profile(missing_coordinates(listings))


@query
def null_count_profile(spark: SparkSession, folder: str) -> DataFrame:
    return null_counts(inputs.listings(spark, folder), ["zipcode", "latitude", "review_scores_value"])


# --- sources, sinks, jobs ---------------------------------------------------------------------------------------------


def _table_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:12]}"


@query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Listings through a CSV file; blank texts and NULL both come back as NULL."""
    return read_csv(spark, inputs.listings_csv(spark, folder))


@query
def csv_line_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Listings with line breaks and quotes in a text, read in byte ranges. No record is corrupt."""
    files = inputs.listings_csv_with_breaks(spark, folder)
    with _several_ranges(spark, files):
        rows = read_csv_records(spark, files, LISTINGS_SCHEMA, CORRUPT)
        return written(rows.select("listing_id", "zipcode", "price", "host_note", F.col(CORRUPT).isNotNull().alias("corrupt")), "breaks")


@query
def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return read_json_lines(spark, inputs.rentals_json(spark, folder), _rentals_schema())


def _rentals_schema() -> StructType:
    kinds = {"order_id": LongType(), "line_no": LongType()} | {n: ArrayType(StringType()) for n in inputs.RENTAL_ARRAYS}
    names = [*inputs.RENTALS, *inputs.RENTAL_ARRAYS]
    return StructType([StructField(name, kinds.get(name, StringType())) for name in names])


@query
def csv_with_schema(spark: SparkSession, folder: str) -> DataFrame:
    """A schema in another order than the file, which also has more columns: found by name. No row is corrupt."""
    rows = read_csv(spark, inputs.listings_csv(spark, folder), LISTINGS_SCHEMA, CORRUPT)
    return rows.select("listing_id", *LISTINGS_SCHEMA.names, F.col(CORRUPT).isNotNull().alias("corrupt"))


@query
def table_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A table written twice with different columns: the new schema wins. Metrics of the writes come along."""
    name, rentals = _table_name("rentals"), inputs.rentals(spark, folder, arrays=False)
    first = overwrite_table(rentals.select("order_id"), name, path=fresh_path(spark, name))
    second = overwrite_table(
        rentals.select("order_id", "line_no", "rent"), name, merge_schema=True, path=fresh_path(spark, name)
    )
    rows = spark.table(name).select(
        "*",
        F.lit(first.column_count).alias("columns_before"),
        F.lit(second.column_count).alias("columns_after"),
        F.lit(second.row_count).alias("rows_written"),
    )
    rows = written(rows, "overwritten")
    spark.sql(f"drop table {name}")
    return rows


@query
def rentals_any_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Rental lines without a schema: plain ids become arrays, no field and no line is lost, damaged lines keep their text."""
    rows = read_json_any(spark, inputs.rentals_any_json(spark, folder))
    return rows.select("*", F.length(CORRUPT).alias("corrupt_length")).drop(CORRUPT)


@query
def jobs_default_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Ingest and silver step with no schema given: silver rentals, and what the metrics say of lines and rows."""
    paths = [read_from(spark, folder) for read_from in (inputs.listings_csv, inputs.rentals_any_json, inputs.geojson_files)]
    with _database(spark) as tables:
        ingested = jobs.raw_to_bronze(spark, _raw_files(*paths), tables)
        jobs.bronze_to_silver(spark, tables, SilverOptions(grid=GRID))
        checks = [F.lit(metric.checks["corrupt_rows"]).alias(name) for metric, name in zip(ingested, ("bad_lines", "bad_rows"))]
        counts = [F.lit(metric.row_count).alias(name) for metric, name in zip(ingested, ("n_rentals", "n_listings"))]
        return written(spark.table(tables.silver_rentals).select("*", *checks, *counts), "silver")


@query
def exploded_in_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """``explode_chain`` where nearly every row is more than one task may make: decoded from numbers, in many tasks."""
    rentals = inputs.rentals(spark, folder).select("order_id", "line_no", "crawledAt", "firstSeenAt")
    return explode_arrays(rentals, rows_per_task=1)


@query
def run_report(spark: SparkSession, folder: str) -> DataFrame:
    """What the metrics of ``raw_files_to_gold_options`` say of that run, as one row."""
    with _database(spark) as tables:
        silver = _all_jobs(spark, folder, REPORTED, tables)
    listings, rentals = silver
    values = listings.checks | rentals.checks | {"silver_listings": listings.row_count, "silver_rentals": rentals.row_count}
    return spark.range(1).select(*(F.lit(value).cast("long").alias(name) for name, value in values.items()))


@query
def raw_files_to_gold(spark: SparkSession, folder: str) -> DataFrame:
    """All three jobs in order, from raw files, by given schemas, to the comparison table."""
    return _comparison(spark, folder, SilverOptions(grid=GRID))


#: Other choices in the silver step.
REPORTED = SilverOptions(on_multiple="first", require_digits=True, explode_mode="zip", trim=True, dedupe=True, report=True)


@query
def raw_files_to_gold_options(spark: SparkSession, folder: str) -> DataFrame:
    """The same with other choices in the silver step."""
    return _comparison(spark, folder, REPORTED)


def _raw_files(*paths: str) -> RawFiles:
    (listings_base, listings_file), (rentals_base, rentals_file), (areas_base, areas_file) = (path.rsplit("/", 1) for path in paths)
    return RawFiles(f"{listings_base}/", rentals_base, areas_base, listings_file, rentals_file, areas_file)


@contextmanager
def _database(spark: SparkSession) -> Iterator[TableNames]:
    schema = _table_name("letting")
    spark.sql(f"create database {schema} location '{fresh_path(spark, schema)}'")
    try:
        yield TableNames().under(None, schema, schema, schema)
    finally:
        spark.sql(f"drop database {schema} cascade")


def _all_jobs(spark: SparkSession, folder: str, options: SilverOptions, tables: TableNames) -> list[WriteMetrics]:
    paths = [read_from(spark, folder) for read_from in (inputs.listings_csv, inputs.rentals_json, inputs.geojson_files)]
    jobs.raw_to_bronze(spark, _raw_files(*paths), tables, LISTINGS_SCHEMA, _rentals_schema())
    silver = jobs.bronze_to_silver(spark, tables, options)
    jobs.silver_to_gold(spark, tables)
    return silver


def _comparison(spark: SparkSession, folder: str, options: SilverOptions) -> DataFrame:
    with _database(spark) as tables:
        _all_jobs(spark, folder, options, tables)
        return written(spark.table(tables.gold_comparison), "comparison")
