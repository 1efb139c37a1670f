"""The thin jobs: read, call a plan, write. Each output is computed once."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lettora.functions.geojson import unreadable_features
from lettora.operators.arrays import EXPLOSION
from lettora.operators.spatial import postcode_polygons
from lettora.params import Economics, RawFiles, SilverOptions, StrategyLabels, TableNames
from lettora.plans.gold import gold_comparison, gold_long_term, gold_short_term
from lettora.plans.silver import silver_listings, silver_listings_and_profile, silver_rentals
from lettora.sinks.tables import WriteMetrics, overwrite_table
from lettora.sources.files import (
    CORRUPT,
    POSTCODES_SCHEMA,
    raw_path,
    read_csv,
    read_geojson,
    read_geojson_lines,
    read_json_lines,
)
from lettora.sources.shared import cleaned
from lettora.sources.splits import read_csv_records, read_geojson_split
from lettora.sources.variants import read_json_any


def ingest_rentals(spark: SparkSession, path: str, table: str, schema: StructType | None = None) -> WriteMetrics:
    """All fields of all lines; lines that cannot be read keep their text in ``_corrupt_record`` and are counted.

    Fields are typed by what they hold (``read_json_any``). A schema saves that pass, and drops the fields it lacks; lines
    with a value of another type then count as corrupt too.
    """
    with cleaned(spark):
        rentals = read_json_any(spark, path) if schema is None else read_json_lines(spark, path, schema, CORRUPT)
        return overwrite_table(rentals, table, checks={"corrupt_rows": F.count(F.col(CORRUPT))})


def ingest_listings(
    spark: SparkSession, path: str, table: str, schema: StructType | None = None, line_breaks: bool = False
) -> WriteMetrics:
    """Rows with too few or too many fields keep their text in ``_corrupt_record`` and are counted.

    ``line_breaks`` says that quoted texts may hold some (``read_csv_records``, which reads the file twice).
    """
    listings = (read_csv_records if line_breaks else read_csv)(spark, path, schema, CORRUPT)
    return overwrite_table(listings, table, checks={"corrupt_rows": F.count(F.col(CORRUPT))})


def ingest_postcodes(
    spark: SparkSession,
    path: str,
    table: str,
    schema: StructType | None = POSTCODES_SCHEMA,
    lines: bool = False,
    split: bool = False,
) -> WriteMetrics:
    """All properties are kept. Features are counted, and those of unreadable shape.

    ``lines`` reads one feature per line; ``split`` reads a large collection by byte ranges in many tasks.
    """
    if lines or split:
        collections = (read_geojson_lines if lines else read_geojson_split)(spark, path)
    else:
        collections = read_geojson(spark, path, schema)
    checks = {"features": F.sum(F.size("features"))}
    if lines or split or schema is POSTCODES_SCHEMA:
        checks["unreadable_features"] = F.sum(unreadable_features("features"))
    return overwrite_table(collections, table, checks=checks)


def raw_to_bronze(
    spark: SparkSession,
    files: RawFiles,
    tables: TableNames = TableNames(),
    listings_schema: StructType | None = None,
    rentals_schema: StructType | None = None,
) -> list[WriteMetrics]:
    return [
        ingest_rentals(
            spark, raw_path(files.rentals_base, files.rentals_file), tables.bronze_rentals, rentals_schema
        ),
        ingest_listings(
            spark, raw_path(files.listings_base, files.listings_file), tables.bronze_listings, listings_schema
        ),
        ingest_postcodes(spark, raw_path(files.postcodes_base, files.postcodes_file), tables.bronze_postcodes),
    ]


def bronze_to_silver(
    spark: SparkSession,
    tables: TableNames = TableNames(),
    options: SilverOptions = SilverOptions(),
) -> list[WriteMetrics]:
    """With ``options.report`` the metrics also say how listings were filled and rentals multiplied.

    These counts come from the run itself: the fill's own tables, and the rows seen right before arrays are exploded.
    """
    o = options
    polygons = postcode_polygons(spark.table(tables.bronze_postcodes))
    bronze = spark.table(tables.bronze_listings).drop(CORRUPT)
    raw_rentals = spark.table(tables.bronze_rentals).drop(CORRUPT)
    seen = Observation() if o.report else None
    with cleaned(spark):
        choices = o.grid, o.limits, o.on_multiple, o.require_digits, o.dedupe, o.patterns
        if o.report:
            listings, profile = silver_listings_and_profile(bronze, polygons, *choices)
        else:
            listings = silver_listings(bronze, polygons, *choices)
        rentals = silver_rentals(raw_rentals, o.patterns, o.explode_mode, o.trim, o.dedupe, seen)
        metrics = [
            overwrite_table(listings, tables.silver_listings, merge_schema=True),
            overwrite_table(rentals, tables.silver_rentals, merge_schema=True),
        ]
        if seen:
            reports = [profile.first().asDict(), {name: seen.get[name] or 0 for name in EXPLOSION}]
            metrics = [replace(metric, checks=metric.checks | report) for metric, report in zip(metrics, reports)]
    return metrics


def silver_to_gold(
    spark: SparkSession,
    tables: TableNames = TableNames(),
    economics: Economics = Economics(),
    labels: StrategyLabels = StrategyLabels(),
) -> list[WriteMetrics]:
    """The comparison reads the two summaries just written, so each silver table is aggregated once."""
    metrics = [
        overwrite_table(gold_short_term(spark.table(tables.silver_listings), economics), tables.gold_short_term),
        overwrite_table(gold_long_term(spark.table(tables.silver_rentals), economics), tables.gold_long_term),
    ]
    comparison = gold_comparison(spark.table(tables.gold_short_term), spark.table(tables.gold_long_term), labels)
    return [*metrics, overwrite_table(comparison, tables.gold_comparison)]
