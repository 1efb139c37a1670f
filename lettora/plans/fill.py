"""Fill missing listing zipcodes by location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettora.functions.text import format_zipcode, has_pc4
from lettora.operators.distinct import distinct_keys
from lettora.operators.skew import skew_join
from lettora.operators.spatial import as_points, containing_polygons
from lettora.params import GridSpec, SkewLimits, TextPatterns
from lettora.sources.shared import written

# The join back uses the coordinate texts as they came, so "52.10" and "52.1" are two coordinates.
COORDINATE = ["latitude", "longitude"]


def with_formatted_zipcode(
    df: DataFrame, column: str = "zipcode", require_digits: bool = False, patterns: TextPatterns = TextPatterns()
) -> DataFrame:
    """Add ``zipcode_formatted``. ``require_digits`` also turns texts without a PC4 into NULL."""
    formatted = format_zipcode(F.col(column), patterns.zipcode)
    if require_digits:
        formatted = F.when(has_pc4(formatted, patterns.pc4), formatted)
    return df.withColumn("zipcode_formatted", formatted)


def missing_coordinates(listings: DataFrame) -> DataFrame:
    """Distinct coordinates of the listings without a usable zipcode."""
    return distinct_keys(listings.where(F.col("zipcode_formatted").isNull()), COORDINATE)


def coordinate_counts(listings: DataFrame) -> DataFrame:
    """Per coordinate, NULLs included, all listings (``n``) and those without a usable zipcode (``missing``).

    Written to the shared folder: it says which coordinates to locate, which are hot, and what the fill does.
    """
    missing = F.count_if(F.col("zipcode_formatted").isNull()).alias("missing")
    return written(listings.groupBy(*COORDINATE).agg(F.count(F.lit(1)).alias("n"), missing), "coordinates")


def _missing_of(counts: DataFrame) -> DataFrame:
    return counts.where("missing > 0").select(*COORDINATE).na.drop()


def locate_missing(
    counts: DataFrame,
    polygons: DataFrame,
    grid: GridSpec = GridSpec(),
    limits: SkewLimits | None = SkewLimits(),
    on_multiple: str = "all",
) -> DataFrame:
    """(latitude, longitude, postcode) of the coordinates of ``coordinate_counts`` with missing zipcodes in a polygon.

    A coordinate in several polygons gives one row each, or with ``on_multiple="first"`` only the smallest postcode.
    """
    pairs = containing_polygons(as_points(_missing_of(counts)), polygons, grid, limits)
    if on_multiple == "first":
        return pairs.groupBy(*COORDINATE).agg(F.min("postcode").alias("postcode"))
    if on_multiple != "all":
        raise ValueError(f"on_multiple must be 'all' or 'first', not {on_multiple!r}")
    return pairs.select(*COORDINATE, "postcode")


def attach_postcodes(
    listings: DataFrame, located: DataFrame, limits: SkewLimits | None = SkewLimits(), counts: DataFrame | None = None
) -> DataFrame:
    """Left join of located postcodes, and ``final_zipcode``: the own zipcode, else the located postcode.

    ``counts`` are the listings per coordinate, if known already.
    """
    joined = skew_join(listings, located, COORDINATE, "left", limits, counts)
    return joined.withColumn("final_zipcode", F.coalesce("zipcode_formatted", "postcode"))


def fill_zipcodes(
    listings: DataFrame,
    polygons: DataFrame,
    grid: GridSpec = GridSpec(),
    limits: SkewLimits | None = SkewLimits(),
    on_multiple: str = "all",
    require_digits: bool = False,
    patterns: TextPatterns = TextPatterns(),
) -> DataFrame:
    """All listings with zipcode_formatted, postcode and final_zipcode; coordinates first.

    Building this plan runs jobs (coordinate counts, cover, hot keys); the listings are read once by them and once by the
    result. A coordinate in k polygons multiplies its listings by k, also those that had a zipcode of their own.
    """
    listings = with_formatted_zipcode(listings, require_digits=require_digits, patterns=patterns)
    counts = coordinate_counts(listings)
    located = locate_missing(counts, polygons, grid, limits, on_multiple)
    return attach_postcodes(listings, located, limits, counts)


def unmatched_coordinates(
    listings: DataFrame,
    polygons: DataFrame,
    grid: GridSpec = GridSpec(),
    limits: SkewLimits | None = SkewLimits(),
    require_digits: bool = False,
    patterns: TextPatterns = TextPatterns(),
) -> DataFrame:
    """Distinct missing coordinates with their postcode, NULL where no polygon holds them."""
    counts = coordinate_counts(with_formatted_zipcode(listings, require_digits=require_digits, patterns=patterns))
    return _missing_of(counts).join(locate_missing(counts, polygons, grid, limits), COORDINATE, "left")


def fill_profile(
    listings: DataFrame,
    polygons: DataFrame,
    grid: GridSpec = GridSpec(),
    limits: SkewLimits | None = SkewLimits(),
    on_multiple: str = "all",
    require_digits: bool = False,
    patterns: TextPatterns = TextPatterns(),
) -> DataFrame:
    """What the fill with these choices does to listings, see ``profile_of_fill``. It counts and locates on its own."""
    counts = coordinate_counts(with_formatted_zipcode(listings, require_digits=require_digits, patterns=patterns))
    return profile_of_fill(counts, locate_missing(counts, polygons, grid, limits, on_multiple))


def profile_of_fill(counts: DataFrame, located: DataFrame) -> DataFrame:
    """What a fill does to listings without a usable zipcode, as one row of counts, from the tables it works with.

    ``missing_listings`` of them fall into ``unplaced_listings`` (no coordinate), ``unlocated_listings`` (in no polygon)
    and the rest, which becomes ``located_rows`` rows: more than listings where ``shared_coordinates`` lie in several
    polygons.
    """
    hits = located.groupBy(*COORDINATE).agg(F.count(F.lit(1)).alias("hits"))
    # One row per coordinate, also for those with a NULL in them, which join nothing.
    places = counts.where("missing > 0").select(*COORDINATE, F.col("missing").alias("n")).join(hits, COORDINATE, "left")
    unplaced = F.col(COORDINATE[0]).isNull() | F.col(COORDINATE[1]).isNull()
    unlocated = ~unplaced & F.col("hits").isNull()

    def total(rows: Column) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0))

    return places.agg(
        total(F.col("n")).alias("missing_listings"),
        total(F.when(unplaced, F.col("n"))).alias("unplaced_listings"),
        F.count_if(~unplaced).alias("missing_coordinates"),
        F.count_if(unlocated).alias("unlocated_coordinates"),
        F.count_if(F.col("hits") > 1).alias("shared_coordinates"),
        total(F.when(unlocated, F.col("n"))).alias("unlocated_listings"),
        total(F.col("n") * F.col("hits")).alias("located_rows"),
    )
