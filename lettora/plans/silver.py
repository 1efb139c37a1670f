"""Bronze -> silver: cleaned listings and rentals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lettora.functions.text import area_amount, has_pc4, pc4, rent_amount, to_double, utilities_included
from lettora.operators.arrays import explode_arrays, explosion_counts
from lettora.operators.columns import names_of_type, trim_strings
from lettora.operators.distinct import distinct_rows
from lettora.params import GridSpec, SkewLimits, TextPatterns
from lettora.plans.fill import (
    COORDINATE,
    attach_postcodes,
    coordinate_counts,
    locate_missing,
    profile_of_fill,
    with_formatted_zipcode,
)
from lettora.sources.shared import written


def valid_listings(listings: DataFrame, patterns: TextPatterns = TextPatterns()) -> DataFrame:
    """Numbers parsed and PC4 taken from ``final_zipcode``; rows without a PC4 or a price are dropped."""
    return listings.withColumns(
        {
            "postalcode4": pc4(F.col("final_zipcode"), patterns.pc4),
            "price": to_double(F.col("price")),
            "review_scores_value": to_double(F.col("review_scores_value")),
            "bedrooms": to_double(F.col("bedrooms")),
        }
    ).where((F.col("postalcode4") != "") & F.col("price").isNotNull())


def silver_listings(
    bronze: DataFrame,
    polygons: DataFrame,
    grid: GridSpec = GridSpec(),
    limits: SkewLimits | None = SkewLimits(),
    on_multiple: str = "all",
    require_digits: bool = False,
    dedupe: bool = False,
    patterns: TextPatterns = TextPatterns(),
) -> DataFrame:
    """Listings with a PC4, their own or that of the polygon they lie in. Building this plan runs jobs, as the fill does."""
    return _filled_listings(bronze, polygons, grid, limits, on_multiple, require_digits, dedupe, patterns, False)[0]


def silver_listings_and_profile(
    bronze: DataFrame,
    polygons: DataFrame,
    grid: GridSpec = GridSpec(),
    limits: SkewLimits | None = SkewLimits(),
    on_multiple: str = "all",
    require_digits: bool = False,
    dedupe: bool = False,
    patterns: TextPatterns = TextPatterns(),
) -> tuple[DataFrame, DataFrame]:
    """``silver_listings`` and the ``profile_of_fill`` of the very fill in it.

    The located coordinates are written, so that both read the same ones and nothing is located twice.
    """
    return _filled_listings(bronze, polygons, grid, limits, on_multiple, require_digits, dedupe, patterns, True)


def _filled_listings(
    bronze: DataFrame,
    polygons: DataFrame,
    grid: GridSpec,
    limits: SkewLimits | None,
    on_multiple: str,
    require_digits: bool,
    dedupe: bool,
    patterns: TextPatterns,
    keep_located: bool,
) -> tuple[DataFrame, DataFrame]:
    listings = with_formatted_zipcode(bronze, require_digits=require_digits, patterns=patterns)
    counts = coordinate_counts(listings)
    located = locate_missing(counts, polygons, grid, limits, on_multiple)
    if keep_located:
        located = written(located, "located")
    # Rows that cannot come out valid need not travel through the join; the coordinates above come from all rows.
    placeable = F.col("zipcode_formatted").isNull() & F.col(COORDINATE[0]).isNotNull() & F.col(COORDINATE[1]).isNotNull()
    worth_joining = listings.where(
        (has_pc4(F.col("zipcode_formatted"), patterns.pc4) | placeable) & to_double(F.col("price")).isNotNull()
    )
    silver = valid_listings(attach_postcodes(worth_joining, located, limits, counts), patterns)
    return distinct_rows(silver) if dedupe else silver, profile_of_fill(counts, located)


def silver_rentals(
    bronze: DataFrame,
    patterns: TextPatterns = TextPatterns(),
    explode_mode: str = "chain",
    trim: bool = False,
    dedupe: bool = False,
    seen: Observation | None = None,
) -> DataFrame:
    """Rentals with a PC4 and a positive monthly rent, array columns turned into rows.

    ``trim`` trims the string columns and makes blanks NULL. ``explode_mode`` is that of ``explode_arrays``. ``seen``
    receives, when the result is computed, the ``explosion_counts`` of the rows whose arrays were turned into rows.
    """
    listed = with_formatted_zipcode(bronze, "postalCode", patterns=patterns)
    # Unless the filters read an array column, they go first: what they drop is never exploded.
    filter_first = not {"postalCode", "rent"} & set(names_of_type(bronze, ArrayType))
    if filter_first:
        listed = _valid_rentals(listed, patterns)
    if seen:
        listed = listed.observe(seen, *explosion_counts(listed, explode_mode))
    flat = explode_arrays(listed, explode_mode)
    flat = trim_strings(flat) if trim else flat
    silver = flat.withColumns(
        {
            "postalcode4": pc4(F.col("postalCode"), patterns.pc4),
            "monthly_rent": rent_amount(F.col("rent"), patterns.rent),
            "utilities_included": utilities_included(F.col("rent"), patterns.utilities),
            "area_sqm": area_amount(F.col("areaSqm"), patterns.area),
        }
    )
    if not filter_first:
        silver = _valid_rentals(silver, patterns)
    return distinct_rows(silver) if dedupe else silver


def _valid_rentals(df: DataFrame, patterns: TextPatterns) -> DataFrame:
    return df.where(has_pc4(F.col("postalCode"), patterns.pc4) & (rent_amount(F.col("rent"), patterns.rent) > 0))
