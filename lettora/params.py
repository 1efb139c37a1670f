"""Typed parameters. Every default that shapes a result is stated here, once."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Economics:
    """Assumptions behind the revenue estimates. The defaults users have today."""

    occupancy_rate: Decimal = Decimal("0.50")
    days_per_year: int = 365
    months_per_year: int = 12


@dataclass(frozen=True)
class StrategyLabels:
    """The texts found in the comparison table."""

    short_term: str = "Airbnb (Short-term)"
    long_term: str = "Kamernet (Long-term)"


@dataclass(frozen=True)
class TextPatterns:
    """What counts as a six-character zipcode, a PC4, a rent, an area and included utilities."""

    zipcode: str = "^(.{4})(.{2})$"
    pc4: str = r"(\d{4})"
    rent: str = r"€\s*(\d+)"
    area: str = r"(\d+)"
    utilities: str = "Utilities incl."


@dataclass(frozen=True)
class GridSpec:
    """How the point-in-polygon join partitions the plane.

    A polygon is cut into about ``cells_across`` cells along its extent, and a cell with more than ``edges_per_cell`` edges
    into four, again and again (``most_splits`` times at most: more edges than that can meet in one point). ``cell``, if
    given, is the least side of a cell in coordinate units. Polygons of up to ``edges_in_row`` edges are cut where they
    are, larger ones edge by edge in many tasks, into ``cells_across_large`` cells to begin with. The polygon side is
    broadcast only when its measured size is at most ``broadcast_bytes``; above that the join shuffles by cell.
    """

    cell: float | None = None
    broadcast_bytes: int = 64 * 1024 * 1024
    cells_across: int = 4
    edges_per_cell: int = 64
    edges_in_row: int = 1000
    cells_across_large: int = 16
    most_splits: int = 24


@dataclass(frozen=True)
class SkewLimits:
    """When a join key counts as hot.

    A key with more than ``rows_per_task`` rows is split into pieces of about that size; all others take the ordinary
    path of the same join.
    """

    rows_per_task: int = 1_000_000


@dataclass(frozen=True)
class SilverOptions:
    """All choices of the step from bronze to silver. ``report`` adds counts of filled and exploded rows to the metrics."""

    grid: GridSpec = GridSpec()
    limits: SkewLimits | None = SkewLimits()
    patterns: TextPatterns = TextPatterns()
    on_multiple: str = "all"
    require_digits: bool = False
    explode_mode: str = "chain"
    trim: bool = False
    dedupe: bool = False
    report: bool = False


@dataclass(frozen=True)
class RawFiles:
    """Where the three raw inputs lie. The file names users have today."""

    listings_base: str
    rentals_base: str
    postcodes_base: str
    listings_file: str = "airbnb.csv"
    rentals_file: str = "rentals.json"
    postcodes_file: str = "post_codes.geojson"


@dataclass(frozen=True)
class TableNames:
    """Identifiers (one to three parts) of all tables the jobs read and write. The names users have today."""

    bronze_listings: str = "bronze_airbnb"
    bronze_rentals: str = "bronze_rentals"
    bronze_postcodes: str = "bronze_postcode"
    silver_listings: str = "silver_airbnb"
    silver_rentals: str = "silver_rentals"
    gold_short_term: str = "gold_top_zipcodes_airbnb"
    gold_long_term: str = "gold_top_zipcodes_rentals"
    gold_comparison: str = "gold_investment_comparison"

    def under(self, catalog: str | None, bronze: str, silver: str, gold: str) -> TableNames:
        """Prefix every table with its schema and, if given, the catalog."""
        schemas = {"bronze": bronze, "silver": silver, "gold": gold}
        lead = f"{catalog}." if catalog else ""
        return TableNames(
            **{name: f"{lead}{schemas[name.split('_')[0]]}.{table}" for name, table in vars(self).items()}
        )
