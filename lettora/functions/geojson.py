"""GeoJSON geometry columns -> ``array<array<array<array<double>>>>`` (polygon members, rings, positions, numbers)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

RINGS = "array<array<array<double>>>"
MEMBERS = f"array<{RINGS}>"

# Quoting that schema inference leaves in the text when a file mixes Polygon and MultiPolygon.
QUOTED_ARRAY_START = r'"\['
QUOTED_ARRAY_END = r'\]"'
QUOTED_NUMBER = r'"(-?\d+\.?\d*)"'


def geometry_json(geometry: Column) -> Column:
    """A parsed geometry struct back as JSON text."""
    return F.to_json(geometry)


def unquote_arrays(text: Column) -> Column:
    """``"[`` -> ``[`` and ``]"`` -> ``]``."""
    return F.regexp_replace(F.regexp_replace(text, QUOTED_ARRAY_START, "["), QUOTED_ARRAY_END, "]")


def unquote_numbers(text: Column) -> Column:
    """``"4.5"`` -> ``4.5``."""
    return F.regexp_replace(text, QUOTED_NUMBER, "$1")


def polygon_members(kind: Column, coordinates_text: Column) -> Column:
    """Members of a Polygon (one) or MultiPolygon (many) from its raw ``coordinates`` text; NULL for other kinds."""
    return F.when(kind == "Polygon", F.array(F.from_json(coordinates_text, RINGS))).when(
        kind == "MultiPolygon", F.from_json(coordinates_text, MEMBERS)
    )


def unreadable_features(features: str) -> Column:
    """How many (Multi)Polygons of an array of features, coordinates being raw text, cannot be read."""

    def unreadable(feature: Column) -> Column:
        members = polygon_members(feature["geometry"]["type"], feature["geometry"]["coordinates"])
        return feature["geometry"]["type"].isin("Polygon", "MultiPolygon") & (members.isNull() | F.exists(members, F.isnull))

    return F.size(F.filter(features, unreadable))


def coordinates_text(df: DataFrame, geometry: str) -> Column:
    """Raw ``coordinates`` text of a geometry column, whatever type its reader gave it.

    Read with an explicit schema it is text already. Read with inference it is a nested array of doubles, or of strings
    when the file mixes kinds; those go through JSON once more, with the quoting removed.
    """
    coordinates = F.col(f"{geometry}.coordinates")
    if isinstance(_field_type(df, geometry), StringType):
        return coordinates
    return unquote_numbers(unquote_arrays(F.to_json(coordinates)))


def _field_type(df: DataFrame, geometry: str) -> DataType:
    kind: DataType = df.schema
    for name in [*geometry.split("."), "coordinates"]:
        assert isinstance(kind, StructType), f"{geometry} is not a struct column"
        kind = kind[name].dataType
    return kind
