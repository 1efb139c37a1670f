"""Raw file readers. A schema given by the caller saves the extra pass that inference needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

LISTING_FIELDS = ["zipcode", "latitude", "longitude", "price", "review_scores_value", "bedrooms"]
LISTINGS_SCHEMA = StructType([StructField(name, StringType()) for name in LISTING_FIELDS])

RENTAL_ARRAYS = ["_id", "crawledAt", "detailsCrawledAt", "firstSeenAt", "lastSeenAt"]
RENTALS_SCHEMA = StructType(
    [StructField(name, ArrayType(StringType())) for name in RENTAL_ARRAYS]
    + [StructField(name, StringType()) for name in ("postalCode", "areaSqm", "rent")]
)

# ``coordinates`` stays raw text, so Polygon and MultiPolygon features fit one schema; properties keep whatever there is.
FEATURE_SCHEMA = StructType(
    [
        StructField("type", StringType()),
        StructField("id", StringType()),
        StructField("properties", MapType(StringType(), StringType())),
        StructField("geometry", StructType([StructField("type", StringType()), StructField("coordinates", StringType())])),
    ]
)
POSTCODES_SCHEMA = StructType(
    [StructField("type", StringType()), StructField("name", StringType()), StructField("features", ArrayType(FEATURE_SCHEMA))]
)

CORRUPT = "_corrupt_record"


def raw_path(base: str, file: str) -> str:
    return f"{base.rstrip('/')}/{file}"


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, corrupt: str | None = None) -> DataFrame:
    """CSV with a header line. Columns are found by the names in the header; those not in ``schema`` are strings.

    A name of ``schema`` that the header lacks raises, as does a further file with another header. ``corrupt`` names a
    column for the text of rows with too few or too many fields; without it these lose fields, or have NULLs, silently.
    """
    reader = spark.read.option("header", True)
    if schema is None and corrupt is None:
        return reader.csv(path)
    header = reader.csv(path).columns
    missing = [name for name in (schema.names if schema else []) if name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    kinds = {field.name: field.dataType for field in schema} if schema else {}
    fields = [StructField(name, kinds.get(name, StringType())) for name in header]
    if corrupt:
        fields.append(StructField(corrupt, StringType()))
        # A reader that skips fields would not see that a row has another number of them.
        reader = reader.option("columnNameOfCorruptRecord", corrupt).option("columnPruning", False)
    return reader.option("enforceSchema", False).schema(StructType(fields)).csv(path)


def read_json_lines(
    spark: SparkSession, path: str, schema: StructType | None = None, corrupt: str | None = None
) -> DataFrame:
    """One JSON object per line; splittable. Without ``schema`` it is inferred, which reads the file twice.

    ``corrupt`` (with a schema) names a column for the text of lines that are damaged or hold a value of another type;
    without it these have NULLs, silently. ``variants.read_json_any`` needs no schema and loses nothing.
    """
    if schema is None:
        return spark.read.json(path)
    if corrupt is None:
        return spark.read.schema(schema).json(path)
    fields = StructType([*schema.fields, StructField(corrupt, StringType())])
    return spark.read.schema(fields).option("columnNameOfCorruptRecord", corrupt).json(path)


def read_geojson(
    spark: SparkSession, path: str, schema: StructType | None = POSTCODES_SCHEMA, mode: str = "FAILFAST"
) -> DataFrame:
    """Feature collections, one row per file; ``path`` may be a folder or pattern. A damaged file raises.

    A collection is one JSON document and so is parsed by one task; large area sets should come as several files, or one
    feature per line (``read_geojson_lines``). ``schema=None`` infers the schema.
    """
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("mode", mode)
    return (reader.schema(schema) if schema else reader).json(path)


def read_geojson_lines(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """One feature per line, of any number of lines and tasks; columns as from ``read_geojson``, a feature per row."""
    features = spark.read.schema(FEATURE_SCHEMA).option("mode", mode).json(path)
    none = F.lit(None).cast("string")
    return features.select(none.alias("type"), none.alias("name"), F.array(F.struct(*FEATURE_SCHEMA.names)).alias("features"))
