"""JSON lines of any shape, without a schema and without loss.

Every line is parsed once, into a VARIANT, and stored; lines that are no JSON object keep their text in a column of their
own. A distributed aggregate over the stored values then finds one line for each type of each field, their types are merged,
and the fields become typed columns by names in alphabetical order. A reader that infers types and reads again would have to parse twice, and would
turn what does not fit into NULL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from lettora.operators.columns import quoted
from lettora.sources.files import CORRUPT
from lettora.sources.shared import written

LINE, FIELDS = "_line", "_fields"
_PLAIN_NAME = re.compile(r"[\w -]+")


@dataclass(frozen=True)
class JsonField:
    """A field, the type of its column, and whether some of its values are arrays and others are not."""

    name: str
    kind: DataType
    mixed: bool


def kind_of(variant_type: str | None) -> DataType:
    """The column type for a type as ``schema_of_variant`` writes it.

    Decimals become doubles, as in JSON inference. Where values differ in type, are all NULL, or are empty objects, the
    column holds their JSON text.
    """
    if variant_type is None:
        return StringType()
    # Quoted names stay as they are.
    parts = re.split(r"(`(?:[^`]|``)*`)", variant_type)
    ddl = "".join(part if at % 2 else part.replace("OBJECT<", "STRUCT<") for at, part in enumerate(parts))
    return _storable(DataType.fromDDL(ddl))


def _storable(kind: DataType) -> DataType:
    if isinstance(kind, DecimalType):
        return DoubleType()
    if isinstance(kind, (VariantType, NullType)) or isinstance(kind, StructType) and not kind.fields:
        return StringType()
    if isinstance(kind, ArrayType):
        return ArrayType(_storable(kind.elementType))
    if isinstance(kind, StructType):
        return StructType([StructField(field.name, _storable(field.dataType)) for field in kind])
    return kind


def read_json_variants(spark: SparkSession, path: str) -> DataFrame:
    """A row per line: the object in ``_line``, or the text of what is no JSON object in ``_corrupt_record``.

    The reader skips blank lines. Files split into tasks by lines.
    """
    schema = StructType([StructField(LINE, VariantType()), StructField(CORRUPT, StringType())])
    reader = spark.read.schema(schema).option("singleVariantColumn", LINE).option("columnNameOfCorruptRecord", CORRUPT)
    lines = reader.json(path)
    # Of the object nothing is read for this, other than for its whole type.
    is_object = F.try_variant_get(F.col(LINE), "$", "struct<>").isNotNull()
    return lines.select(
        F.when(is_object, F.col(LINE)).alias(LINE),
        F.when(is_object, F.lit(None)).otherwise(F.coalesce(CORRUPT, F.to_json(LINE))).alias(CORRUPT),
    )


def _is_array(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("ARRAY<")


def one_of_each_kind(lines: DataFrame) -> DataFrame:
    """Of written ``lines``, one for every type that a field has in any of them.

    Types are merged far more slowly than told apart, and of equal types one says as much as all. ``json_fields`` of these
    few lines is that of all. Lines are named by file and number, as variants cannot be compared.
    """
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    placed = lines.select(LINE, *at)
    values = placed.where(F.col(LINE).isNotNull()).lateralJoin(lines.sparkSession.tvf.variant_explode(F.col(LINE).outer()))
    kinds = values.groupBy("file", "key", F.schema_of_variant("value").alias("kind")).agg(F.min("row").alias("row"))
    first = kinds.groupBy("key", "kind").agg(F.min(F.struct("file", "row")).alias("at")).select("at.*").distinct()
    return placed.join(first, ["file", "row"], "left_semi").select(LINE)


def json_fields(lines: DataFrame) -> list[JsonField]:
    """All fields of the objects in ``_line``, by name. The list grows with the number of fields, not of rows."""
    values = lines.where(F.col(LINE).isNotNull()).lateralJoin(lines.sparkSession.tvf.variant_explode(F.col(LINE).outer()))
    value, array = F.col("value"), _is_array(F.col("value"))
    found = values.groupBy("key").agg(
        F.schema_of_variant_agg(F.when(array, value)).alias("arrays"),
        # JSON null fits any type.
        F.schema_of_variant_agg(F.when(~array & ~F.is_variant_null(value), value)).alias("others"),
        F.count_if(array).alias("n_arrays"),
        F.count_if(~array & ~F.is_variant_null(value)).alias("n_others"),
    )
    return [_field(*row) for row in found.orderBy("key").collect()]


def _field(name: str, arrays: str | None, others: str | None, n_arrays: int, n_others: int) -> JsonField:
    if not n_arrays:
        return JsonField(name, kind_of(others), False)
    if not n_others:
        return JsonField(name, kind_of(arrays), False)
    whole, single = kind_of(arrays), kind_of(others)
    element = whole.elementType if isinstance(whole, ArrayType) else None
    # Single values become arrays of one, so that no row gets lost when arrays are turned into rows.
    return JsonField(name, ArrayType(single if element == single else StringType()), True)


def _ddl(kind: DataType) -> str:
    if isinstance(kind, ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    if isinstance(kind, StructType):
        return "struct<" + ", ".join(f"{quoted(field.name)}: {_ddl(field.dataType)}" for field in kind) + ">"
    return kind.simpleString()


def field_column(field: JsonField, spelled: bool = False) -> Column:
    """The typed column of a field of ``_fields``, or of ``_line`` where a path can spell its name (``spelled``).

    A value that does not fit raises; by ``json_fields`` none does.
    """
    source, path = (F.col(LINE), f"$['{field.name}']") if spelled else (F.col(FIELDS)[field.name], "$")
    if not field.mixed:
        return F.variant_get(source, path, _ddl(field.kind)).alias(field.name)
    assert isinstance(field.kind, ArrayType)
    value = F.variant_get(source, path, "variant")
    single = F.array(F.variant_get(value, "$", _ddl(field.kind.elementType)))
    missing = value.isNull() | F.is_variant_null(value)
    return (
        F.when(missing, F.lit(None)).when(_is_array(value), F.variant_get(value, "$", _ddl(field.kind))).otherwise(single)
    ).alias(field.name)


def read_json_any(spark: SparkSession, path: str) -> DataFrame:
    """All lines and all fields of JSON line files, typed by what they hold, and ``_corrupt_record``.

    Building this runs jobs: lines are parsed and written to the shared folder, and fields are listed.
    """
    lines = written(read_json_variants(spark, path), "json")
    fields = json_fields(one_of_each_kind(lines))
    # Names that no path can spell are looked up in a map.
    spelled = all(_PLAIN_NAME.fullmatch(field.name) for field in fields)
    objects = lines if spelled else lines.withColumn(FIELDS, F.col(LINE).cast("map<string,variant>"))
    return objects.select(*(field_column(field, spelled) for field in fields), CORRUPT)
