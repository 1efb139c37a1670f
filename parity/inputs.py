"""Raw inputs derived from the given tables, as column expressions that Spark and DuckDB both read.

Three dirty inputs grow with the tables: ``listings`` (one per order), ``rentals`` (one per lineitem) and ``areas`` (one
per customer, a polygon for seven in eight and a point for the others). Customer ``c`` owns the unit square at column ``c % 100`` and row ``c / 100``;
an order lies somewhere in the square of its customer. Offsets have three decimals that never fall on a polygon edge.

The inputs are what raw files and bronze tables would be, so they are written once per session and input folder, and
queries read them from there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettora.sources.shared import fresh_path


def code(key: str, owner: str) -> str:
    """A zipcode text in one of eight states of disrepair."""
    four = f"cast(1000 + {owner} % 9000 as varchar(10))"
    return (
        f"case {key} % 8 when 0 then null when 1 then concat({four}, 'AB') when 2 then concat({four}, ' AB') "
        f"when 3 then {four} when 4 then concat({four}, '9') when 5 then '' when 6 then concat('x', {four}, 'YZ') "
        f"else concat({four}, 'XY') end"
    )


LISTINGS = {
    "listing_id": "o_orderkey",
    "zipcode": code("o_orderkey", "o_custkey"),
    "latitude": "case when o_orderkey % 17 = 0 then null else concat(cast(cast(floor(o_custkey / 100) as bigint) as "
    "varchar(20)), '.', cast(10 + 9 * (o_orderkey * 53 % 10) as varchar(10)), '3') end",
    "longitude": "case when o_orderkey % 19 = 0 then 'n/a' else concat(cast(o_custkey % 100 as varchar(20)), '.', "
    "cast(10 + 9 * (o_orderkey * 37 % 10) as varchar(10)), '5') end",
    "price": "case when o_orderkey % 11 = 0 then '$bad' "
    "else cast(cast(o_totalprice as decimal(18,2)) as varchar(30)) end",
    "bedrooms": "cast(o_custkey % 5 as varchar(5))",
    "review_scores_value": "case when o_orderkey % 7 = 0 then null else cast(o_orderkey % 11 as varchar(5)) end",
    "host_note": "case o_orderkey % 3 when 0 then '   ' when 1 then concat('  ', o_orderpriority, ' ') end",
}

RENTALS = {
    "order_id": "l_orderkey",
    "line_no": "l_linenumber",
    "postalCode": code("(l_orderkey + l_linenumber)", "l_partkey"),
    "rent": "case when l_orderkey % 13 = 0 then '$ 900' when l_orderkey % 13 = 1 then null "
    "else concat('€ ', cast(cast(floor(l_extendedprice / 50) as bigint) as varchar(20)), "
    "case when l_linenumber % 2 = 0 then ' Utilities incl.' else ',-' end) end",
    "areaSqm": "case when l_linenumber = 7 then 'unknown' "
    "else concat(cast(cast(l_quantity as int) as varchar(10)), ' m2') end",
}
# Array columns: one or two times of crawling; one sighting, none, or NULL.
RENTAL_ARRAYS = {
    "crawledAt": "case when l_orderkey % 3 = 0 then split('2024-01-01;2024-02-01', ';') else split('2024-03-01', ';') end",
    "firstSeenAt": "case when l_orderkey % 10 = 9 then null when l_orderkey % 10 = 8 then {empty} "
    "else split(l_returnflag, ';') end",
}
SPARK_EMPTY, SQL_EMPTY = "slice(split('', ';'), 1, 0)", "[]::varchar[]"

# Prices of all magnitudes, a group of one kind each, and groups of all kinds.
TINY = {
    "postalcode4": "cast(1000 + case when o_orderkey % 3 = 0 then 7 else o_orderkey % 7 end + 10 * (o_custkey % 40) as varchar(10))",
    "price": "case o_orderkey % 7 when 0 then '0.0049999999' when 1 then '0.005' when 2 then '123456789012.5' "
    "when 3 then concat(cast(o_custkey as varchar(20)), '.0050000001') when 4 then '0.00000000000123' "
    "when 5 then concat('0.00499999999', cast(o_custkey % 10 as varchar(1))) else '0.015' end",
}

# Shape of the area of customer c, by c % 8; for 7 it is a point, which is no area.
#   0, 4: diamond of radius 0.5   1, 5: the same with a diamond hole of radius 0.2
#   2, 6: two boxes               3: diamond of radius 1.2, which reaches into the neighbouring squares
AREA_KIND = "case c_custkey % 8 when 0 then 'diamond' when 4 then 'diamond' when 1 then 'ring' when 5 then 'ring' " \
    "when 2 then 'boxes' when 6 then 'boxes' when 3 then 'wide' else 'point' end"
AREAS = {
    "postcode": "cast(1000 + c_custkey % 9000 as varchar(10))",
    "kind": AREA_KIND,
    "mid_x": "cast(c_custkey % 100 as double) + cast(0.5 as double)",
    "mid_y": "cast(floor(c_custkey / 100) as double) + cast(0.5 as double)",
    "owner": "c_custkey",
}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(text).alias(name) for name, text in columns.items()])


_WRITTEN: dict[tuple[str, str, str], str] = {}


def path_once(spark: SparkSession, folder: str, name: str, write: Callable[[str], None]) -> str:
    """Where ``write`` has put the input ``name``; it is called at most once per session and input folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _WRITTEN:
        path = fresh_path(spark, name)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def _stored(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    def write(path: str) -> None:
        df, cores = build(), spark.sparkContext.defaultParallelism
        # One small source file would mean one file here and one task in every query.
        (df.repartition(cores) if df.rdd.getNumPartitions() < cores else df).write.parquet(path)

    return spark.read.parquet(path_once(spark, folder, name, write))


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return _stored(spark, folder, "listings", lambda: _select(read(spark, folder, "orders"), LISTINGS))


def rentals(spark: SparkSession, folder: str, arrays: bool = True) -> DataFrame:
    """With ``arrays=False`` without the array columns."""
    texts = {name: text.format(empty=SPARK_EMPTY) for name, text in RENTAL_ARRAYS.items()}
    df = _stored(spark, folder, "rentals", lambda: _select(read(spark, folder, "lineitem"), RENTALS | texts))
    return df if arrays else df.select(*RENTALS)


def areas(spark: SparkSession, folder: str) -> DataFrame:
    return _select(read(spark, folder, "customer"), AREAS)


def _ring(*corners: tuple[float, float]) -> str:
    """JSON text of a closed ring around (mid_x, mid_y), as a Spark string expression."""
    closed = [*corners, corners[0]]
    points = ", ', ', ".join(f"'[', mid_x + {dx}D, ', ', mid_y + {dy}D, ']'" for dx, dy in closed)
    return f"concat('[', {points}, ']')"


def _diamond(radius: float) -> str:
    return _ring((0, -radius), (radius, 0), (0, radius), (-radius, 0))


def _box(left: float, right: float, half_height: float) -> str:
    return _ring((left, -half_height), (right, -half_height), (right, half_height), (left, half_height))


COORDINATES = (
    f"case kind when 'diamond' then concat('[', {_diamond(0.5)}, ']') "
    f"when 'ring' then concat('[', {_diamond(0.5)}, ', ', {_diamond(0.2)}, ']') "
    f"when 'boxes' then concat('[[', {_box(-0.45, -0.05, 0.45)}, '], [', {_box(0.05, 0.45, 0.45)}, ']]') "
    f"when 'wide' then concat('[', {_diamond(1.2)}, ']') else concat('[', mid_x, ', ', mid_y, ']') end"
)


def area_features(spark: SparkSession, folder: str) -> DataFrame:
    """Areas as (owner, postcode, type, coordinates text)."""
    return areas(spark, folder).select(
        "owner",
        "postcode",
        F.expr("case kind when 'boxes' then 'MultiPolygon' when 'point' then 'Point' else 'Polygon' end").alias("type"),
        F.expr(COORDINATES).alias("coordinates"),
    )


# Features per collection, which is one row or one file.
COLLECTION = 1024


def postcode_collections(spark: SparkSession, folder: str) -> DataFrame:
    """Areas as a bronze postcode table."""
    feature = F.struct(
        F.struct(F.col("postcode").alias("pc4_code")).alias("properties"),
        F.struct("type", "coordinates").alias("geometry"),
    )

    def build() -> DataFrame:
        features = area_features(spark, folder)
        collections = features.groupBy(F.floor(F.col("owner") / COLLECTION)).agg(F.collect_list(feature).alias("features"))
        return collections.select("features")

    return _stored(spark, folder, "postcodes", build)


def _feature(gap: str) -> Column:
    return F.format_string(
        f'{{"type": "Feature",{gap} "properties": {{"pc4_code": %s}},{gap} "geometry": {{"type": "%s",{gap} "coordinates": %s}}}}',
        F.expr("if(type = 'MultiPolygon', postcode, concat('\"', postcode, '\"'))"),
        "type",
        "coordinates",
    )


def geojson_line_files(spark: SparkSession, folder: str) -> str:
    """The same areas as one feature per line."""
    rows = area_features(spark, folder).select(_feature("").alias("value"))
    return path_once(spark, folder, "geojson_lines", rows.write.text)


def geojson_files(spark: SparkSession, folder: str) -> str:
    """Areas as pretty-printed GeoJSON files; MultiPolygons have a number for a postcode."""
    feature = _feature("\n")

    def write(path: str) -> None:
        collections = (
            area_features(spark, folder)
            .groupBy(F.floor(F.col("owner") / COLLECTION).alias("file"))
            .agg(F.concat_ws(",\n", F.collect_list(feature)).alias("features"))
            .select("file", F.format_string('{"type": "FeatureCollection",\n "features": [%s]}', "features"))
        )
        collections.write.partitionBy("file").text(path)

    return path_once(spark, folder, "geojson", write)


def listings_csv(spark: SparkSession, folder: str) -> str:
    """With the outer spaces of ``host_note`` as they are; the writer would trim them."""
    writer = listings(spark, folder).write.option("header", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    return path_once(spark, folder, "listings_csv", writer.csv)


def listings_csv_with_breaks(spark: SparkSession, folder: str) -> str:
    """``host_note`` with line breaks and quotes, as listing files have them; texts are quoted, quotes doubled."""
    note = F.expr("case listing_id % 4 when 0 then concat(host_note, '\n', '\"cosy\", 2 rooms') when 1 then '\n\n' else host_note end")
    rows = listings(spark, folder).withColumn("host_note", note)
    writer = rows.write.option("header", True).option("escape", '"').option("quoteAll", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    return path_once(spark, folder, "listings_breaks_csv", writer.csv)


def geojson_file(spark: SparkSession, folder: str) -> str:
    """All areas as one collection in one file."""
    rows = area_features(spark, folder).select("owner", F.concat(F.lit(", "), _feature("\n")).alias("value"))
    head, first, end = '{"type": "FeatureCollection", "features": [', '{"type": "note", "text": "} not [an area"}', "]}"
    ends = spark.createDataFrame([(-1, head + first), (2**62, end)], "owner long, value string")
    whole = rows.withColumn("owner", F.col("owner").cast("long")).union(ends).coalesce(1).sortWithinPartitions("owner").select("value")
    return path_once(spark, folder, "geojson_file", whole.write.text)


def rentals_json(spark: SparkSession, folder: str) -> str:
    return path_once(spark, folder, "rentals_json", lambda path: rentals(spark, folder).write.json(path))


# What a rental line of any shape has: an id that is an array or plain text, fields that not every line has, numbers that
# are text elsewhere, and, for one order in fifty, a second line that is damaged.
ANY_FIELDS = {
    "order_id": "l_orderkey",
    "line_no": "l_linenumber",
    "postalCode": RENTALS["postalCode"],
    "rent": RENTALS["rent"],
    "areaSqm": RENTALS["areaSqm"],
    "_id": "case when l_orderkey % 4 = 0 then concat('\"r', cast(l_orderkey as varchar(20)), '\"') else concat('[\"r', "
    "cast(l_orderkey as varchar(20)), '\", \"s', cast(l_linenumber as varchar(20)), '\"]') end",
    "tags": "case l_orderkey % 5 when 0 then '[\"quiet\", \"top floor\"]' when 1 then '[\"garden\"]' end",
    "floor": "case when l_linenumber = 3 then '\"ground\"' else cast(l_linenumber as varchar(20)) end",
    "city name": "concat('Town ', cast(l_partkey % 7 as varchar(20)))",
}
DAMAGED = "l_orderkey % 50 = 7 and l_linenumber = 1"


def rentals_any_json(spark: SparkSession, folder: str) -> str:
    """Rental lines of any shape as JSON lines."""
    fields = _select(read(spark, folder, "lineitem"), ANY_FIELDS | {"damaged": DAMAGED})
    raw = ("_id", "tags", "floor")
    plain = F.to_json(F.struct(*(name for name in ANY_FIELDS if name not in raw)))
    others = [F.concat(F.lit(f', "{name}": '), F.col(name)) for name in raw]
    whole = F.concat(F.expr(r"substring(plain, 1, length(plain) - 1)"), *(F.coalesce(part, F.lit("")) for part in others), F.lit("}"))
    lines = fields.withColumn("plain", plain).withColumn("value", whole)
    cut = F.filter(F.array("value", F.when(F.col("damaged"), F.expr("substring(value, 1, 30)"))), F.isnotnull)
    return path_once(spark, folder, "rentals_any_json", lines.select(F.explode(cut).alias("value")).write.text)


# --- the same inputs as SQL -------------------------------------------------------------------------------------------


def _columns(columns: dict[str, str]) -> str:
    return ", ".join(f'{text} as "{name}"' for name, text in columns.items())


SQL_LISTINGS = f"select {_columns(LISTINGS)} from orders"
SQL_RENTALS = f"select {_columns(RENTALS)} from lineitem"
SQL_RENTALS_ARRAYS = (
    f"select {_columns(RENTALS | {n: t.format(empty=SQL_EMPTY) for n, t in RENTAL_ARRAYS.items()})} from lineitem"
)
# With ``_id`` and ``tags`` as lists.
SQL_ANY_RENTALS = (
    "select * replace (case when _id like '[%' then from_json(_id, '[\"VARCHAR\"]') else [replace(_id, '\"', '')] end as _id, "
    "from_json(tags, '[\"VARCHAR\"]') as tags, replace(floor, '\"', '') as floor) "
    f"from (select {_columns(ANY_FIELDS)} from lineitem)"
)
SQL_AREAS = f"select {_columns(AREAS)} from customer"


def sql_inside(x: str, y: str) -> str:
    """Strict containment of (x, y) in the area (kind, mid_x, mid_y)."""
    far = f"(abs({x} - mid_x) + abs({y} - mid_y))"
    return (
        f"case kind when 'diamond' then {far} < 0.5 when 'ring' then {far} < 0.5 and {far} > 0.2 "
        f"when 'boxes' then abs({y} - mid_y) < 0.45 and abs({x} - mid_x) > 0.05 and abs({x} - mid_x) < 0.45 "
        f"when 'wide' then {far} < 1.2 end"
    )
