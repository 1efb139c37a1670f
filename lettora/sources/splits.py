"""Records that do not end at line ends, read from byte ranges by many tasks.

A text file is split by bytes, and where a task begins, it does not know whether it is inside a quoted text or how deep
inside brackets. So the file is read twice. First every byte range says what it does to that state, whatever the state is
before it; running sums over the few ranges of a file give the state at the start of each. Then every range is cut into
records. What is left of a record at the end of one range and the beginning of the next is put together at last: two
pieces per range at most.

The order of ranges is that of ``file_block_start``. Their states are held by every task, one entry per range (128 MB by
default) whose state differs from that at the start of a file.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lettora.sources.files import FEATURE_SCHEMA

HEAD, TAIL, MIDDLE, WHOLE = range(4)
RANGE = ["file", "block"]


class Scanner(Protocol):
    """Takes the parts between separators in order; ``inside`` says whether it began inside a record."""

    inside: bool
    parts: list[bytes]

    def feed(self, text: bytes) -> bytes | None:
        """The record that ends with ``text``, if one does."""


def _parts(spark: SparkSession, path: str, separator: str) -> DataFrame:
    lines = spark.read.option("lineSep", separator).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    for batch in batches:
        for file, block, value in zip(*(column.to_pylist() for column in batch.columns)):
            yield (file, block), value


def _cut(batches: Iterator[pa.RecordBatch], scanner: Callable[[Any], Scanner], states: dict) -> Iterator[pa.RecordBatch]:
    """(file, block, kind, leads, record, piece): whole records, or pieces at both ends of a range.

    ``leads`` marks the first record of a file. Pieces have a column of their own, as a parser of records may be moved
    before any filter on ``kind``.
    """
    out: list[tuple[str, int, int, bool, bytes | None, bytes | None]] = []
    at: tuple[str, int] | None = None
    scan = scanner(None)
    first = leads = False

    def rest() -> None:
        if at is not None and scan.parts:
            out.append((*at, MIDDLE if first else TAIL, leads, None, b"".join(scan.parts)))

    def flushed() -> pa.RecordBatch:
        kinds = pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()
        names = ["file", "block", "kind", "leads", "record", "piece"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    for key, value in _ranges(batches):
        if key != at:
            rest()
            at, scan = key, scanner(states.get(key))
            first, leads = scan.inside, key[1] == 0
        record = scan.feed(value)
        if record is not None:
            out.append((*key, HEAD, leads, None, record) if first else (*key, WHOLE, leads, record, None))
            first = leads = False
        if len(out) >= 1000:
            yield flushed()
            out.clear()
    rest()
    if out:
        yield flushed()


def _records(parts: DataFrame, scanner: Callable[[Any], Scanner], states: dict) -> DataFrame:
    """(leads, record) of all records."""
    schema = "file string, block bigint, kind int, leads boolean, record binary, piece binary"
    cut = parts.mapInArrow(lambda batches: _cut(batches, scanner, states), schema)
    whole = cut.where(F.col("record").isNotNull()).select("leads", "record")
    # A tail begins a record, pieces go on with it up to the next tail.
    order = Window.partitionBy("file").orderBy("block", "kind")
    pieces = cut.where(F.col("piece").isNotNull()).withColumn("number", F.count_if(F.col("kind") == TAIL).over(order))
    put_together = F.array_sort(F.collect_list(F.struct("block", "kind", "piece")))
    joined = pieces.groupBy("file", "number").agg(put_together.alias("pieces"), F.max("leads").alias("leads")).select(
        "leads", F.unhex(F.array_join(F.transform("pieces", lambda p: F.hex(p["piece"])), "")).alias("record")
    )
    return whole.union(joined)


# --- CSV --------------------------------------------------------------------------------------------------------------


class _CsvScanner:
    def __init__(self, quoted: bool | None, backslash: bool):
        self.quoted = self.inside = bool(quoted)
        self.backslash = backslash
        self.parts: list[bytes] = []

    def feed(self, text: bytes) -> bytes | None:
        self.parts.append(text + b"\n")
        self.quoted ^= _quotes(text, self.backslash) % 2 == 1
        if self.quoted:
            return None
        record, self.parts = b"".join(self.parts), []
        return record


def _quotes(text: bytes, backslash: bool) -> int:
    if backslash and b"\\" in text:
        text = re.sub(rb"\\.", b"", text, flags=re.DOTALL)
    return text.count(b'"')


def read_csv_records(
    spark: SparkSession, path: str, schema: StructType | None = None, corrupt: str | None = None, escape: str = '"'
) -> DataFrame:
    """``read_csv`` for files whose quoted texts hold line breaks, still read by many tasks.

    Quotes inside a quoted text are doubled, or with ``escape="\\\\"`` behind a backslash. A quote in a text that is not
    quoted is no valid CSV and shifts what is taken for a record. Every file starts with the same header line. Blank lines
    are skipped. ``corrupt`` receives the text of records with another number of fields than the header.
    """
    backslash = escape == "\\"
    header = spark.read.option("header", True).option("multiLine", True).option("escape", escape).csv(path).columns
    missing = [name for name in (schema.names if schema else []) if name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    kinds = {field.name: field.dataType for field in schema} if schema else {}
    fields = [StructField(name, kinds.get(name, StringType())) for name in header]
    parts = _parts(spark, path, "\n")
    bare = F.regexp_replace(F.col("value").cast("string"), r"\\.", "") if backslash else F.col("value").cast("string")
    odd = parts.groupBy(*RANGE).agg((F.sum(F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2).alias("odd"))
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    quoted = odd.select(*RANGE, (F.coalesce(before, F.lit(0)) % 2).alias("quoted")).where("quoted = 1")
    states = {(row.file, row.block): True for row in quoted.collect()}
    records = _records(parts, lambda state: _CsvScanner(state, backslash), states)
    text = F.rtrim(F.col("record").cast("string"), F.lit("\r\n"))
    # The first record of a file is its header.
    kept = records.where(~F.col("leads")).select(text.alias("text")).where(F.col("text") != "")
    options = {"escape": escape, "multiLine": "true", "mode": "PERMISSIVE"}
    if corrupt:
        fields.append(StructField(corrupt, StringType()))
        options["columnNameOfCorruptRecord"] = corrupt
    return kept.select(F.from_csv("text", F.lit(_ddl(StructType(fields))), options).alias("row")).select("row.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{field.name.replace('`', '``')}` {field.dataType.simpleString()}" for field in schema)


# --- GeoJSON ----------------------------------------------------------------------------------------------------------

_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_STRING = re.compile(rb'"[^"]*"')
_STRING_END = re.compile(rb'(?:[^"\\]|\\.)*"', re.DOTALL)
_TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*"|["{}\[\]]', re.DOTALL)


def _advance(text: bytes, quoted: bool) -> tuple[bool, int]:
    """Whether the end of ``text`` is inside a string, and by how much brackets outside of strings go deeper.

    Escapes go first, inside of strings or not, so that beginning inside always ends opposite to beginning outside.
    """
    bare = _ESCAPE.sub(b"", text) if b"\\" in text else text
    if quoted:
        end = bare.find(b'"')
        if end < 0:
            return True, 0
        bare = bare[end + 1 :]
    bare = _STRING.sub(b"", bare) if b'"' in bare else bare
    opened = bare.find(b'"')
    if opened >= 0:
        bare = bare[:opened]
    return opened >= 0, bare.count(b"{") + bare.count(b"[") - bare.count(b"}") - bare.count(b"]")


class _FeatureScanner:
    """Features are the objects two brackets deep: in an array of the one object of the file."""

    DEPTH = 2

    def __init__(self, state: tuple[bool, int] | None):
        self.quoted, self.depth = state or (False, 0)
        self.inside = self.depth > self.DEPTH
        self.parts: list[bytes] = []

    def feed(self, text: bytes) -> bytes | None:
        text += b"}"
        if self.depth > self.DEPTH:
            self.parts.append(text)
            self.quoted, deeper = _advance(text, self.quoted)
            self.depth += deeper
            return self._taken() if self.depth == self.DEPTH else None
        at = 0
        if self.quoted:
            end = _STRING_END.match(text)
            if not end:
                return None
            self.quoted, at = False, end.end()
        for token in _TOKEN.finditer(text, at):
            sign = token.group()
            if sign == b"{" and self.depth == self.DEPTH:
                start = token.start()
                self.parts.append(text[start:])
                self.quoted, deeper = _advance(text[start:], False)
                self.depth += deeper
                return self._taken() if self.depth == self.DEPTH else None
            if sign == b'"':
                self.quoted = True
                return None
            self.depth += (sign in b"{[") - (sign in b"}]")
        return None

    def _taken(self) -> bytes:
        record, self.parts = b"".join(self.parts), []
        return record


def _depths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per byte range, what it does to a state outside and inside of a string."""
    found: dict[tuple[str, int], list[list]] = {}
    for key, value in _ranges(batches):
        states = found.setdefault(key, [[False, 0], [True, 0]])
        for state in states:
            state[0], deeper = _advance(value + b"}", state[0])
            state[1] += deeper
    rows = [(*key, outside[0], outside[1], inside[1]) for key, (outside, inside) in found.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "block", "flips", "outside", "inside"])


def read_geojson_split(spark: SparkSession, path: str) -> DataFrame:
    """Feature collections of any size, a feature per row, columns as from ``read_geojson_lines``.

    Unlike ``read_geojson``, a file is read by as many tasks as it has byte ranges. Objects in arrays of the collection
    that are no features are left out; a damaged feature raises.
    """
    parts = _parts(spark, path, "}")
    ranges = parts.mapInArrow(_depths, "file string, block bigint, flips boolean, outside bigint, inside bigint")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    quoted = ranges.withColumn("quoted", F.coalesce(F.sum(F.col("flips").cast("int")).over(earlier), F.lit(0)) % 2 == 1)
    change = F.when(F.col("quoted"), F.col("inside")).otherwise(F.col("outside"))
    deep = quoted.select(*RANGE, "quoted", F.coalesce(F.sum(change).over(earlier), F.lit(0)).alias("depth"))
    states = {(row.file, row.block): (row.quoted, row.depth) for row in deep.where("quoted or depth <> 0").collect()}
    texts = _records(parts, _FeatureScanner, states).select(F.col("record").cast("string").alias("text"))
    feature = F.from_json("text", FEATURE_SCHEMA, {"mode": "FAILFAST"})
    none = F.lit(None).cast("string")
    features = texts.select(feature.alias("feature")).where(F.col("feature.type") == "Feature")
    return features.select(none.alias("type"), none.alias("name"), F.array("feature").alias("features"))
