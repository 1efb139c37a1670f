"""WARC archives: write pages, normalise monolithic gzip files, read records by offset.

A WARC file that was compressed as one gzip stream can only be read from its start. The normaliser inflates such a file
once, front to back, in pieces; every record it meets becomes a gzip member of its own, appended to the normalised
archive, and a sidecar index lists offset and length, so any record can be read alone.

Files are written and read by Spark's own text and binary sources, so archives can lie wherever Spark can write. The text
writer ends every row with a separator: for records of a monolithic file that is the record's own end mark; for members
it is their last byte, which is zero (the top byte of a length below 16 MB; longer records get an empty member after
them, which ends in zero too).

Copies: of pages with equal payloads of at least ``min_revisit_bytes``, the one of the largest ``page_id`` is written
whole and the others as revisits of it. A payload that very many pages share is split by ``skew_join``.

Defined cases: a NULL html is an empty payload. Rows that repeat the largest ``page_id`` of a payload are all whole; a
row without ``page_id`` revisits one that has it, else it is whole. NULL urls are left out of the header. Line breaks in
a url are percent-encoded. A file that ends inside a record or a member raises. No pages give empty archives.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from lettora.llm.tables import map_batches
from lettora.operators.skew import skew_join
from lettora.sources.shared import fresh_path, written

CRLF = "\r\n"
RECORD_END = CRLF * 2
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PIECE = 1 << 20
#: More than the headers of a record take, but for a very long address.
_HEADER_BYTES = 2048


@dataclass(frozen=True)
class WarcSpec:
    """A monolithic file holds at most ``records_per_file`` records, and no more than make ``file_bytes`` if all are as long
    as the longest payload (but one at least)."""

    min_revisit_bytes: int = 1000
    records_per_file: int = 5000
    file_bytes: int = 256 << 20
    date: str = "1970-01-01T00:00:00Z"


# --- writing ----------------------------------------------------------------------------------------------------------


def with_record_types(pages: DataFrame, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``payload_bytes``, ``payload_digest``, ``refers_to`` (NULL: written whole)."""
    html = F.coalesce("html", F.lit(""))
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"), html.alias("html"))
    slim = slim.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("payload_digest", F.sha1("html"))
    large = slim.where(F.col("payload_bytes") >= spec.min_revisit_bytes).groupBy("payload_digest", "payload_bytes")
    copies = large.agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = written(copies, "copies")
    keys = ["payload_digest", "payload_bytes"]
    joined = skew_join(slim, copies.drop("n"), keys, "left", counted=copies.select(*keys, "n"))
    return joined.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))).drop("keeper")


def _field(name: str, value: Column | str) -> Column:
    """A header line; NULL values give no line."""
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)))


def records(typed: DataFrame, spec: WarcSpec = WarcSpec()) -> Column:
    """The whole record, without its end mark."""
    whole = F.col("refers_to").isNull()
    length = F.concat(F.lit("Content-Length: "), F.col("payload_bytes"), F.lit(RECORD_END))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"), length)
    block = F.when(whole, F.concat(http, F.col("html"))).otherwise(http)
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    name = F.xxhash64("page_id", "url", "payload_digest")
    lines = [
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.when(whole, "response").otherwise("revisit")),
        _field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(":"), F.hex(name), F.lit(">"))),
        _field("WARC-Date", spec.date),
        _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("WARC-Profile", F.when(~whole, PROFILE)),
        _field("X-Refers-To-Page", F.col("refers_to")),
        _field("X-Page-ID", F.col("page_id")),
        _field("X-Payload-Length", F.col("payload_bytes")),
        _field("Content-Type", "application/http; msgtype=response"),
        _field("Content-Length", F.octet_length(block)),
    ]
    return F.concat(F.concat_ws("", *lines), F.lit(CRLF), block)


def write_monolithic(pages: DataFrame, path: str, spec: WarcSpec = WarcSpec()) -> None:
    """One record per page; every file is a single gzip stream."""
    typed = with_record_types(pages, spec)
    longest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    most = max(1, min(spec.records_per_file, spec.file_bytes // (longest + _HEADER_BYTES)))
    writer = typed.select(records(typed, spec).alias("value")).write
    writer = writer.option("compression", "gzip").option("lineSep", RECORD_END)
    writer.option("maxRecordsPerFile", most).text(path)


# --- records in Python ------------------------------------------------------------------------------------------------


def inflated(content: memoryview) -> Iterator[bytes]:
    """The inflated bytes of a gzip file, in pieces; files of several members are accepted."""
    while len(content):
        stream, at = zlib.decompressobj(31), 0
        while not stream.eof:
            if at >= len(content):
                raise ValueError("gzip stream ends early")
            taken = content[at : at + _PIECE]
            at += len(taken)
            while len(taken):
                yield stream.decompress(taken, 8 * _PIECE)
                taken = stream.unconsumed_tail
        content = content[at - len(stream.unused_data) :]


def split_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Header fields (lower-case names), block and raw bytes of each record; only one record is held at a time."""
    source, buffer = iter(pieces), bytearray()

    def fill(size: int) -> bool:
        while len(buffer) < size:
            piece = next(source, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    end = RECORD_END.encode()
    while fill(1):
        seen = 0
        while (at := buffer.find(end, max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not fill(seen + 1):
                raise ValueError("WARC file ends inside a header")
        first, *lines = bytes(buffer[:at]).decode("utf-8", "replace").split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        start, size = at + len(end), int(fields["content-length"])
        if not fill(start + size + len(end)) or buffer[start + size : start + size + len(end)] != end:
            raise ValueError("WARC record of another length than its header says")
        raw = bytes(buffer[: start + size + len(end)])
        del buffer[: len(raw)]
        yield fields, raw[start : start + size], raw


def member(raw: bytes) -> bytes:
    """``raw`` as gzip members whose last byte is zero."""
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packed.compress(raw) + packed.flush()
    if out[-1]:
        empty = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += empty.flush()
    return out


# --- normalising ------------------------------------------------------------------------------------------------------

_PART = StructType().add("part", StringType()).add("archive", StringType()).add("ordinal", LongType()).add("value", BinaryType())
_BATCH_BYTES = 16 << 20
INDEX_SCHEMA = "record_id string, record_type string, offset long, length long"


def _part_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for archive, content in zip(*batch.columns):
        name, offset, ordinal, held, lines, rows = archive.as_py(), 0, 0, 0, [], []
        for fields, _, raw in split_records(inflated(memoryview(content.as_buffer()))):
            packed = member(raw)
            place = {"record_id": fields.get("warc-record-id"), "record_type": fields.get("warc-type")}
            lines.append(json.dumps(place | {"offset": offset, "length": len(packed)}))
            rows.append(("archives", name, ordinal, packed[:-1]))  # the writer adds the last byte
            offset, ordinal, held = offset + len(packed), ordinal + 1, held + len(packed)
            if held > _BATCH_BYTES:
                rows.append(("index", name, ordinal, "\n".join(lines).encode()))
                yield zip(*rows)
                held, lines, rows = 0, [], []
        if rows:
            rows.append(("index", name, ordinal, "\n".join(lines).encode()))
            yield zip(*rows)


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite every gzip file under ``source`` as one archive of members, with a sidecar index, under ``target``.

    One pass without a shuffle writes both: ``target/part=archives/archive=.../`` holds the members of a file and
    ``target/part=index/archive=.../`` JSON lines with their places. A monolithic file is one task by nature.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    base = F.regexp_replace(F.regexp_replace("path", r"^.*/", ""), r"[^A-Za-z0-9_-]", "_")
    named = files.select(F.concat_ws("-", base, F.substring(F.md5("path"), 1, 8)).alias("archive"), "content")
    parts = map_batches(named, _part_rows, _PART).sortWithinPartitions("part", "archive", "ordinal")
    lined = parts.select("part", "archive", F.col("value").cast("string"))
    lined.write.partitionBy("part", "archive").option("lineSep", "\0").text(target)


# --- reading ----------------------------------------------------------------------------------------------------------

_PAGE = StructType().add("page_id", LongType()).add("payload_bytes", LongType()).add("payload_digest", StringType())
_PAGE.add("record_type", StringType()).add("refers_to", LongType()).add("url", StringType())


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """The sidecar index: ``archive``, ``record_id``, ``record_type``, ``offset`` and ``length`` of every record."""
    files = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\0").text(target)
    # Of no record there is no folder either, so the name of the archive is read from the path.
    lines = files.where(F.col("_metadata.file_path").contains("/part=index/"))
    lines = lines.select(F.regexp_extract("_metadata.file_path", "archive=([^/]+)/", 1).alias("archive"), "value")
    lines = lines.select("archive", F.explode(F.split("value", "\n")).alias("line"))
    return lines.select("archive", F.from_json("line", INDEX_SCHEMA).alias("place")).select("archive", "place.*")


def _archives(spark: SparkSession, target: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(target)
    files = files.where(F.col("path").contains("/part=archives/"))
    return files.select(F.regexp_extract("path", "archive=([^/]+)/", 1).alias("archive"), "content")


def _number(text: str | None) -> int | None:
    return int(text) if text else None


def page_of(fields: dict[str, str], block: bytes) -> tuple:
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    size, kind = int(fields["x-payload-length"]), fields["warc-type"]
    if kind == "response":
        payload = block[block.index(RECORD_END.encode()) + len(RECORD_END) :]
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its header")
    page_id, refers_to = _number(fields.get("x-page-id")), _number(fields.get("x-refers-to-page"))
    return page_id, size, digest, kind, refers_to, fields.get("warc-target-uri")


def _page_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for content in batch.column(0):
        records_ = split_records(inflated(memoryview(content.as_buffer())))
        while rows := [page_of(fields, block) for fields, block, _ in islice(records_, 1000)]:
            yield zip(*rows)


def read_pages(spark: SparkSession, target: str) -> DataFrame:
    """A row per record of all normalised archives, read member after member; payloads are verified."""
    return map_batches(_archives(spark, target).select("content"), _page_rows, _PAGE)


def _placed_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for content, places in zip(*batch.columns):
        content, rows = memoryview(content.as_buffer()), []
        for place in places.as_py():
            piece = content[place["offset"] : place["offset"] + place["length"]]
            ((fields, block, _),) = split_records(inflated(piece))
            rows.append(page_of(fields, block))
        if rows:
            yield zip(*rows)


def read_places(spark: SparkSession, target: str, places: DataFrame) -> DataFrame:
    """The records at some rows of the index, each inflated alone."""
    wanted = places.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("places"))
    return map_batches(_archives(spark, target).join(wanted, "archive").select("content", "places"), _placed_rows, _PAGE)


def archive_round_trip(pages: DataFrame, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """Write ``pages`` as monolithic files to the shared folder, normalise them, and read all records back by the index."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_monolithic(pages, f"{path}/monolithic", spec)
    normalise(spark, f"{path}/monolithic", f"{path}/normal")
    return read_places(spark, f"{path}/normal", read_index(spark, f"{path}/normal"))
