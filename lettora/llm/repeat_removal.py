"""Suffix-array dedup: remove every byte that lies in a long string (400 bytes) which also starts somewhere else.

No single index could hold a corpus, so places that may match are first brought together, then indexed in many small
run-length indexes:

1. Texts are combined by a hash of the whole text (copies before the shuffle) and written once, bucketed by that hash, so
   that the two later joins to them move no text.
2. Every window of 400 bytes is governed by an anchor, the least hash among its 64-byte strings (``anchors``). Equal
   windows have equal anchors. A run of windows with one anchor is a segment; only its key, place and hash travel.
3. Anchors that stand in one place of the corpus are dropped: nothing there repeats. Of the others, a segment whose bytes
   occur twice repeats as a whole, and one of each different segments goes on, with its bytes.
4. Segments are dealt to buckets of bounded bytes, all of an anchor to the same one. A bucket becomes a run-length index
   (``run_index``): transform as runs, samples at run ends, matching statistics streamed from them. Windows that match
   somewhere else for 400 bytes or more are marked.
5. An anchor with more different segments than a bucket may hold, such as that of a license text in very many documents,
   is decided without a limit: 128-bit fingerprints of its windows are counted over all tasks, combined before the
   shuffle, and the segments with a repeated one are marked.
6. Marks return to all places of their segment, are merged per text, and cut out of it.

Segments next to each other share 399 bytes, one less than a match needs, so a text does not match itself by them.

Defined cases: a NULL or empty text has no bytes and keeps the hash of the empty text. A text that occurs twice or more is
removed whole if it has 400 bytes, and otherwise kept. Repeated rows are copies like any other. Texts are bytes, valid
UTF-8 or not; what remains of them is returned as bytes. Only ``doc_id`` and ``text`` are read. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructType

from lettora.llm.anchors import anchored_runs, gram_hashes
from lettora.llm.run_index import repeated_spans
from lettora.operators.skew import skew_join
from lettora.params import SkewLimits
from lettora.sources.shared import fresh_path, written


@dataclass(frozen=True)
class RepeatSpec:
    """``bucket_bytes`` is about what one index holds, and the most different bytes an anchor may bring into one."""

    length: int = 400
    gram: int = 64
    bucket_bytes: int = 1_500_000
    most_windows: int = 1024


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# --- texts ------------------------------------------------------------------------------------------------------------


def _sha(raw: Column | str) -> Column:
    return F.unhex(F.sha2(raw, 256))


def rows_of(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``sha`` and ``n_bytes`` of every row."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    slim = documents.select(F.col("doc_id").cast("long"), _sha(raw).alias("sha"), F.length(raw).cast("long").alias("n_bytes"))
    return written(slim, "rows")


def distinct_texts(documents: DataFrame, spec: RepeatSpec) -> tuple[DataFrame, str]:
    """Different texts (``tid``, ``raw``) that are long enough, bucketed by ``tid``, and the name of their table."""
    raw = F.col("text").cast("binary").alias("raw")
    texts = documents.select(raw).where(F.length("raw") >= spec.length).select(_tid(_sha("raw")), "raw")
    spark = documents.sparkSession
    name = f"texts_{uuid.uuid4().hex}"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = texts.dropDuplicates(["tid"]).write.bucketBy(tasks, "tid").option("compression", "zstd")
    writer.option("path", fresh_path(spark, "texts")).saveAsTable(name)
    return spark.table(name), name


def _tid(sha: Column | str) -> Column:
    return F.substring(sha, 1, 16).alias("tid")


# --- segments ---------------------------------------------------------------------------------------------------------

_SEGMENT = StructType().add("tid", BinaryType()).add("first", IntegerType()).add("size", IntegerType())
_SEGMENT.add("anchor", LongType()).add("times", IntegerType()).add("sid", BinaryType())


def _segment_rows(batches: Iterator[pa.RecordBatch], spec: RepeatSpec) -> Iterator[pa.RecordBatch]:
    arrow = _arrow(_SEGMENT)
    for batch in batches:
        for tid, raw in zip(batch.column("tid"), batch.column("raw")):
            data = raw.as_py()
            anchors, first, last, times = anchored_runs(np.frombuffer(data, np.uint8), spec.length, spec.gram, spec.most_windows)
            stop = last + spec.length
            sids = [xxhash.xxh3_128_digest(data[f:s]) for f, s in zip(first.tolist(), stop.tolist())]
            tids = pa.array([tid.as_py()] * len(first), pa.binary())
            yield _batch([tids, first, stop - first, anchors.view(np.int64), times, sids], arrow)


def repeated_segments(texts: DataFrame, spec: RepeatSpec, limits: SkewLimits) -> DataFrame:
    """The segments whose anchor stands in two or more places of the corpus."""
    segments = written(texts.mapInArrow(lambda batches: _segment_rows(batches, spec), _SEGMENT), "segments")
    counted = segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.sum("times").alias("times"))
    counted = written(counted.where("times > 1").select("anchor", "n"), "anchors")
    return written(skew_join(segments, counted.select("anchor"), ["anchor"], "inner", limits, counted), "repeated")


def _cut_rows(batches: Iterator[pa.RecordBatch], schema: StructType) -> Iterator[pa.RecordBatch]:
    arrow = _arrow(schema)
    for batch in batches:
        for raw, wanted in zip(batch.column("raw"), batch.column("wanted")):
            data, parts = raw.as_py(), pa.RecordBatch.from_struct_array(wanted.values)
            first, size = parts.column("first").to_numpy(), parts.column("size").to_numpy()
            bytes_ = [data[f : f + n] for f, n in zip(first.tolist(), size.tolist())]
            yield _batch([*(parts.column(name) for name in arrow.names[:-1]), bytes_], arrow)


def with_bytes(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """``wanted`` (``tid``, ``first``, ``size`` and more) with the ``bytes`` of each segment; ``tid`` and ``first`` go."""
    keys = F.collect_list(F.struct(*(name for name in wanted.columns if name != "tid"))).alias("wanted")
    kept = [f for f in wanted.schema.fields if f.name not in ("tid", "first", "size")]
    schema = StructType(kept).add("bytes", BinaryType())
    joined = texts.join(wanted.groupBy("tid").agg(keys), "tid")
    return joined.select("raw", "wanted").mapInArrow(lambda batches: _cut_rows(batches, schema), schema)


# --- marks ------------------------------------------------------------------------------------------------------------

_SPANS = ArrayType(StructType().add("start", IntegerType()).add("stop", IntegerType()))
_MARK = StructType().add("sid", BinaryType()).add("spans", _SPANS)


def _mark_bucket(bucket: pa.Table, length: int) -> pa.Table:
    arrow = _arrow(_MARK)
    found = repeated_spans(bucket.column("bytes").to_pylist(), length)
    known = bucket.column("known").to_pylist()
    rows = [(sid, spans) for sid, spans, whole in zip(bucket.column("sid").to_pylist(), found, known) if spans and not whole]
    spans = [[{"start": a, "stop": b} for a, b in spans] for _, spans in rows]
    return pa.table([pa.array([sid for sid, _ in rows], pa.binary()), pa.array(spans, arrow.field("spans").type)], schema=arrow)


def indexed_marks(segments: DataFrame, texts: DataFrame, spec: RepeatSpec) -> DataFrame:
    """Marks of different ``segments`` by an index per bucket."""
    length = spec.length
    cut = with_bytes(segments.select("tid", "first", "size", "sid", "bucket", "known"), texts)
    return cut.groupBy("bucket").applyInArrow(lambda bucket: _mark_bucket(bucket, length), _MARK)


_WINDOW = StructType().add("sid", BinaryType()).add("at", IntegerType()).add("known", IntegerType())
_WINDOW.add("f1", LongType()).add("f2", LongType())


def _window_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    arrow = _arrow(_WINDOW)
    for batch in batches:
        for sid, known, raw in zip(batch.column("sid"), batch.column("known"), batch.column("bytes")):
            data = np.frombuffer(raw.as_py(), np.uint8)
            f1, f2 = (gram_hashes(data, length, seed).view(np.int64) for seed in (1, 2))
            n = len(f1)
            yield _batch([[sid.as_py()] * n, np.arange(n, dtype=np.int32), np.full(n, known.as_py(), np.int32), f1, f2], arrow)


def counted_marks(segments: DataFrame, texts: DataFrame, spec: RepeatSpec, limits: SkewLimits) -> DataFrame:
    """Marks of different ``segments`` by the fingerprints of their windows, whatever their number."""
    length = spec.length
    cut = with_bytes(segments.select("tid", "first", "size", "sid", "known"), texts)
    windows = written(cut.mapInArrow(lambda batches: _window_rows(batches, length), _WINDOW), "windows")
    twice = windows.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = written(twice, "repeated_windows")
    mine = windows.where("known = 0")
    hit = skew_join(mine, twice.select("f1", "f2"), ["f1", "f2"], "inner", limits, twice)
    span = F.struct(F.col("at").alias("start"), (F.col("at") + length).cast("int").alias("stop"))
    return hit.groupBy("sid").agg(F.collect_list(span).alias("spans")).select("sid", F.col("spans").cast(_SPANS))


def marks(repeated: DataFrame, texts: DataFrame, spec: RepeatSpec, limits: SkewLimits) -> DataFrame:
    """``sid`` and ``spans`` of different segments; NULL spans mean the whole segment."""
    place = F.min(F.struct("tid", "first")).alias("place")
    different = repeated.groupBy("sid").agg(F.count(F.lit(1)).alias("n"), F.max("anchor").alias("anchor"), F.max("size").alias("size"), place)
    different = written(different.select("sid", "n", "anchor", "size", "place.tid", "place.first"), "different")
    whole = different.where("n > 1").select("sid", F.lit(None).cast(_SPANS).alias("spans"))
    # An anchor whose segments all repeat as a whole needs no index.
    totals = different.groupBy("anchor").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("m"), F.count_if(F.col("n") == 1).alias("open"))
    totals = written(totals.where("open > 0").select("anchor", "bytes", F.col("m").alias("n")), "anchor_bytes")
    small = F.col("bytes") <= spec.bucket_bytes
    held = totals.agg(F.sum(F.when(small, F.col("bytes"))).alias("b"), F.count_if(~small).alias("large")).first()
    buckets = max(1, -(-(held.b or 0) // spec.bucket_bytes))
    found = different.select("sid", "anchor", "size", "tid", "first", (F.col("n") > 1).cast("int").alias("known"))
    found = written(skew_join(found, totals.select("anchor", "bytes"), ["anchor"], "inner", limits, totals.select("anchor", "n")), "open_segments")
    bucket = F.pmod(F.col("anchor"), F.lit(buckets)).alias("bucket")
    out = whole.union(indexed_marks(found.where(small).select("*", bucket), texts, spec))
    if held.large:
        out = out.union(counted_marks(found.where(~small), texts, spec, limits))
    return written(out, "marks")


# --- documents --------------------------------------------------------------------------------------------------------

_KEPT = StructType().add("tid", BinaryType()).add("n_removed", LongType()).add("n_spans", LongType())
_KEPT.add("kept", BinaryType())


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that meet or overlap as one, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(stop, out[-1][1])
        else:
            out.append((start, stop))
    return out


def _kept_rows(batches: Iterator[pa.RecordBatch], hashed: bool, schema: StructType) -> Iterator[pa.RecordBatch]:
    arrow = _arrow(schema)
    for batch in batches:
        rows = []
        for tid, raw, spans in zip(batch.column("tid"), batch.column("raw"), batch.column("spans")):
            data, gone = raw.as_py(), pa.RecordBatch.from_struct_array(spans.values)
            cut = merged(list(zip(gone.column("start").to_pylist(), gone.column("stop").to_pylist())))
            ends = [0, *(stop for _, stop in cut)]
            kept = b"".join(data[a:b] for a, b in zip(ends, [*(start for start, _ in cut), len(data)]))
            kept = hashlib.sha256(kept).hexdigest() if hashed else kept
            rows.append((tid.as_py(), sum(b - a for a, b in cut), len(cut), kept))
        if rows:
            yield _batch(list(zip(*rows)), arrow)


@dataclass(frozen=True)
class Repeats:
    """All rows (``rows_of``), the different long texts, and which spans of these repeat (``tid``, ``spans``)."""

    rows: DataFrame
    texts: DataFrame
    table: str
    spans: DataFrame
    length: int

    def kept(self, hashed: bool = False) -> DataFrame:
        """What remains of texts with repeated spans: ``tid``, ``n_removed``, ``n_spans`` and ``kept``, as bytes or SHA-256."""
        schema = StructType(_KEPT.fields[:-1]).add("kept", StringType() if hashed else BinaryType())
        joined = self.texts.join(self.spans, "tid").select("tid", "raw", "spans")
        return joined.mapInArrow(lambda batches: _kept_rows(batches, hashed, schema), schema)

    def drop(self) -> None:
        """Forget the table of texts. Its files are in the shared folder."""
        self.texts.sparkSession.sql(f"drop table if exists {self.table}")


def repeats(documents: DataFrame, spec: RepeatSpec = RepeatSpec(), limits: SkewLimits = SkewLimits()) -> Repeats:
    """Find what repeats in ``documents``; building this runs jobs."""
    rows = rows_of(documents)
    texts, name = distinct_texts(documents, spec)
    repeated = repeated_segments(texts, spec, limits)
    marked = marks(repeated, texts, spec, limits)
    per_segment = repeated.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))
    places = skew_join(repeated.select("tid", "first", "size", "sid"), marked, ["sid"], "inner", limits, per_segment)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("size").alias("stop")))
    shifted = F.transform(F.coalesce("spans", whole), lambda s: F.struct((s.start + F.col("first")).alias("start"), (s.stop + F.col("first")).alias("stop")))
    # A text's spans are bounded by the text.
    spans = places.select("tid", shifted.cast(_SPANS).alias("spans")).groupBy("tid").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return Repeats(rows, texts, name, written(spans, "spans"), spec.length)


def repeat_digest(documents: DataFrame, spec: RepeatSpec = RepeatSpec(), limits: SkewLimits = SkewLimits()) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row."""
    found = repeats(documents, spec, limits)
    kept = written(found.kept(hashed=True), "kept")
    found.drop()
    copies = written(found.rows.groupBy("sha").agg(F.count(F.lit(1)).alias("n")), "copies")
    info = copies.select("sha", "n", _tid("sha")).join(kept, "tid", "left").drop("tid")
    joined = skew_join(found.rows, info.withColumnRenamed("n", "copies"), ["sha"], "inner", limits, copies)
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= spec.length)

    def decided(all_of: Column, part: str, none: Column) -> Column:
        return F.when(whole, all_of).otherwise(F.coalesce(part, none))

    return joined.select(
        "doc_id",
        "n_bytes",
        decided(F.col("n_bytes"), "n_removed", F.lit(0)).cast("long").alias("n_removed"),
        decided(F.lit(1), "n_spans", F.lit(0)).cast("long").alias("n_spans"),
        decided(F.sha2(F.lit(b""), 256), "kept", F.lower(F.hex("sha"))).alias("kept_sha256"),
    )
