"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked when few bits differ.

All pairs of distinct fingerprints are compared exactly, tile against tile. Fingerprints are dealt to tiles in the order
of their population count, so a tile holds a narrow range of counts and meets only tiles whose counts come within the
radius: the number of differing bits is never below the difference of the counts. Inside a task the same bound, taken
over the four 16-bit quarters, skips blocks of a tile pair before exclusive-or and bit count.

A tile pair returns a spanning forest of its links, not the links: at most one edge per fingerprint, also for a group
of copies that holds a third of all rows. Equal fingerprints are one node from the start.

Defined cases: a NULL or blank text has fingerprint zero and is linked like any other. Every row is a document; rows
that repeat a ``doc_id`` each return a row. A NULL ``doc_id`` is kept and never the smallest; a component of such rows
only has component NULL. Texts of any length are read whole. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettora.llm.components import components
from lettora.llm.tables import map_batches
from lettora.operators.skew import skew_join
from lettora.sources.shared import written
from pyspark.sql.types import LongType, StructType

SEED = 42
SHINGLE_WORDS = 4
RADIUS = 4
TILE_ROWS = 32_768
BLOCK_ROWS = 256
_CHUNK = 1 << 16


def fingerprint(raw: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a UTF-8 text. ``bytes.lower`` and ``bytes.split`` know A-Z and the six ASCII blanks only."""
    words = (raw or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle_words:
        ends, starts = ends[shingle_words - 1 :], starts[: len(words) - shingle_words + 1]
    else:
        ends, starts = ends[-1:], starts[:1]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big", signed=True)


def _fingerprint_rows(batch: pa.RecordBatch, shingle_words: int) -> Iterator[tuple]:
    yield *batch.columns[:2], [fingerprint(raw.as_py(), shingle_words) for raw in batch.column(2)]


def _identity() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash")]


def fingerprints(documents: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``bits``, the fingerprint as a signed long."""
    schema = StructType().add("doc_id", LongType()).add("text_hash", LongType()).add("bits", LongType())
    slim = documents.select(*_identity(), F.col("text").cast("binary").alias("raw"))
    return map_batches(slim, _fingerprint_rows, schema, shingle_words)


# --- comparison of two tiles, in one task -----------------------------------------------------------------------------


def _blocked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by the counts of the four quarters; start, lowest and highest counts of every block."""
    counts = np.bitwise_count(values.view(np.uint16).reshape(-1, 4)).astype(np.int16)
    order = np.lexsort(counts.T[::-1])
    counts = counts[order]
    starts = np.arange(0, len(values), BLOCK_ROWS)
    low, high = np.minimum.reduceat(counts, starts), np.maximum.reduceat(counts, starts)
    return values[order], order, starts, low, high


def _merge(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Give linked positions a common label, the smallest; labels always point to a root."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(shorter := label[label], label):
            label[:] = shorter


def tile_links(first: np.ndarray, second: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within ``radius`` between two arrays (uint64), or inside the first."""
    a, _, a_starts, a_low, a_high = _blocked(first)
    b, _, b_starts, b_low, b_high = (a, None, a_starts, a_low, a_high) if second is None else _blocked(second)
    shift = 0 if second is None else len(a)
    label = np.arange(len(a) + (len(b) if shift else 0))
    for i, start in enumerate(a_starts):
        gap = np.maximum(np.maximum(b_low - a_high[i], a_low[i] - b_high), 0).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        block = a[start : start + BLOCK_ROWS, None]
        for at in b_starts[near[near >= i] if second is None else near]:
            hits = np.bitwise_count(block ^ b[None, at : at + BLOCK_ROWS]) <= radius
            if second is None and at == start:
                np.fill_diagonal(hits, False)
            if hits.any():
                x, y = np.nonzero(hits)
                _merge(label, x + start, y + at + shift)
    child = np.flatnonzero(label != np.arange(len(label)))
    values = np.concatenate((a, b)) if shift else a
    return values[child], values[label[child]]


def _link_rows(batch: pa.RecordBatch, radius: int) -> Iterator[tuple]:
    for tile, other, first, second in zip(*(column.to_pylist() for column in batch.columns)):
        first, second = np.array(first, np.int64).view(np.uint64), np.array(second, np.int64).view(np.uint64)
        u, v = tile_links(first, None if tile == other else second, radius)
        yield u.view(np.int64), v.view(np.int64)


# --- tiles ------------------------------------------------------------------------------------------------------------


def _at(values: list[int], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), index + 1)


def links(nodes: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges ``u``, ``v`` that connect the distinct ``bits`` of ``nodes`` wherever at most ``radius`` bits differ.

    Only the number of fingerprints per population count, at most 65 rows, comes to the driver.
    """
    schema = StructType().add("u", LongType()).add("v", LongType())
    count = F.bit_count("bits")
    sizes = dict(nodes.groupBy(count.alias("c")).agg(F.count(F.lit(1))).collect())
    per_count = [sizes.get(c, 0) for c in range(65)]
    offsets = [0, *accumulate(per_count)]
    rows = F.greatest(_at(per_count, count), F.lit(1))
    position = _at(offsets[:-1], count) + F.pmod(F.xxhash64("bits"), rows)
    dealt = nodes.select("bits", count.alias("c"), F.floor(position / tile_rows).alias("tile"))
    counts = F.min("c").alias("low"), F.max("c").alias("high")
    tiles = written(dealt.groupBy("tile").agg(F.collect_list("bits").alias("bits"), *counts), "tiles")
    # The first and the last tile that may hold a count within the radius of a count.
    first = [offsets[max(0, c - radius)] // tile_rows for c in range(65)]
    last = [max(0, offsets[min(64, c + radius) + 1] - 1) // tile_rows for c in range(65)]
    onward = F.explode(F.sequence(F.col("tile"), F.greatest("tile", _at(last, F.col("high")))))
    back = F.explode(F.sequence(F.least("tile", _at(first, F.col("low"))), F.col("tile")))
    left = tiles.select("tile", onward.alias("other"), F.col("bits").alias("first"))
    right = tiles.select(back.alias("tile"), F.col("tile").alias("other"), F.col("bits").alias("second"))
    # Both sides are sent by pair, so the pairs of one tile are as many tasks as they need.
    n_tiles = offsets[-1] // tile_rows + 1
    tasks = min(n_tiles * (n_tiles + 1) // 2, 20_000)
    left, right = (side.repartition(tasks, "tile", "other") for side in (left, right))
    pairs = left.join(right.hint("merge"), ["tile", "other"])
    return map_batches(pairs, _link_rows, schema, radius)


def _rooted(marked: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """Distinct ``bits`` with their ``root``, number of rows ``n``, smallest ``doc_id`` and first row."""
    # NULL would be the smallest member of a struct.
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    nodes = marked.groupBy("bits").agg(F.min("doc_id").alias("least"), F.min(row).alias("first"), F.count("*").alias("n"))
    nodes = written(nodes, "nodes")
    roots = components(links(nodes, radius, tile_rows)).withColumnRenamed("node", "bits")
    return written(nodes.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits")), "rooted")


def simhash_components(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest ``doc_id`` reachable by links."""
    marked = written(fingerprints(documents, shingle_words), "fingerprints")
    rooted = _rooted(marked, radius, tile_rows)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = written(skew_join(rooted.select("bits", "root"), least, ["root"]).select("bits", "component_id"), "classes")
    placed = skew_join(marked, classes, ["bits"], counted=rooted.select("bits", "n"))
    return placed.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """One row of ``documents`` per component, that of the smallest ``doc_id``, with all its columns."""
    marked = written(fingerprints(documents, shingle_words), "fingerprints")
    first = _rooted(marked, radius, tile_rows).groupBy("root").agg(F.min("first").alias("first"))
    identity = F.struct("first.doc_id", "first.text_hash").alias("identity")
    rows = documents.select(F.struct("*").alias("row"), F.struct(*_identity()).alias("identity"))
    # Rows that repeat both the doc_id and the text are combined before the shuffle, however many they are.
    kept = rows.dropDuplicates(["identity"]).join(first.select(identity), "identity", "left_semi")
    return kept.select("row.*")
