"""Line dedup: drop lines that many documents share, everywhere but in one document.

1. One pass over the texts writes a 128-bit hash for every distinct long line of a document.
2. Hashes are counted and dealt to shards. A shard of about ``shard_keys`` distinct hashes becomes one row: a minimal
   perfect hash (bit arrays, level by level: hashes alone in their slot are placed, the others go on) that numbers the
   hashes without gaps, and the arrays of fingerprint, count and keeping document in that order.
3. Documents' hashes are sent to their shard, where they probe the arrays; only those to be dropped come back. A shard
   of a line that very many documents hold is split: its requests are salted, its small row is repeated.
4. What comes back, few hashes for few documents, is joined to the documents by their identity.

Defined cases: a NULL or empty text is one empty line. Every row is a document, so a row that occurs twice counts twice;
the rows of the largest ``doc_id`` keep the line. A line that only rows without ``doc_id`` hold is dropped nowhere; else
such rows lose it. All lines of a text may go: its text is then empty. Bytes that
are no UTF-8 stay as they are; each counts as a character or less. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from lettora.llm.tables import map_batches
from lettora.operators.columns import quoted
from lettora.operators.skew import SALTS, hot_keys
from lettora.params import SkewLimits
from lettora.sources.shared import written


@dataclass(frozen=True)
class LineSpec:
    min_chars: int = 40
    min_documents: int = 5
    shard_keys: int = 65_536
    requests_per_task: int = 131_072


# --- lines ------------------------------------------------------------------------------------------------------------


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of the line's key, without blanks around it and with A-Z lowered; None if the key is short."""
    key = line.strip().lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def _hash_rows(batch: pa.RecordBatch, min_chars: int) -> Iterator[tuple]:
    found, repeats = [], np.zeros(batch.num_rows, np.int64)
    for i, raw in enumerate(batch.column(2)):
        hashes = {line_hash(line, min_chars) for line in (raw.as_py() or b"").split(b"\n")} - {None}
        found += hashes
        repeats[i] = len(hashes)
    index = pa.array(np.repeat(np.arange(batch.num_rows), repeats))
    pairs = np.frombuffer(b"".join(found), ">i8").astype(np.int64).reshape(-1, 2)
    yield batch.column(0).take(index), batch.column(1).take(index), pairs[:, 0], pairs[:, 1]


def _identity(documents: DataFrame) -> list[Column]:
    """Rows that agree in both are the same document for every decision taken here."""
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash")]


def line_hashes(documents: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``h1``, ``h2``: a row per distinct long line of a document."""
    schema = StructType()
    for name in ("doc_id", "text_hash", "h1", "h2"):
        schema.add(name, LongType())
    slim = documents.select(*_identity(documents), F.col("text").cast("binary").alias("raw"))
    return map_batches(slim, _hash_rows, schema, min_chars)


# --- minimal perfect hash ---------------------------------------------------------------------------------------------


def _slots(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    x = (h1 ^ (h2 * np.uint64(2 * level + 1))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) % np.uint64(size)


def build_perfect_hash(h1: np.ndarray, h2: np.ndarray, gamma: float = 1.5) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays (uint64 words) per level, and the number each of the distinct pairs got."""
    levels: list[np.ndarray] = []
    left, number = np.arange(len(h1)), np.full(len(h1), -1)
    while len(left):
        size = 64 * (int(gamma * len(left)) // 64 + 1)
        slot = _slots(h1[left], h2[left], len(levels), size)
        alone = np.bincount(slot.astype(np.int64), minlength=size) == 1
        bits = np.packbits(alone, bitorder="little").view(np.uint64)
        levels.append(bits)
        left = left[~alone[slot.astype(np.int64)]]
    return levels, probe(levels, h1, h2)


def probe(levels: list[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The number of each pair; -1, or that of another pair, for pairs that were not built in."""
    number, todo, before = np.full(len(h1), -1), np.arange(len(h1)), 0
    for level, bits in enumerate(levels):
        slot = _slots(h1[todo], h2[todo], level, 64 * len(bits))
        word, bit = (slot >> np.uint64(6)).astype(np.int64), slot & np.uint64(63)
        hit = (bits[word] >> bit & np.uint64(1)).astype(bool)
        ones = np.bitwise_count(bits).astype(np.int64)
        rank = before + (np.cumsum(ones) - ones)[word] + np.bitwise_count(bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
        number[todo[hit]] = rank[hit]
        todo, before = todo[~hit], before + int(ones.sum())
    return number


# --- shards -----------------------------------------------------------------------------------------------------------

_SHARD = StructType().add("shard", LongType())
for _name in ("sizes", "bits", "fingerprints", "counts", "keepers", "keeps"):
    _SHARD.add(_name, BinaryType())


def _build_shard(key: tuple, group: pa.Table) -> pa.Table:
    h1, h2 = (group.column(name).to_numpy().view(np.uint64) for name in ("h1", "h2"))
    levels, number = build_perfect_hash(h1, h2)
    order = np.argsort(number)
    keeper = group.column("keeper")
    arrays = (
        np.array([len(bits) for bits in levels], np.int64),
        np.concatenate(levels),
        (h2[order] >> np.uint64(32)).astype(np.uint32),
        np.minimum(group.column("n").to_numpy(), 2**32 - 1).astype(np.uint32)[order],
        keeper.fill_null(0).to_numpy()[order],
        keeper.is_valid().to_numpy()[order],
    )
    row = {"shard": [key[0].as_py()]} | {f.name: [a.tobytes()] for f, a in zip(_SHARD.fields[1:], arrays)}
    return pa.table(row, schema=_arrow(_SHARD))


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _probe_shard(requests: pa.Table, shard: pa.Table, min_documents: int, schema: pa.Schema) -> pa.Table:
    if not requests.num_rows or not shard.num_rows:
        return schema.empty_table()
    kinds = {"sizes": np.int64, "bits": np.uint64, "fingerprints": np.uint32, "counts": np.uint32, "keepers": np.int64, "keeps": bool}
    sizes, bits, fingerprints, counts, keepers, keeps = (np.frombuffer(shard.column(n)[0].as_py(), t) for n, t in kinds.items())
    h1, h2 = (requests.column(name).to_numpy().view(np.uint64) for name in ("h1", "h2"))
    number = probe(np.split(bits, np.cumsum(sizes)[:-1]), h1, h2)
    found = (number >= 0) & (fingerprints[number] == (h2 >> np.uint64(32)).astype(np.uint32))
    doc_id = requests.column("doc_id")
    own = doc_id.is_valid().to_numpy() & (doc_id.fill_null(0).to_numpy() == keepers[number])
    drop = found & (counts[number] >= min_documents) & keeps[number] & ~own
    return requests.select(schema.names).filter(pa.array(drop)).cast(schema)


def shared_lines(lines: DataFrame, spec: LineSpec = LineSpec()) -> DataFrame:
    """Of ``line_hashes``, the rows whose line has to go."""
    counted = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
    counted = written(counted, "line_counts")
    shards = max(1, -(-counted.count() // spec.shard_keys))
    shard = F.pmod("h1", F.lit(shards)).alias("shard")
    index = counted.withColumn("shard", shard).groupBy("shard").applyInArrow(_build_shard, _SHARD)
    index = written(index, "line_index")
    sizes = counted.groupBy(shard).agg(F.sum("n").alias("n"))
    hot = written(hot_keys(sizes, ["shard"], SkewLimits(spec.requests_per_task)), "hot_shards")
    salts = F.coalesce(F.col(SALTS), F.lit(1)).cast("long")
    requests = lines.select("*", shard, F.spark_partition_id().alias("part")).join(hot, "shard", "left")
    # Rows that are equal in all columns differ in the partition of the table they are read from.
    spread = F.xxhash64("doc_id", "text_hash", "h1", "part")
    requests = requests.withColumn("salt", F.pmod(spread, salts)).drop(SALTS, "part")
    copies = index.join(hot, "shard", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop(SALTS)
    arrow, min_documents = _arrow(lines.schema), spec.min_documents

    def answer(requests: pa.Table, shard: pa.Table) -> pa.Table:
        return _probe_shard(requests, shard, min_documents, arrow)

    grouped = requests.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
    return grouped.applyInArrow(answer, lines.schema)


# --- documents --------------------------------------------------------------------------------------------------------


def _cut_rows(batch: pa.RecordBatch, min_chars: int) -> Iterator[tuple]:
    texts, n_lines, n_dropped = [], [], []
    for raw, gone in zip(batch.column(1), batch.column(2)):
        lines = (raw.as_py() or b"").split(b"\n")
        gone = set(gone.as_py() or ())
        kept = [line for line in lines if line_hash(line, min_chars) not in gone] if gone else lines
        texts.append(b"\n".join(kept))
        n_lines.append(len(lines))
        n_dropped.append(len(lines) - len(kept))
    yield batch.column(0), texts, n_lines, n_dropped


def dedup_lines(documents: DataFrame, spec: LineSpec = LineSpec()) -> DataFrame:
    """``row`` (the other columns as a struct), ``text`` without shared lines, ``n_lines`` before, ``n_dropped``."""
    lines = written(line_hashes(documents, spec.min_chars), "lines")
    identity = F.struct("doc_id", "text_hash").alias("identity")
    both = F.unhex(F.concat(*(F.lpad(F.hex(h), 16, "0") for h in ("h1", "h2"))))
    gone = shared_lines(lines, spec).groupBy(identity).agg(F.collect_set(both).alias("gone"))
    others = F.struct(*(documents[quoted(name)] for name in documents.columns if name != "text")).alias("row")
    raw = F.col("text").cast("binary").alias("raw")
    rows = documents.select(others, raw, F.struct(*_identity(documents)).alias("identity"))
    joined = rows.join(gone, "identity", "left").select("row", "raw", "gone")
    schema = StructType(joined.schema.fields[:1]).add("raw", BinaryType())
    schema.add("n_lines", LongType()).add("n_dropped", LongType())
    cut = map_batches(joined, _cut_rows, schema, spec.min_chars)
    return cut.select("row", F.col("raw").cast("string").alias("text"), "n_lines", "n_dropped")


def drop_shared_lines(documents: DataFrame, spec: LineSpec = LineSpec()) -> DataFrame:
    """``documents`` with shared lines cut from ``text``; ``n_chars``, where there is one, follows."""
    cut = dedup_lines(documents, spec)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    columns = [new[name] if name in new else F.col("row").getField(name) for name in documents.columns]
    return cut.select([column.alias(name) for column, name in zip(columns, documents.columns)])
