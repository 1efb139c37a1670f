"""Quality classifier: votes of the nearest labelled documents in a latent space.

Terms of a document are its words, the shapes of its words (capitals, letters, digits and marks, runs shortened) and,
where one word in eight or more repeats the one before, terms for that, hashed into ``bins``. Weighted by log frequency and rarity, the terms of a bounded sample of
labelled documents (``KnnSpec.fit_rows``, half of either label where there are enough) are reduced to ``dimensions`` by a truncated singular value decomposition. The
projection and the labelled vectors, whose size these parameters bound, go to all tasks. Every document is projected,
its cosines with all labelled vectors are computed exactly, block by block, and the ``neighbours`` nearest vote with the
weight of their similarity, and of how many documents of its label each stands for. No text is shuffled.

Defined cases: a text without known terms (NULL and empty ones too) scores the share of good labels. Rows that repeat a
``doc_id``, or have none, are scored one by one. Contradicting labels both vote. Labels of documents that are not there do not count. Without labels every score is 0.5. Ties
between neighbours are settled by their order in the sample, which is that of a hash. Texts are read whole; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StructType

from lettora.llm.tables import map_batches
from lettora.sources.shared import written


@dataclass(frozen=True)
class KnnSpec:
    fit_rows: int = 3000
    bins: int = 1 << 14
    max_terms: int = 6000
    min_documents: int = 2
    dimensions: int = 48
    neighbours: int = 25
    sharpness: float = 4.0
    block_rows: int = 512
    threshold: float = 0.3
    seed: int = 5


_SHAPE = bytes(
    65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256)
)
_REPEAT_TERMS, _REPEAT_SHARE = 12, 8
_RUN = re.compile(rb"(.)\1{2,}", re.S)


def term_counts(raw: bytes | None, bins: int) -> dict[int, float]:
    """Hashed terms of a UTF-8 text with their frequency."""
    raw = raw or b""
    counts: dict[int, float] = Counter()
    words = raw.lower().split()
    for word, n in Counter(words).items():
        counts[crc32(word) % bins] += n
    for shape, n in Counter(raw.translate(_SHAPE).split()).items():
        counts[crc32(b"shape " + _RUN.sub(rb"\1\1", shape)) % bins] += n
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    # One term would be lost among hundreds of words; several give repetition a direction of its own.
    for k in range(_REPEAT_TERMS if _REPEAT_SHARE * repeats >= len(words) > 0 else 0):
        counts[crc32(b"repeat %d" % k) % bins] += repeats
    return counts


@dataclass(frozen=True)
class Space:
    """``column``: bin -> row of ``project`` (-1: unused), with rarity and decomposition folded in; labelled vectors."""

    column: np.ndarray
    project: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    spec: KnnSpec
    importance: np.ndarray

    def vector(self, counts: dict[int, float]) -> np.ndarray:
        bins = np.fromiter(counts, np.int64, len(counts))
        column = self.column[bins]
        used = column >= 0
        weights = np.log1p(np.fromiter(counts.values(), np.float64, len(counts))[used]).astype(np.float32)
        return weights @ self.project[column[used]]

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Weighted share of good labels among the nearest; rows of zeros get the share in the sample."""
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
        units = vectors / np.maximum(lengths, 1e-12)
        out = np.full(len(vectors), np.average(self.labels, weights=self.importance) if len(self.labels) else 0.5)
        k = min(self.spec.neighbours, len(self.labels))
        for at in range(0, len(vectors) if k else 0, self.spec.block_rows):
            cosines = units[at : at + self.spec.block_rows] @ self.vectors.T
            nearest = np.sort(np.argpartition(-cosines, k - 1, axis=1)[:, :k], axis=1)
            weights = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0).astype(np.float64) ** self.spec.sharpness
            weights *= self.importance[nearest]
            total = weights.sum(axis=1)
            vote = (weights * self.labels[nearest]).sum(axis=1) / np.maximum(total, 1e-300)
            out[at : at + len(cosines)] = np.where((total > 0) & (lengths[at : at + len(cosines), 0] > 0), vote, out[at : at + len(cosines)])
        return np.clip(out, 0.0, 1.0)


def fit_space(
    rows: list[dict[int, float]], labels: np.ndarray, spec: KnnSpec, importance: np.ndarray | None = None
) -> Space:
    """Randomised truncated decomposition of the weighted sample. ``importance`` is what a vote of each row counts."""
    documents = Counter(b for counts in rows for b in counts)
    frequent = [(-n, b) for b, n in documents.items() if n >= min(spec.min_documents, len(rows))]
    chosen = [b for _, b in sorted(frequent)[: spec.max_terms]]
    column = np.full(spec.bins, -1)
    column[chosen] = np.arange(len(chosen))
    rarity = np.log((1 + len(rows)) / (1 + np.array([documents[b] for b in chosen], np.float32))).astype(np.float32) + 0.5
    matrix = np.zeros((len(rows), len(chosen)), np.float32)
    for i, counts in enumerate(rows):
        for b, n in counts.items():
            if column[b] >= 0:
                matrix[i, column[b]] = np.log1p(n)
    matrix *= rarity
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    size = min(spec.dimensions, *matrix.shape) if matrix.size else 0
    basis = np.random.default_rng(spec.seed).normal(size=(matrix.shape[1], min(size + 8, matrix.shape[1]))).astype(np.float32)
    for _ in range(4 if size else 0):
        left, _ = np.linalg.qr(matrix @ basis)
        basis, _ = np.linalg.qr(matrix.T @ left)
    if size:
        _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
        basis = basis @ right.T[:, :size]
    project = (rarity[:, None] * basis).astype(np.float32)
    vectors = matrix @ basis
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    importance = np.ones(len(rows)) if importance is None else importance
    return Space(column, project, vectors.astype(np.float32), labels.astype(np.float64), spec, importance)


# --- documents --------------------------------------------------------------------------------------------------------

_TERMS = StructType().add("quality", IntegerType()).add("order", LongType())
_TERMS.add("bins", ArrayType(IntegerType())).add("counts", ArrayType(FloatType()))


def _term_rows(batch: pa.RecordBatch, bins: int) -> Iterator[tuple]:
    found = [term_counts(raw.as_py(), bins) for raw in batch.column(2)]
    yield batch.column(0), batch.column(1), [list(c) for c in found], [list(c.values()) for c in found]


def held_out(doc_id: Column | str) -> Column:
    """Rows no label may be learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def fitted_space(documents: DataFrame, labels: DataFrame, spec: KnnSpec = KnnSpec()) -> Space:
    """From at most ``fit_rows`` labelled documents that are not held out, chosen by hash.

    Only labels of documents that there are count. Half of the sample is of either kind, as far as there are enough, so
    that a rare kind is in it; votes are weighed by how many documents of their kind one of the sample stands for.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.where(F.col("quality").isin(0, 1) & ~held_out("doc_id")).withColumn("order", F.xxhash64("doc_id"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw"))
    marks = written(marks.join(texts.select("doc_id").distinct(), "doc_id", "left_semi"), "labelled")
    counts = {row.quality: row.n for row in marks.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    half = spec.fit_rows // 2
    wanted = {kind: min(n, max(half, spec.fit_rows - counts.get(1 - kind, 0))) for kind, n in counts.items()}
    parts = [marks.where(F.col("quality") == kind).orderBy("order", "doc_id").limit(n) for kind, n in sorted(wanted.items())]
    if not parts:
        return fit_space([], np.zeros(0), spec)
    # At most fit_rows rows of three numbers each: safe to send to all tasks.
    chosen = F.broadcast(reduce(DataFrame.union, parts))
    # Texts are reduced to terms where they lie. Rows that repeat a doc_id vote each, up to the same bound per kind.
    rows = texts.join(chosen, "doc_id").select("quality", "order", "raw")
    terms = written(map_batches(rows, _term_rows, _TERMS, spec.bins), "terms")
    found = []
    for kind, n in sorted(wanted.items()):
        mine = terms.where(F.col("quality") == kind).orderBy("order", "bins", "counts").limit(n).collect()
        found += [(row, counts[kind] / len(mine)) for row in mine]
    sample = [dict(zip(row.bins, row.counts)) for row, _ in found]
    return fit_space(sample, np.array([row.quality for row, _ in found]), spec, np.array([n for _, n in found]))


def _score_rows(batch: pa.RecordBatch, space: Space) -> Iterator[tuple]:
    vectors = np.zeros((batch.num_rows, space.project.shape[1]), np.float32)
    for i, raw in enumerate(batch.column(1)):
        vectors[i] = space.vector(term_counts(raw.as_py(), space.spec.bins))
    yield batch.column(0), space.scores(vectors)


def quality_scores(documents: DataFrame, labels: DataFrame, spec: KnnSpec = KnnSpec()) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) of every document."""
    space = fitted_space(documents, labels, spec)
    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw"))
    scored = map_batches(slim, _score_rows, StructType().add("doc_id", LongType()).add("score", DoubleType()), space)
    predicted = (F.col("score") >= spec.threshold).cast("int").alias("predicted")
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", predicted)
