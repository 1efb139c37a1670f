"""Held-out accuracy, exact neighbours against brute force, and odd rows."""

import random
import zlib
from zlib import crc32

import numpy as np
import pytest

from lettora.llm.quality_knn import KnnSpec, fit_space, fitted_space, quality_scores, term_counts
from lettora.llm.queries import op8_quality_classifier

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = op8_quality_classifier(spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)
    judged = [(labels[r.doc_id], r.predicted, r.score) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(y == p for y, p, _ in judged) >= 0.97 * len(judged)
    good, bad = ([s for y, _, s in judged if y == label] for label in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert sum(p == 0 for y, p, _ in judged if y == 0) >= 0.9 * len(bad)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality")
    kept = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    other = spark.createDataFrame(kept, labels.schema)
    assert sorted(quality_scores(docs, labels).collect()) == sorted(quality_scores(docs, other).collect())


def test_neighbours_are_exact():
    rng = random.Random(1)
    texts = [" ".join(rng.choices("abcdefghijklm" if i % 3 else "nopqrstuvw", k=30)).encode() for i in range(200)]
    labels = np.array([int(i % 3 > 0) for i in range(200)])
    spec = KnnSpec(dimensions=8, neighbours=7, block_rows=9)
    space = fit_space([term_counts(t, spec.bins) for t in texts], labels, spec)
    vectors = np.stack([space.vector(term_counts(t, spec.bins)) for t in texts[:40]])
    scores = space.scores(np.concatenate((vectors, np.zeros((1, vectors.shape[1]), np.float32))))
    assert scores[-1] == labels.mean()
    for vector, score in zip(vectors, scores):
        cosines = space.vectors.astype(float) @ (vector / np.linalg.norm(vector))
        near = np.argsort(-cosines)[:7]
        weights = np.maximum(cosines[near], 0) ** spec.sharpness
        assert score == pytest.approx((weights * labels[near]).sum() / weights.sum(), abs=1e-3)


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["aa", "bb", "cc", "dd"] if i % 2 else ["X!!", "Y!!", "Z!!"], k=40))) for i in range(80)]
    rows += [(3, rows[3][1]), (None, rows[5][1]), (None, None), (81, ""), (82, "never seen"), (83, "aa bb " * 200_000)]
    docs = spark.createDataFrame([(*r, 0.5, 9) for r in rows], "doc_id long, text string, score double, quality int")
    marks = [(i, i % 2) for i in range(60)] + [(7, 0), (None, 1), (999, 1), (8, None)]
    labels = spark.createDataFrame([(*m, "x") for m in marks], "doc_id long, quality int, text string")
    found = quality_scores(docs, labels).collect()
    assert len(found) == len(rows)
    assert all(r.predicted == r.doc_id % 2 for r in found if r.doc_id is not None and 60 <= r.doc_id < 80)
    assert {r.score > 0.5 for r in found if r.doc_id in (3, 83)} == {True}
    assert all(r.score is not None for r in found) and all(r.held_out is False for r in found if r.doc_id is None)
    assert {r.score for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(docs.limit(0), labels).count() == 0


def test_labels_of_other_documents_change_nothing(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["aa", "bb", "cc", "dd"] if i % 2 else ["X!!", "Y!!", "Z!!"], k=40))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    foreign = spark.range(1000, 200_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    spec = KnnSpec(fit_rows=40)
    alone = {r.doc_id: r.score for r in quality_scores(docs, labels, spec).collect()}
    assert {r.doc_id: r.score for r in quality_scores(docs, labels.union(foreign), spec).collect()} == alone
    assert len(set(alone.values())) > 1


def test_a_rare_kind_reaches_the_sample(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(["X!!", "Y!!", "Z!!"] if i % 100 == 1 else ["aa", "bb", "cc", "dd"], k=40))) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 100 != 1)) for i in range(1000)], "doc_id long, quality int")
    space = fitted_space(docs, labels, KnnSpec(fit_rows=40))
    assert len(space.labels) == 40 and 5 <= (space.labels == 0).sum() <= 10
    known = sum(1 for i in range(1000) if crc32(str(i).encode()) % 5)
    assert space.importance.sum() == pytest.approx(known) and np.average(space.labels, weights=space.importance) > 0.98
    wrong = [r for r in quality_scores(docs, labels, KnnSpec(fit_rows=40)).collect() if r.predicted != int(r.doc_id % 100 != 1)]
    assert not wrong
