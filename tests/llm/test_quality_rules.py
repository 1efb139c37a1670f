"""Statistics against a plain version, verdicts against labels and hand-made rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettora.llm.quality_rules import (
    COUNTS,
    ForestSpec,
    best_threshold,
    fit_forest,
    keep_good,
    quality_verdicts,
    repeated_words,
    statistics,
)
from lettora.llm.queries import op2_quality_rules

FOLDER = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


TEXTS = [None, "", " \n\t", "a", "a a a a", "x y z x y z", "é ü|<b>\n é ü|<b>\n\né ü|<b>\n", "a\x0bb\x0cc\x85d e", "#*$%&|<>"]


@pytest.mark.parametrize("text", [*TEXTS, " ".join(random.Random(1).choices("abcd", k=400))])
def test_statistics(text):
    assert statistics(None if text is None else text.encode(), 3)[:5] == plain(text)


def test_repeated_windows_of_a_very_long_text():
    words = [b"%d" % i for i in range(300_000)]
    assert repeated_words(words + words[:5], 3) == 10


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    found = {r.doc_id: r for r in op2_quality_rules(spark, FOLDER).collect()}
    assert found.keys() == docs.keys()
    for doc_id, row in found.items():
        counts = plain(docs[doc_id]) if len(docs[doc_id]) < 4000 else statistics(docs[doc_id].encode(), 3)[:5]
        assert tuple(row[name] for name in COUNTS) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert row.base_failed == failed and not (failed and row.kept)
    judged = [(quality[i], row.kept) for i, row in found.items() if i in quality and not row.base_failed]
    assert sum(kept for label, kept in judged if label) >= 0.99 * sum(label for label, _ in judged)
    assert sum(not kept for label, kept in judged if not label) >= 0.9 * sum(not label for label, _ in judged)


def test_odd_rows(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 9))) for _ in range(400)]
    rows = [(i, ". ".join(" ".join(rng.choices(words, k=9)).capitalize() for _ in range(12))) for i in range(60)]
    rows += [(100 + i, " ".join(f"{rng.randint(0, 10**6)}$$$***" for _ in range(80))) for i in range(8)]
    rows += [(1, rows[1][1]), (None, rows[2][1]), (None, None), (200, "")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, kept int, row string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i in [*range(0, 60, 2), *range(100, 106)]], "doc_id long, quality int")
    found = quality_verdicts(docs, labels).collect()
    assert len(found) == len(rows)
    assert all(r.kept == (r.doc_id is not None and r.doc_id < 100 or r.doc_id is None and r.n_words > 0) for r in found)
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 62
    assert quality_verdicts(docs.limit(0), labels).count() == 0
    unlabelled = quality_verdicts(docs, labels.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in unlabelled)


def test_rows_go_to_python_once_and_are_judged_alike(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 9))) for _ in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(30, 99))).capitalize(), f"own {i}") for i in range(80)]
    rows += [(100 + i, " ".join(f"{rng.randint(0, 10**6)}$$$***" for _ in range(80)), None) for i in range(8)]
    rows += [(200, None, "a"), (201, "", "b"), (202, "one two three " * 40, "c"), rows[5], (None, rows[6][1], "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, anomaly string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i in [*range(0, 80, 2), *range(100, 106)]], "doc_id long, quality int")
    for marks in (labels, labels.limit(0)):
        verdicts = {r.doc_id: r.kept for r in quality_verdicts(docs, marks).collect()}
        kept = keep_good(docs, marks)
        assert sorted(map(tuple, kept.collect()), key=repr) == sorted((r for r in rows if verdicts[r[0]]), key=repr)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1  # two workers a task, and two ways for every text, else
    assert 0 < sum(verdicts.values()) < len(verdicts)


def test_labels_that_the_sample_misses_count(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 9))) for _ in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=99)).capitalize()) for i in range(400)]
    rows += [(1000 + i, " ".join(f"{rng.randint(0, 10**6)}$$$***" for _ in range(80))) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows], "doc_id long, quality int")
    spec = ForestSpec(fit_rows=64, max_clean_loss=0.01)
    hashed = docs.orderBy(F.xxhash64("doc_id")).limit(spec.fit_rows).collect()
    assert all(r.doc_id < 1000 for r in hashed)  # the sample has good rows only
    kept = {r.doc_id: r.kept for r in quality_verdicts(docs, labels, spec=spec).collect()}
    assert not kept[1000] and not kept[1001] and sum(kept.values()) >= 396
    good = quality_verdicts(docs, labels.where("quality = 1"), spec=spec).collect()
    assert all(r.kept and r.anomaly == 0 for r in good)


def test_forest_isolates_outliers_and_copes_with_constants():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(500, 3))
    points[:, 2] = 1
    forest = fit_forest(points, ForestSpec())
    assert forest.score(np.array([[9.0, 9.0, 1.0]]))[0] > 0.6 > forest.score(np.zeros((1, 3)))[0]
    same = fit_forest(np.ones((10, 2)), ForestSpec())
    assert np.isfinite(same.score(np.ones((2, 2)))).all()


def test_threshold_keeps_the_clean():
    table = np.zeros((2, 10), int)
    table[1, :6], table[0, 7:] = 100, 5
    assert 0.6 <= best_threshold(table, ForestSpec()) <= 0.7
    table[1, 9] = 100
    assert best_threshold(table, ForestSpec()) > 0.9
