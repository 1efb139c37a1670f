"""Quality rules: countable statistics of a text, two fixed rules, and an isolation forest on the statistics.

An isolation forest splits a few rows at random positions of random statistics until each stands alone. Unusual rows
are alone after few splits, so a short mean path marks an anomaly. The forest is fitted on a bounded sample of labelled
rows (``ForestSpec.fit_rows``); the threshold is calibrated on all labelled rows: of all scores that reject at most
``max_clean_loss`` of the rows labelled good, the one that rejects most rows labelled bad.

Statistics are computed once per document, in one pass over whole texts, and written; text itself is never shuffled.
Where whole rows are to be kept, a second pass computes and scores them together, so that a text goes to Python once.

Defined cases: a NULL or blank text has no words and fails. A word is a run of characters other than the six ASCII
blanks. Rows that repeat a ``doc_id``, or have none, are judged one by one. Labels that contradict each other for a
``doc_id`` count each. Without labels of both kinds there is no verdict beyond the fixed rules. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from lettora.llm.tables import map_batches
from lettora.sources.shared import written

SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_distinct", "n_upper", "n_letters", "n_marks", "n_wordless"]


@dataclass(frozen=True)
class RuleLimits:
    min_words: int = 50
    max_repeat_percent: int = 50
    window_words: int = 3


@dataclass(frozen=True)
class ForestSpec:
    """``fit_rows`` bounds the labelled rows that come to the driver for fitting; ``bins`` the calibration table."""

    fit_rows: int = 4096
    trees: int = 200
    rows_per_tree: int = 64
    seed: int = 11
    bins: int = 2000
    max_clean_loss: float = 0.001


# --- statistics -------------------------------------------------------------------------------------------------------


def repeated_words(words: list[bytes], window: int) -> int:
    """Words inside a window of ``window`` words that occurs at least twice, the first occurrence included."""
    if len(words) <= window:
        return 0
    ids: dict[bytes, int] = {}
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    keys = np.zeros(len(words) - window + 1, np.int64)
    for k in range(window):
        # Renumbering keeps the product of two numbers below 2^63 for any text.
        keys = keys * len(ids) + numbers[k : k + len(keys)]
        if k:
            keys = np.unique(keys, return_inverse=True)[1]
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(np.bincount(keys)[keys] > 1)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def statistics(raw: bytes | None, window: int) -> tuple[int, ...]:
    """``COUNTS`` and ``EXTRA`` of a UTF-8 text."""
    raw = raw or b""
    words = raw.split()
    codes = np.frombuffer(raw, np.uint8)
    freq = np.bincount(codes, minlength=256)
    continuation = int(freq[0x80:0xC0].sum())
    blanks = int(freq[[9, 10, 11, 12, 13, 32]].sum())
    upper, lower = int(freq[65:91].sum()), int(freq[97:123].sum())
    ascii_marks = int(freq[33:48].sum() + freq[58:65].sum() + freq[91:97].sum() + freq[123:127].sum())
    lines = Counter(line for line in raw.split(b"\n") if line.strip())
    distinct = Counter(words)
    return (
        len(words),
        len(raw) - continuation - blanks,
        int(freq[list(SYMBOLS)].sum()),
        sum(lines.values()) - len(lines),
        repeated_words(words, window),
        len(distinct),
        upper,
        upper + lower + int(freq[0xC0:].sum()),
        ascii_marks,
        sum(n for word, n in distinct.items() if not word.strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")),
    )


def _counts(texts: pa.Array, window: int) -> np.ndarray:
    found = np.array([statistics(raw.as_py(), window) for raw in texts], np.int64)
    return found.reshape(-1, len(COUNTS + EXTRA))


def _statistic_rows(batch: pa.RecordBatch, window: int) -> Iterator[tuple]:
    yield batch.column("doc_id"), *_counts(batch.column("raw"), window).T


def rule_statistics(documents: DataFrame, limits: RuleLimits = RuleLimits()) -> DataFrame:
    """``doc_id``, the counts, and ``base_failed``: too few words, or too many inside repeated windows."""
    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw"))
    counted = map_batches(slim, _statistic_rows, _with_counts(slim.schema.fields[:1]), limits.window_words)
    return counted.withColumn("base_failed", _base_failed(limits))


def _with_counts(fields: list[StructField]) -> StructType:
    return StructType([*fields, *(StructField(name, LongType()) for name in COUNTS + EXTRA)])


def _base_failed(limits: RuleLimits) -> Column:
    repeats = 100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    return (F.col("n_words") < limits.min_words) | repeats


def features(counts: np.ndarray) -> np.ndarray:
    """Ratios, so that a text is not unusual for its length alone. ``counts`` has a column per ``COUNTS + EXTRA``.

    Repeated lines and windows are left to the fixed rule: many good texts quote the same line several times.
    """
    words, chars, symbols, _, _, distinct, upper, letters, marks, wordless = counts.T.astype(float)
    per_word = np.maximum(words, 1)
    # Distinct words fall with length, by a power; the exponent takes that out.
    variety = distinct / per_word**0.9
    capitals, marked = upper / np.maximum(letters, 1), marks / np.maximum(chars, 1)
    return np.stack((chars / per_word, symbols / per_word, variety, capitals, marked, wordless / per_word), axis=1)


# --- isolation forest -------------------------------------------------------------------------------------------------


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` rows: what an unsplit leaf still hides."""
    n = np.maximum(np.asarray(n, float), 1)
    harmonic = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Complete binary trees as arrays: node ``i`` has children ``2i+1`` and ``2i+2``; ``feature`` is -1 at a leaf."""

    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray
    usual: float

    def score(self, points: np.ndarray) -> np.ndarray:
        """0 to 1; above one half is unusual."""
        total = np.zeros(len(points))
        rows = np.arange(len(points))
        for feature, split, path in zip(self.feature, self.split, self.path):
            at = np.zeros(len(points), np.int64)
            while (inner := feature[at] >= 0).any():
                right = points[rows, feature[at]] >= split[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            total += path[at]
        return 2.0 ** (-total / len(self.feature) / self.usual)


def fit_forest(points: np.ndarray, spec: ForestSpec) -> Forest:
    rng = np.random.default_rng(spec.seed)
    size = min(spec.rows_per_tree, len(points))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((spec.trees, nodes), -1)
    split, path = np.zeros((spec.trees, nodes)), np.zeros((spec.trees, nodes))
    for tree in range(spec.trees):
        todo = [(0, 0, points[rng.choice(len(points), size, replace=False)])]
        while todo:
            node, level, rows = todo.pop()
            low, high = rows.min(axis=0), rows.max(axis=0)
            usable = np.flatnonzero(high > low)
            if level == depth or len(rows) < 2 or not len(usable):
                path[tree, node] = level + _mean_path(len(rows))
                continue
            pick = rng.choice(usable)
            at = rng.uniform(low[pick], high[pick])
            feature[tree, node], split[tree, node] = pick, at
            right = rows[:, pick] >= at
            todo += [(2 * node + 1, level + 1, rows[~right]), (2 * node + 2, level + 1, rows[right])]
            if right.all() or not right.any():  # the split fell on the smallest value
                todo[-2:] = []
                feature[tree, node], path[tree, node] = -1, level + _mean_path(len(rows))
    return Forest(feature, split, path, float(_mean_path(size)))


# --- verdicts ---------------------------------------------------------------------------------------------------------


def _scores(counts: np.ndarray, forest: Forest | None) -> np.ndarray:
    return np.zeros(len(counts)) if forest is None else forest.score(features(counts))


def _scored_rows(batch: pa.RecordBatch, forest: Forest | None) -> Iterator[tuple]:
    counts = [batch.column(name).to_numpy(zero_copy_only=False) for name in COUNTS + EXTRA]
    yield *batch.columns, _scores(np.stack(counts, axis=1).reshape(-1, len(COUNTS + EXTRA)), forest)


def anomaly_scores(statistics_: DataFrame, forest: Forest | None) -> DataFrame:
    schema = StructType([*statistics_.schema.fields]).add("anomaly", DoubleType())
    return map_batches(statistics_, _scored_rows, schema, forest)


def _judged_rows(batch: pa.RecordBatch, window: int, forest: Forest | None) -> Iterator[tuple]:
    counts = _counts(batch.column("row").field("text").cast(pa.binary()), window)
    yield batch.column("row"), *counts.T, _scores(counts, forest)


def best_threshold(table: np.ndarray, spec: ForestSpec) -> float:
    """``table[label, bin]`` counts labelled rows; a row is rejected when its score is at least the threshold.

    Among thresholds that reject equally many bad rows, the middle one is taken.
    """
    rejected = np.concatenate((table[:, ::-1].cumsum(axis=1)[:, ::-1], np.zeros((2, 1), np.int64)), axis=1)
    allowed = np.flatnonzero(rejected[1] <= spec.max_clean_loss * table[1].sum())
    best = allowed[rejected[0, allowed] == rejected[0, allowed].max()]
    return float((best.min() + best.max()) / 2 / table.shape[1]) if rejected[0, best[0]] else 1.1


def fit_rules(statistics_: DataFrame, labels: DataFrame, spec: ForestSpec = ForestSpec()) -> tuple[Forest | None, float]:
    """The forest, from a bounded sample, and its threshold, from a histogram over all labelled rows."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    columns = ["doc_id", *COUNTS, *EXTRA]
    usable = statistics_.where("not base_failed").select(*columns).join(marks.where("quality in (0, 1)"), "doc_id")
    usable = written(usable, "labelled")
    sample = usable.orderBy(F.xxhash64("doc_id"), *columns, "quality").limit(spec.fit_rows).toPandas()
    if not len(sample):
        return None, 1.1
    forest = fit_forest(features(sample[COUNTS + EXTRA].to_numpy()), spec)
    bin_of = F.least(F.floor(F.col("anomaly") * spec.bins), F.lit(spec.bins - 1)).cast("int")
    counted = anomaly_scores(usable, forest).groupBy("quality", bin_of.alias("bin")).count().collect()
    table = np.zeros((2, spec.bins), np.int64)
    for label, at, count in counted:
        table[label, at] = count
    # The sample may miss the rarer label; the table has every labelled row.
    return (forest, best_threshold(table, spec)) if table.any(axis=1).all() else (None, 1.1)


def quality_verdicts(
    documents: DataFrame,
    labels: DataFrame,
    limits: RuleLimits = RuleLimits(),
    spec: ForestSpec = ForestSpec(),
) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``anomaly`` (0 to 1) and ``kept``."""
    counted = written(rule_statistics(documents, limits), "statistics")
    forest, threshold = fit_rules(counted, labels, spec)
    return anomaly_scores(counted, forest).withColumn("kept", _kept(threshold))


def _kept(threshold: float) -> Column:
    return ~F.col("base_failed") & (F.col("anomaly") < threshold)


def keep_good(
    documents: DataFrame,
    labels: DataFrame,
    limits: RuleLimits = RuleLimits(),
    spec: ForestSpec = ForestSpec(),
) -> DataFrame:
    """The rows of ``documents`` that are kept, with all their columns. Rows are judged in place: no join, no shuffle.

    The whole row travels in ``row``, a struct, so that no column name clashes; one worker of a task counts and scores it.
    """
    counted = written(rule_statistics(documents, limits), "statistics")
    forest, threshold = fit_rules(counted, labels, spec)
    rows = documents.select(F.struct("*").alias("row"))
    schema = _with_counts(rows.schema.fields).add("anomaly", DoubleType())
    judged = map_batches(rows, _judged_rows, schema, limits.window_words, forest)
    return judged.withColumn("base_failed", _base_failed(limits)).where(_kept(threshold)).select("row.*")
