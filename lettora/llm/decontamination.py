"""Benchmark decontamination: which training documents contain which test items.

The test items form a BM25 inverted index; every passage of every document is a query. Term weights are divided by the
item's score against itself, so 1 means that the passage holds all terms of the item, and one threshold serves all
items. Postings are in blocks of ``block_items`` items with the highest weight per block (block-max).

1. Bound, vectorised over a document: rare terms of a passage add up their block maxima; to that comes, per block, the
   most that frequent terms can give. Passages without a block at the threshold are done: nothing there can reach it.
2. Block-max WAND for the passages left: cursors over the posting lists jump past items and blocks whose bounds stay
   below the threshold. All items at or above it are retrieved.
3. Check: the last sentence of an item is taken as its answer, the rest as its question. Five-word shingles of the
   whole item must be in the passage to ``overlap``, those of either part to ``part_overlap``.

Passages are twice as long as the longest item and overlap by half, so any copy of an item lies within one passage.
Items are counted first: an index of more than ``index_bytes`` of item text is split, and the documents are read once
per part; term statistics always cover all items. Only one part is on the driver and in the tasks at a time.

Defined cases: words are compared without case and ASCII punctuation. Items of fewer words than a shingle are not
searched, as nothing could confirm them. NULL or empty texts give nothing. Rows that repeat a ``doc_id`` or have none
are searched one by one; items that repeat each match. Without items or documents the result is empty.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructType

from lettora.llm.tables import map_batches
from lettora.sources.shared import written


@dataclass(frozen=True)
class LeakSpec:
    threshold: float = 0.7
    shingle_words: int = 5
    overlap: float = 0.8
    part_overlap: float = 0.5
    k1: float = 1.2
    b: float = 0.75
    block_items: int = 4
    rare_share: float = 0.2
    min_stride: int = 32
    index_bytes: int = 32 << 20


_PLAIN = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")
_CHUNKS_AT_ONCE = 256
_END = 1 << 62


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").decode("utf-8", "replace").lower().encode().translate(_PLAIN).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The last sentence with words is the answer; of a single sentence, the last third of its words."""
    parts = [words for part in _SENTENCE_END.split(text) if (words := words_of(part.encode()))]
    if len(parts) > 1:
        return sum(parts[:-1], []), parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def least_share(words: list[bytes], weights: dict[bytes, float], spec: LeakSpec) -> float:
    """A bound on how much of the weights (which sum to 1) a passage holds that holds ``overlap`` of the shingles.

    A term that is missing takes all shingles with it away, and a shingle has at most ``shingle_words`` terms: so terms
    can be missing as long as their shingles, added up, are no more than that times those that may be missing. The
    heaviest such terms, the last one in part, are what a passage can lack at most.
    """
    size = min(spec.shingle_words, len(words))
    shingles = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
    missing = next((m for m in range(len(shingles), -1, -1) if (len(shingles) - m) / len(shingles) >= spec.overlap), 0)
    touched = Counter(term for shingle in shingles for term in set(shingle))
    room, lacking = size * missing, 0.0
    for term in sorted(touched, key=lambda t: (-weights[t] / touched[t], t)):
        if touched[term] <= missing and room > 0:
            lacking += weights[term] * min(1.0, room / touched[term])
            room -= touched[term]
    return max(1.0 - lacking, 0.01)


def shingle_share(words: list[bytes], held: set[tuple], size: int) -> float:
    """Share of the shingles of ``words`` in ``held``; words shorter than a shingle are looked for as they are."""
    size = min(size, len(words))
    shingles = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()
    return sum(s in held for s in shingles) / len(shingles) if shingles else 1.0


# --- index ------------------------------------------------------------------------------------------------------------


class ItemIndex:
    """Block-max inverted index of items given as (item id, text), with statistics over all items of the benchmark."""

    def __init__(self, items: list[tuple], frequency: dict[bytes, int], n_items: int, mean_words: float, spec: LeakSpec):
        self.spec, self.ids = spec, [item_id for item_id, _ in items]
        self.parts = [question_and_answer(text) for _, text in items]
        self.words = [question + answer for question, answer in self.parts]
        self.vocabulary = {t: k for k, t in enumerate(sorted({t for words in self.words for t in words}))}
        self.stride = max([spec.min_stride, *map(len, self.words)])
        self.needed: list[float] = []
        postings: list[dict[int, float]] = [{} for _ in self.vocabulary]
        for item, words in enumerate(self.words):
            length = spec.k1 * (1 - spec.b + spec.b * len(words) / mean_words)
            weights = {}
            for term, count in Counter(words).items():
                idf = log(1 + (n_items - frequency[term] + 0.5) / (frequency[term] + 0.5))
                weights[self.vocabulary[term]] = idf * count * (spec.k1 + 1) / (count + length)
            whole = sum(weights.values())
            shares = {t: weights[self.vocabulary[t]] / whole for t in set(words)}
            # In units of what the item needs, so that one threshold of 1 serves all.
            self.needed.append(min(spec.threshold, least_share(words, shares, spec)))
            for term, weight in weights.items():
                postings[term][item] = weight / whole / self.needed[item]
        self.postings = postings
        self.items = [list(p) for p in postings]
        self.best = [max(p.values()) for p in postings]
        self.blocks: list[dict[int, float]] = []
        for p in postings:
            blocks: dict[int, float] = {}
            for item, weight in p.items():
                blocks[item // spec.block_items] = max(weight, blocks.get(item // spec.block_items, 0.0))
            self.blocks.append(blocks)
        self.n_blocks = -(-len(items) // spec.block_items)
        most = max(1, int(spec.rare_share * self.n_blocks))
        self.rare = np.array([len(blocks) <= most for blocks in self.blocks] + [False])  # the last: unknown words
        frequent = np.zeros(self.n_blocks * spec.block_items)
        for term, p in enumerate(postings):
            if not self.rare[term]:
                for item, weight in p.items():
                    frequent[item] += weight
        self.from_frequent = frequent.reshape(-1, spec.block_items).max(axis=1)
        self.starts = np.cumsum([0] + [len(blocks) for blocks in self.blocks])
        self.block_of = np.array([block for blocks in self.blocks for block in blocks], np.int64)
        self.block_max = np.array([weight for blocks in self.blocks for weight in blocks.values()])

    def passages(self, words: list[bytes]) -> Iterator[int]:
        """Starts of passages with a block whose bound reaches the threshold."""
        get = self.vocabulary.get
        terms = np.fromiter((get(word, -1) for word in words), np.int64, len(words))
        chunks = -(-len(words) // self.stride)
        for first in range(0, max(1, chunks - 1), _CHUNKS_AT_ONCE):
            last = min(chunks, first + _CHUNKS_AT_ONCE + 1)
            part = terms[first * self.stride : last * self.stride]
            rare = np.flatnonzero(self.rare[part])
            pairs = np.unique(rare // self.stride * len(self.postings) + part[rare])
            chunk, term = np.divmod(pairs, len(self.postings))
            many = self.starts[term + 1] - self.starts[term]
            at = np.arange(many.sum()) + np.repeat(self.starts[term] - (np.cumsum(many) - many), many)
            cell = np.repeat(chunk, many) * self.n_blocks + self.block_of[at]
            bound = np.bincount(cell, self.block_max[at], (last - first) * self.n_blocks).reshape(-1, self.n_blocks)
            if last - first > 1:
                bound = bound[:-1] + bound[1:]
            near = (bound + self.from_frequent >= 1 - 1e-9).any(axis=1)
            yield from ((first + np.flatnonzero(near)) * self.stride).tolist()

    def search(self, terms: set[int]) -> list[tuple[int, float]]:
        """Items, with scores in units of what they need, that reach 1: block-max WAND, one item at a time."""
        threshold, size = 1 - 1e-9, self.spec.block_items
        cursors = [[self.items[term][0], term, 0] for term in terms]
        found = []

        def advance(cursor: list, item: int) -> None:
            listed = self.items[cursor[1]]
            cursor[2] = bisect_left(listed, item, cursor[2])
            cursor[0] = listed[cursor[2]] if cursor[2] < len(listed) else _END

        while True:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, cursor in enumerate(cursors):
                bound += self.best[cursor[1]] if cursor[0] < _END else 0.0
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            upto, block = cursors[: pivot + 1], item // size
            if sum(self.blocks[c[1]].get(block, 0.0) for c in upto) < threshold:
                beyond = cursors[pivot + 1][0] if pivot + 1 < len(cursors) else _END
                target = min((block + 1) * size, beyond)
            elif cursors[0][0] == item:
                score = sum(self.postings[c[1]][item] for c in upto)
                if score >= threshold:
                    found.append((item, score))
                target = item + 1
            else:
                target = item
            for cursor in upto:
                if cursor[0] < target:
                    advance(cursor, target)

    def leaks(self, raw: bytes | None) -> list[tuple]:
        """(item id, score, question overlap, answer overlap), the best passage of each item found in a text."""
        if not self.ids:
            return []
        words, size, best = words_of(raw), self.spec.shingle_words, {}
        for start in self.passages(words):
            passage = words[start : start + 2 * self.stride]
            known = {self.vocabulary[word] for word in passage if word in self.vocabulary}
            hits = self.search(known) if known else []
            lengths = {min(size, len(p)) for item, _ in hits for p in (self.words[item], *self.parts[item])}
            held = {tuple(passage[i : i + n]) for n in lengths for i in range(len(passage) - n + 1)}
            for item, score in hits:
                question, answer = (shingle_share(part, held, size) for part in self.parts[item])
                whole = shingle_share(self.words[item], held, size)
                if whole >= self.spec.overlap and min(question, answer) >= self.spec.part_overlap:
                    best[item] = max(best.get(item, (0.0, 0.0, 0.0)), (score * self.needed[item], question, answer))
        return [(self.ids[item], *found) for item, found in sorted(best.items())]


def item_indexes(items: DataFrame, spec: LeakSpec = LeakSpec()) -> Iterator[ItemIndex]:
    """The index in parts of about ``index_bytes`` of text each, one after another."""
    schema = StructType().add("item_id", LongType()).add("text", "string").add("words", ArrayType(BinaryType()))
    slim = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))

    def split(batch: pa.RecordBatch) -> Iterator[tuple]:
        yield *batch.columns, [sum(question_and_answer(text.as_py()), []) for text in batch.column(1)]

    listed = written(map_batches(slim, split, schema).where(F.size("words") > 0), "items")
    n_items, mean_words, n_bytes = listed.agg(
        F.count(F.lit(1)), F.avg(F.size("words")), F.sum(F.octet_length("text"))
    ).first()
    parts = max(1, -(-(n_bytes or 0) // spec.index_bytes))
    terms = listed.select(F.explode(F.array_distinct("words")).alias("term"), F.xxhash64("item_id", "text").alias("h"))
    counted = written(terms.groupBy("term").count(), "item_terms") if parts > 1 else terms.groupBy("term").count()
    for part in range(parts):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part
        rows = sorted(((r[0], r[1]) for r in listed.where(mine).select("item_id", "text").collect()), key=repr)
        needed = terms.where(F.pmod("h", F.lit(parts)) == part).select("term").distinct()
        frequency = {bytes(r[0]): r[1] for r in counted.join(needed, "term").collect()}
        yield ItemIndex(rows, frequency, n_items, mean_words or 1.0, spec)


# --- documents --------------------------------------------------------------------------------------------------------


def _leak_rows(batch: pa.RecordBatch, index: ItemIndex) -> Iterator[tuple]:
    found = [(i, *leak) for i, raw in enumerate(batch.column(2)) for leak in index.leaks(raw.as_py())]
    at, *columns = zip(*found) if found else ((), (), (), (), ())
    at = pa.array(at, pa.int64())
    yield batch.column(0).take(at), batch.column(1).take(at), *columns


def benchmark_leaks(documents: DataFrame, items: DataFrame, spec: LeakSpec = LeakSpec()) -> DataFrame:
    """``doc_id``, ``text_hash``, ``item_id``, ``score``, ``question_overlap``, ``answer_overlap`` of every leak."""
    schema = StructType().add("doc_id", LongType()).add("text_hash", LongType()).add("item_id", LongType())
    for name in ("score", "question_overlap", "answer_overlap"):
        schema.add(name, DoubleType())
    slim = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary")
    )
    found = None
    for index in item_indexes(items, spec):
        part = written(map_batches(slim, _leak_rows, schema, index), "leaks")
        found = part if found is None else found.union(part)
    return found


def without_leaks(documents: DataFrame, items: DataFrame, spec: LeakSpec = LeakSpec()) -> DataFrame:
    """The rows of ``documents``, with all their columns, that contain no test item."""
    identity = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    leaks = benchmark_leaks(documents, items, spec).select(F.struct("doc_id", "text_hash").alias("identity")).distinct()
    rows = documents.select(F.struct("*").alias("row"), identity.alias("identity"))
    return rows.join(leaks, "identity", "left_anti").select("row.*")
