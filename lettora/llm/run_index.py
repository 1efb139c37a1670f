"""A run-length index over many short texts: suffixes in order, the runs of the transform, and what its run ends know.

Suffixes are ordered by prefix doubling. The Burrows-Wheeler transform is kept as its runs; only where a run begins or
ends is the length of the match with the suffix next to it measured. Between two of these samples it follows in text
order: if a suffix and its neighbour stand behind the same symbol, the suffixes one symbol longer are neighbours too, and
their match is one symbol longer. So matching statistics of all texts against everything else stream from the samples,
and texts that repeat a lot need few of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: Symbols of 9 bits that fit one key: the depth of the first order, doubled from there on.
FIRST = 7


@dataclass(frozen=True)
class RunIndex:
    """``symbols`` of all texts, a byte plus one, 0 behind each text. ``levels[k]`` ranks suffixes by 7 * 2^k symbols.

    ``suffixes`` is the order of all suffixes; ``heads`` and ``tails`` are the places in it where runs begin and end.
    """

    symbols: np.ndarray
    levels: list[np.ndarray]
    suffixes: np.ndarray
    heads: np.ndarray
    tails: np.ndarray
    starts: np.ndarray

    @property
    def runs(self) -> list[tuple[int, int]]:
        """Symbol and length of every run of the transform; 0 stands before the first symbol of a text."""
        before = np.concatenate(([0], self.symbols[:-1]))[self.suffixes[self.heads]]
        return list(zip(before.tolist(), (self.tails - self.heads + 1).tolist()))

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at ``p`` and ``q`` have in common; never beyond the end of a text."""
        at_p, at_q = p.astype(np.int64), q.astype(np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            equal = self.levels[k][at_p] == self.levels[k][at_q]
            at_p, at_q = at_p + equal * (FIRST << k), at_q + equal * (FIRST << k)
        equal = np.ones(len(p), bool)
        for _ in range(FIRST - 1):
            equal &= (self.symbols[at_p] == self.symbols[at_q]) & (self.symbols[at_p] > 0)
            at_p, at_q = at_p + equal, at_q + equal
        return at_p - p

    def _streamed(self, places: np.ndarray, beside: int) -> np.ndarray:
        """Matches of all suffixes with the one ``beside`` them, from those measured at ``places``."""
        size = len(self.symbols)
        inner = places[(places + beside >= 0) & (places + beside < size)]
        sample, sampled = np.zeros(size, np.int32), np.zeros(size, bool)
        sampled[self.suffixes[places]] = True
        here = self.suffixes[inner]
        sample[here] = self.common(here, self.suffixes[inner + beside])
        last = np.maximum.accumulate(np.where(sampled, np.arange(size, dtype=np.int32), 0))
        return sample[last] - (np.arange(size, dtype=np.int32) - last)

    def matching_statistics(self) -> np.ndarray:
        """For every place, the length of the longest match that starts there and also starts somewhere else."""
        return np.maximum(self._streamed(self.heads, -1), self._streamed(self.tails, 1))


def _ranks(ordered: np.ndarray, suffixes: np.ndarray, alone: np.ndarray | None = None) -> np.ndarray:
    """Ranks from 0, equal for equal keys; suffixes marked ``alone`` have one of their own."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if alone is not None:
        new |= alone[suffixes]
        new[1:] |= alone[suffixes[:-1]]
    rank = np.empty(len(ordered), np.int32)
    rank[suffixes] = np.cumsum(new, dtype=np.int32) - 1
    return rank


def build(texts: Sequence[bytes]) -> RunIndex:
    """The index of ``texts``. The ends of texts differ from each other, so no match reaches across."""
    ends = np.cumsum([len(text) + 1 for text in texts]) - 1
    size = int(ends[-1]) + 1
    symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int16) + 1
    symbols[ends] = 0
    left = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(size)  # symbols up to the end of the text
    key = np.zeros(size, np.int64)
    for i in range(FIRST):
        shifted = np.zeros(size, np.int64)
        shifted[: max(0, size - i)] = symbols[i:]
        key = key << 9 | np.where(left > i, shifted, 0)
    suffixes = np.argsort(key, kind="stable")
    rank = _ranks(key[suffixes], suffixes, left < FIRST)
    levels, depth = [rank], FIRST
    while int(rank.max()) < size - 1:
        further = np.zeros(size, np.int64)
        further[: max(0, size - depth)] = rank[depth:]
        key = rank.astype(np.int64) << 32 | further
        suffixes = np.argsort(key)
        rank = _ranks(key[suffixes], suffixes)
        levels.append(rank)
        depth *= 2
    starts = np.concatenate(([0], ends[:-1] + 1))
    # What stands before the first symbol of a text is the end of another one, and those are all different.
    before = np.concatenate(([0], symbols[:-1])).astype(np.int64)
    before[starts] = -1 - np.arange(len(starts))
    transform = before[suffixes]
    heads = np.flatnonzero(np.concatenate(([True], transform[1:] != transform[:-1])))
    tails = np.concatenate((heads[1:] - 1, [size - 1]))
    return RunIndex(symbols, levels, suffixes, heads, tails, starts)


def repeated_spans(texts: Sequence[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Per text, the spans whose bytes lie in a string of ``length`` that starts in two or more places of ``texts``."""
    index = build(texts)
    long = index.matching_statistics() >= length
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], long, [False]))))
    for first, behind in zip(edges[::2].tolist(), edges[1::2].tolist()):
        text = int(np.searchsorted(index.starts, first, "right")) - 1
        at = int(index.starts[text])
        spans = out[text]
        start, stop = first - at, behind - 1 - at + length
        if spans and spans[-1][1] >= start:
            start = spans.pop()[0]
        spans.append((start, stop))
    return out
