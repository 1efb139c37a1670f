"""Content-defined anchors: every window of a text is governed by the least hash among the k-grams in it.

Equal windows have the same anchor wherever they stand, so whatever repeats meets at a key. Neighbouring windows mostly
share theirs, so a text has about one run of windows per half a window.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=8)
def _powers(size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.uint64((_BASE + 2 * 0x632BE59BD9B4E019 * seed) % 2**64)
    inverse = np.uint64(pow(int(base), -1, 2**64))
    ones = np.ones(size, np.uint64)
    up, down = ones.copy(), ones.copy()
    up[1:], down[1:] = base, inverse
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


@lru_cache(maxsize=8)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(1000 + seed).integers(0, 2**64, 256, np.uint64)


def gram_hashes(data: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` bytes: a rolling polynomial over random byte values, mixed at the end."""
    n = len(data)
    if n < size:
        return np.empty(0, np.uint64)
    room = 1 << max(12, int(n).bit_length())
    up, down = _powers(room, seed)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_values(seed)[data] * up[:n], out=sums[1:])
    x = (sums[size:] - sums[: n - size + 1]) * down[: n - size + 1]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values: running minima of blocks from both sides, joined."""
    n = len(values)
    if n < width:
        return np.empty(0, values.dtype)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchored_runs(data: np.ndarray, window: int, gram: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: its hash, the first and last window, and how often the anchor stands in them.

    A run of more than ``most`` windows, as in a text of one and the same byte, is cut.
    """
    hashes = gram_hashes(data, gram)
    least = sliding_least(hashes, window - gram + 1)
    if not len(least):
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), empty, empty, empty
    new = np.concatenate(([True], least[1:] != least[:-1]))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:] - 1, [len(least) - 1]))
    if (last - first).max() >= most:
        cuts = np.concatenate([np.arange(f, l + 1, most) for f, l in zip(first.tolist(), last.tolist())])
        first, last = cuts, np.concatenate((cuts[1:] - 1, [len(least) - 1]))
    keys = least[first]
    reach = window - gram + 1
    times = [np.count_nonzero(hashes[f : l + reach] == key) for key, f, l in zip(keys, first.tolist(), last.tolist())]
    return keys, first, last, np.array(times, np.int64)
