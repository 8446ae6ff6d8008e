"""Word shingles of whole batches of texts as 64-bit hashes, without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from ebbwatch.llm.common import joined_bytes

WORDS = 5

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_PLACE = _RNG.integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True  # fixed values: what parts words
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every other."""
    x = x ^ x >> np.uint64(30)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, in order, and the index of each word's text."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~_BLANK[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    first[edges] = inside[edges]  # a text's first byte begins a word of its own
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = 1 << max(12, (len(data) - 1).bit_length())
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, size)[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _powers(_INVERSE, size)[starts]
    hashes = mixed(hashes + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(column: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, sorted; a text of fewer words has its whole sequence as one."""
    data, offsets = joined_bytes(column)
    hashes, owner = word_hashes(data, offsets)
    total = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words):
        total += hashes[i : i + len(total)] * _PLACE[i]
    total = mixed(total + np.uint64(words))
    counts = np.bincount(owner, minlength=len(column)).tolist() if len(owner) else [0] * len(column)
    at = 0
    for n in counts:
        if n >= words:
            yield distinct(total[at : at + n - words + 1])
        elif n:
            yield mixed((hashes[at : at + n] * _PLACE[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
        else:
            yield total[:0]
        at += n


def distinct(values: np.ndarray) -> np.ndarray:
    out = np.sort(values)
    return out[np.concatenate([[True], out[1:] != out[:-1]])] if len(out) > 1 else out
