"""Words of a batch of texts as arrays: where they begin and end, which document they belong to, and their hashes.

Helpers for Arrow batches inside tasks. A batch is cut into chunks of whole documents, so that what a task holds is
bounded by a chunk or by its longest document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text in a chunk, unless a single document is longer.
CHUNK_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Chunk:
    """Texts ``at`` to ``at + n - 1`` of a batch; bounds are relative to ``data``."""

    at: int
    data: np.ndarray  # bytes
    bounds: np.ndarray  # of the texts, n + 1
    starts: np.ndarray  # of the words
    ends: np.ndarray
    first: np.ndarray  # each text's first word, and the number of all words: n + 1

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column (null: empty) and the bounds of each text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data if data is not None else b"", np.uint8), bounds


def spans(bounds: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts with up to ``most`` bytes, or of one text."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + most, side="right")) - 1)
        yield i, j
        i = j


def chunks(column: pa.Array, lower: bool = False, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    data, bounds = text_bytes(column)
    for i, j in spans(bounds, most):
        part = data[bounds[i] : bounds[j]]
        if lower:
            part = _LOWER[part]
        own = bounds[i : j + 1] - bounds[i]
        space = _SPACE[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[own] = True
        begins, ends = ~space, ~space
        begins[1:] &= space[:-1] | edge[1:-1]
        ends[:-1] &= space[1:] | edge[1:-1]
        starts = np.flatnonzero(begins)
        yield Chunk(i, part, own, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, own))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64 bit numbers that spreads every bit."""
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64 bit hash of each run of bytes, by prefix sums of a polynomial."""
    size = 1 << max(16, int(len(data)).bit_length())
    powers, inverse = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def word_hashes(chunk: Chunk) -> np.ndarray:
    return span_hashes(chunk.data, chunk.starts, chunk.ends)


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each word on, across texts too; shorter at the end."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        out = out * _STEP + hashes[j : n - k + 1 + j]
    return mixed(out, k)
