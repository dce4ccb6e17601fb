"""Text columns as byte arrays, and 64-bit fingerprints of many spans of them at once.

The fingerprint of a span is a sum over its bytes of a random number for the byte times an odd base to the
power of its place in the span, modulo 2**64, mixed at the end. Prefix sums over a chunk of text give it for
all spans in a few array operations. Numbers come from a fixed seed, so every task gets the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
#: White space in ASCII: the bytes that words of the contracts never hold.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column as one array, and where each row begins and the last one ends. NULL: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def in_chunks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``most`` bytes, or a single longer row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(row + 1, end), rows)
        yield row, end
        row = end


@lru_cache(maxsize=1)
def _byte_numbers() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)


_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def _powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept for the usual chunk, made anew for a longer row."""
    global _powers
    if len(_powers[0]) >= size:
        return _powers
    inverse = pow(_BASE, -1, 1 << 64)
    made = []
    for base in (_BASE, inverse):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    if size <= 1 << 21:
        _powers = (made[0], made[1])
    return made[0], made[1]


class SpanHasher:
    """Fingerprints of spans of one chunk of bytes."""

    def __init__(self, raw: np.ndarray):
        power, self.inverse = _powers_to(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_byte_numbers()[raw] * power[: len(raw)], out=self.sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[begin]) * self.inverse[begin])


def span_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of ``raw[begin:end]`` for arrays of places."""
    return SpanHasher(raw)(begin, end)


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the longest runs of marked bytes that stay inside one row."""
    padded = np.zeros(len(is_word) + 2, dtype=bool)
    padded[1:-1] = is_word
    begins, ends = padded[1:-1] & ~padded[:-2], padded[1:-1] & ~padded[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(is_word))]
    begins[edges] |= is_word[edges]
    ends[edges - 1] |= is_word[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1
