"""Counting quotient filters without loss for n-grams of word numbers.

An n-gram is packed into one key, its words' numbers side by side, and the key is permuted: a few Feistel rounds over its
two halves, which can be undone. Permuted keys are spread evenly whatever the words. Their leading bits choose the block,
the next are the quotient, and all the rest is kept as the remainder, so no two n-grams are ever taken for one another and
an n-gram is read back from where its entry stands.

A filter holds the entries of one block in ascending order: the quotients as run lengths in unary, the remainders in whole
bytes, and a byte for each counter, with larger counters in a list of their own. Filters of the same block merge like
sorted lists; counters of equal keys are added.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

from tidemark.llm.textbytes import U64, mix64

_ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
_HEAD = struct.Struct("<BBIQI")
#: Word numbers of so many bits fit: five of them in two halves of 64 bits.
MOST_BITS = 25


def _mask(bits: int) -> np.uint64:
    return U64((1 << bits) - 1)


@dataclass
class Entries:
    """Permuted keys in two halves, and their counters."""

    left: np.ndarray
    right: np.ndarray
    count: np.ndarray

    def __len__(self) -> int:
        return len(self.left)

    def part(self, a: int, b: int) -> Entries:
        return Entries(self.left[a:b], self.right[a:b], self.count[a:b])


@dataclass(frozen=True)
class Grams:
    """The keys of n-grams of ``words`` words with ``bits`` bits for each number."""

    words: int
    bits: int

    def __post_init__(self):
        if self.bits > MOST_BITS:
            raise ValueError(f"words have numbers of {self.bits} bits; filters take up to {MOST_BITS}")

    @property
    def half(self) -> int:
        return (self.words * self.bits + 1) // 2

    def keys(self, columns: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        half, bits = self.half, self.bits
        left, right = np.zeros(len(columns[0]), dtype=np.uint64), np.zeros(len(columns[0]), dtype=np.uint64)
        for column in columns:
            left = (left << U64(bits) | right >> U64(half - bits)) & _mask(half)
            right = (right << U64(bits) | column.astype(np.uint64)) & _mask(half)
        return left, right

    def columns(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        half, bits, found = self.half, self.bits, []
        for _ in range(self.words):
            found.append((right & _mask(bits)).astype(np.int64))
            right = right >> U64(bits) | (left & _mask(bits)) << U64(half - bits)
            left = left >> U64(bits)
        return found[::-1]

    def permuted(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for turn in _ROUNDS:
            left, right = right, left ^ mix64(right + U64(turn)) & _mask(self.half)
        return left, right

    def restored(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for turn in reversed(_ROUNDS):
            left, right = right ^ mix64(left + U64(turn)) & _mask(self.half), left
        return left, right

    def counted(self, columns: Sequence[np.ndarray]) -> Entries:
        """The n-grams that stand in these columns, each once with its counter, in the order of permuted keys."""
        left, right = self.permuted(*self.keys(columns))
        return self.summed(Entries(left, right, np.ones(len(left), dtype=np.int64)))

    def summed(self, entries: Entries) -> Entries:
        """Entries in ascending order, with the counters of equal keys added."""
        if not len(entries):
            return entries
        half = self.half
        top = entries.left << U64(64 - half) if half < 64 else entries.left.copy()
        if half < 64:
            top |= entries.right << U64(64 - 2 * half) if 2 * half <= 64 else entries.right >> U64(2 * half - 64)
        order = np.argsort(top, kind="stable")
        left, right = entries.left[order], entries.right[order]
        if np.any((left[1:] == left[:-1]) & (right[1:] != right[:-1])):
            order = np.lexsort((entries.right, entries.left))
            left, right = entries.left[order], entries.right[order]
        new = np.ones(len(left), dtype=bool)
        new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        at = np.flatnonzero(new)
        return Entries(left[at], right[at], np.add.reduceat(entries.count[order], at))

    def merged(self, several: Sequence[Entries]) -> Entries:
        if len(several) == 1:
            return several[0]
        parts = [np.concatenate([getattr(e, f) for e in several]) for f in ("left", "right", "count")]
        return self.summed(Entries(*parts))

    def blocks(self, entries: Entries, block_bits: int) -> Iterator[tuple[int, bytes]]:
        """A filter for each block that has entries; they must be in ascending order."""
        block_bits = min(block_bits, self.half)
        number = entries.left >> U64(self.half - block_bits) if block_bits else np.zeros(len(entries), dtype=np.uint64)
        edges = np.flatnonzero(np.diff(number, prepend=number[:1] + U64(1)))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(entries)]):
            yield int(number[a]), self._filter(entries.part(a, b), block_bits)

    def _filter(self, entries: Entries, block_bits: int) -> bytes:
        half, size = self.half, len(entries)
        quotient_bits = max(0, min(half - block_bits, size.bit_length()))
        quotient_bits = max(quotient_bits - 7, min(half - block_bits, quotient_bits + (half - block_bits - quotient_bits) % 8), 0)
        rest = half - block_bits - quotient_bits
        quotient = (entries.left >> U64(rest)) & _mask(quotient_bits)
        runs = np.zeros((1 << quotient_bits) + size, dtype=np.uint8)
        runs[np.arange(size) + quotient.astype(np.int64)] = 1
        small = np.minimum(entries.count, 255).astype(np.uint8)
        large = entries.count[small == 255].astype("<i8")
        return b"".join(
            (
                _HEAD.pack(block_bits, quotient_bits, size, int(entries.left[0] >> U64(half - block_bits)) if block_bits else 0, len(large)),
                np.packbits(runs).tobytes(),
                _low_bytes(entries.left & _mask(rest), -(-rest // 8)),
                _low_bytes(entries.right, -(-half // 8)),
                small.tobytes(),
                large.tobytes(),
            )
        )

    def entries(self, data: bytes) -> Entries:
        """What a filter holds."""
        block_bits, quotient_bits, size, block, large = _HEAD.unpack_from(data)
        half, at = self.half, _HEAD.size
        rest, slots = half - block_bits - quotient_bits, (1 << quotient_bits) + size
        raw = np.frombuffer(data, dtype=np.uint8)
        runs = np.unpackbits(raw[at : (at := at + -(-slots // 8))], count=slots)
        quotient = (np.flatnonzero(runs) - np.arange(size)).astype(np.uint64)
        parts = []
        for width in (-(-rest // 8), -(-half // 8)):
            parts.append(_from_low_bytes(raw[at : (at := at + width * size)], size, width))
        count = raw[at : (at := at + size)].astype(np.int64)
        count[count == 255] = np.frombuffer(data, dtype="<i8", count=large, offset=at)
        top = U64(block) << U64(half - block_bits) if block_bits else U64(0)
        left = top | (quotient << U64(rest) if rest < 64 else U64(0)) | parts[0]
        return Entries(left, parts[1], count)


def _low_bytes(numbers: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _from_low_bytes(raw: np.ndarray, size: int, width: int) -> np.ndarray:
    wide = np.zeros((size, 8), dtype=np.uint8)
    wide[:, :width] = raw.reshape(size, width)
    return wide.view("<u8").reshape(-1)
