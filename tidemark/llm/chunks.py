"""Words of whole texts, a chunk of rows at a time, as arrays: the shared first step of operators on word sequences."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidemark.llm.textbytes import in_chunks, text_bytes, word_spans

CHUNK_BYTES = 4 << 20


def byte_table(outside: bytes) -> np.ndarray:
    """For each byte whether it is part of a word: all but those named."""
    table = np.ones(256, dtype=bool)
    table[list(outside)] = False
    return table


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """The same bytes with A-Z in lower case; other characters stay as they are."""
    return np.where((raw >= 0x41) & (raw <= 0x5A), raw + np.uint8(0x20), raw)


@dataclass
class Words:
    """The words of rows ``first`` and following. ``starts`` has each row's first word, and the number of all at the end."""

    first: int
    raw: np.ndarray
    is_word: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    starts: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.starts) - 1

    def row_of(self) -> np.ndarray:
        """Each word's row in the chunk."""
        return np.repeat(np.arange(self.rows), np.diff(self.starts))

    def strings(self) -> pa.Array:
        """The words one by one."""
        offsets = np.zeros(len(self.begin) + 1, dtype=np.int32)
        np.cumsum(self.end - self.begin, out=offsets[1:])
        data = self.raw[self.is_word]
        return pa.Array.from_buffers(pa.string(), len(self.begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)])

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """Each word's number in the list of the chunk's distinct words, and that list."""
        coded = self.strings().dictionary_encode()
        return coded.indices.to_numpy(), coded.dictionary

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words with one space behind each, and where words begin and end there."""
        sizes = self.end - self.begin
        begin = np.cumsum(sizes + 1) - sizes - 1
        out = np.full(int(sizes.sum()) + len(sizes), 0x20, dtype=np.uint8)
        out[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = self.raw[self.is_word]
        return out, begin, begin + sizes


def word_chunks(column: pa.Array, table: np.ndarray, *, lower: bool = False, most: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of a text column in chunks of at most ``most`` bytes, or of one longer row. NULL: no words."""
    raw, offsets = text_bytes(column)
    for a, b in in_chunks(offsets, most):
        part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        if lower:
            part = lower_ascii(part)
        is_word = table[part]
        begin, end = word_spans(is_word, at)
        yield Words(a, part, is_word, begin, end, np.searchsorted(begin, at))


def by_value(batch: pa.RecordBatch, name: str) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The rows of a batch for each value of a column without NULLs."""
    coded = batch.column(name).dictionary_encode()
    numbers = coded.indices.to_numpy()
    for i, value in enumerate(coded.dictionary.to_pylist()):
        yield value, batch if len(coded.dictionary) == 1 else batch.take(pa.array(np.flatnonzero(numbers == i)))


def pack(array: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(array).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, count: int, kind: np.dtype | type) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, count * np.dtype(kind).itemsize, codec="zstd"), dtype=kind)
