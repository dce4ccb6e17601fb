"""Words and 5-word shingles of texts as 64-bit fingerprints, a whole batch at a time.

Words are the longest runs of letters, digits and characters outside ASCII in the lower-cased text, so copies that
differ in case, spacing or punctuation have the same words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.textbytes import U64, SpanHasher, in_chunks, mix64, text_bytes, word_spans

CHUNK_BYTES = 1 << 20
SHINGLE_WORDS = 5
_WORD = np.ones(256, dtype=bool)
_WORD[:128] = [chr(c).isalnum() for c in range(128)]
_TURNS = np.random.default_rng(5).integers(1, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) * U64(2) + U64(1)


def chunked_words(column: pa.Array) -> Iterator[tuple[int, SpanHasher, np.ndarray, np.ndarray, np.ndarray]]:
    """For chunks of rows: the first row, a hasher of the text, where words begin and end, and each row's first word.

    Chunks hold about a megabyte of text, or one longer row. NULL texts have no words.
    """
    raw, offsets = text_bytes(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")))
    for a, b in in_chunks(offsets, CHUNK_BYTES):
        part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        begin, end = word_spans(_WORD[part], at)
        yield a, SpanHasher(part), begin, end, np.searchsorted(begin, at)


def word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For chunks of rows: the first row, the words' fingerprints in text order, and each row's first word."""
    for first, hashed, begin, end, starts in chunked_words(column):
        yield first, hashed(begin, end), starts


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Each row's distinct shingles in ascending order. A text of one to four words is a single shingle."""
    for first, words, starts in word_hashes(column):
        count = len(words) - SHINGLE_WORDS + 1
        windows = np.zeros(max(count, 0), dtype=np.uint64)
        for j in range(SHINGLE_WORDS):
            windows += words[j : j + len(windows)] * _TURNS[j]
        windows = mix64(windows)
        for i in range(len(starts) - 1):
            a, b = starts[i], starts[i + 1]
            if b - a >= SHINGLE_WORDS:
                yield first + i, np.unique(windows[a : b - SHINGLE_WORDS + 1])
            elif b > a:
                yield first + i, mix64((words[a:b] * _TURNS[: b - a]).sum(dtype=np.uint64, keepdims=True) + U64(b - a))
            else:
                yield first + i, np.zeros(0, dtype=np.uint64)
