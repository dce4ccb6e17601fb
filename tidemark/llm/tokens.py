"""Token ids of whole texts, exact and fast, for use inside Arrow tasks.

A text is cut only where the tokenizer itself always cuts: before a run of white space, and between an ASCII
letter and a full stop, comma or the like. Pieces are told apart by 64-bit fingerprints; each worker keeps the
ids of the pieces it has met, so that only new ones go through the tokenizer, and the ids of a text are the ids
of its pieces in turn. Where a neighbour might be white space outside ASCII no cut is made, which costs speed only.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tidemark.llm.textbytes import SPACES, in_chunks, span_hashes, text_bytes

CHUNK_BYTES = 1 << 20
SLOTS_LOG2 = 21
#: First bytes of the UTF-8 forms of white space outside ASCII, and control characters some take for it.
_WIDE = np.zeros(256, dtype=bool)
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[c for c in range(256) if chr(c).isascii() and chr(c).isalpha()]] = True
#: Marks that end a run of letters in every one of the public tokenizers.
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in ".,;:!?"]] = True
_SPECIAL = "<|endoftext|>"


def _cuts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin, in order; the end of all text comes last."""
    marked = np.zeros(len(raw) + 1, dtype=bool)
    if len(raw) > 3:
        space, before = SPACES[raw], np.zeros(len(raw), dtype=bool)
        before[1:] = space[:-1]
        wide = _WIDE[raw]
        before[1:] |= wide[:-1]
        before[2:] |= wide[:-2]
        before[3:] |= wide[:-3]
        marked[:-1] = space & ~before
        marked[1:-1] |= _MARK[raw[1:]] & _LETTER[raw[:-1]]
    marked[offsets] = True
    return np.flatnonzero(marked)


class PieceTokenizer:
    """One tokenizer file with its memory of pieces: an open hash table from fingerprints to ranges of ids.

    ``special``: special marks inside texts give their own ids, as the file's tokenizer does when loaded; otherwise they
    are ordinary words. No piece ends inside a mark, as marks have no white space and no ``.,;:!?``.
    """

    def __init__(self, path: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = not special
        self.marking = Tokenizer.from_file(path)
        self.mark = self.marking.token_to_id(_SPECIAL)
        self.keys = np.zeros(1 << SLOTS_LOG2, dtype=np.uint64)
        self.begins = np.zeros(1 << SLOTS_LOG2, dtype=np.uint32)
        self.sizes = np.zeros(1 << SLOTS_LOG2, dtype=np.uint16)
        self.filled = 0
        self.used = 0
        self.pool = np.zeros(1 << 16, dtype=np.uint32)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece, and their numbers. Pieces go in together with the end mark between them."""
        joined = _SPECIAL.join(pieces)
        if self.mark is None or joined.count("<|") != len(pieces) - 1:
            ids = [e.ids for e in self.plain.encode_batch_fast(pieces, add_special_tokens=False)]
            sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            return np.fromiter((i for one in ids for i in one), dtype=np.uint32, count=int(sizes.sum())), sizes
        (encoded,) = self.marking.encode_batch_fast([joined], add_special_tokens=False)
        ids = np.array(encoded.ids, dtype=np.uint32)
        marks = np.flatnonzero(ids == self.mark)
        ends = np.concatenate([marks, [len(ids)]])
        begins = np.concatenate([[0], marks + 1])
        return np.delete(ids, marks), ends - begins

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1."""
        slot = (keys >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
        found = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            there = self.keys[slot[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = slot[open_[hit]]
            open_ = open_[~hit & (there != 0)]
            slot[open_] = (slot[open_] + 1) & ((1 << SLOTS_LOG2) - 1)
        return found

    def _remember(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        room = (1 << SLOTS_LOG2) * 6 // 10 - self.filled
        if room <= 0 or int(sizes.max()) > 65535:
            return
        keys, sizes = keys[:room], sizes[:room]
        ids = ids[: int(sizes.sum())]
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        begins = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.filled += len(keys)
        slot = (keys >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
        rest = np.arange(len(keys))
        while len(rest):
            free = self.keys[slot[rest]] == 0
            takers = rest[free]
            self.keys[slot[takers]] = keys[takers]
            won = takers[self.keys[slot[takers]] == keys[takers]]
            self.begins[slot[won]], self.sizes[slot[won]] = begins[won], sizes[won]
            rest = np.setdiff1d(rest, won, assume_unique=True)
            slot[rest] = (slot[rest] + 1) & ((1 << SLOTS_LOG2) - 1)

    def _chunk(self, raw: np.ndarray, offsets: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        cuts = _cuts(raw, offsets)
        keys = span_hashes(raw, cuts[:-1], cuts[1:])
        keys[keys == 0] = 1
        slots = self._find(keys)
        new = np.flatnonzero(slots < 0)
        begin = self.begins[slots].astype(np.int64)
        size = self.sizes[slots].astype(np.int64)
        pool = self.pool
        if len(new):
            fresh, first, which = np.unique(keys[new], return_index=True, return_inverse=True)
            text = raw.tobytes()
            at, to = cuts[new[first]].tolist(), cuts[new[first] + 1].tolist()
            ids, sizes = self.encode([text[a:b].decode("utf-8", "replace") for a, b in zip(at, to)])
            begin[new] = (self.used + np.cumsum(sizes) - sizes)[which]
            size[new] = sizes[which]
            pool = np.concatenate([self.pool[: self.used], ids])
            self._remember(fresh, ids, sizes)
        if end_id is not None:
            # the end mark of a row is one more piece behind the row's last
            behind = np.searchsorted(cuts, offsets[1:])
            begin, size = np.insert(begin, behind, len(pool)), np.insert(size, behind, 1)
            pool = np.concatenate([pool, [np.uint32(end_id)]])
        before = np.concatenate([[0], np.cumsum(size)])
        first = np.searchsorted(cuts, offsets[:-1]) + (np.arange(rows) if end_id is not None else 0)
        source = np.repeat(begin - before[:-1], size)
        source += np.arange(before[-1])
        return pool[source], np.concatenate([before[first], before[-1:]])

    def ids(self, column: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a text column in turn as uint32, and where each row's ids begin and the last row's end."""
        raw, offsets = text_bytes(column)
        parts, starts, total = [], [np.zeros(1, dtype=np.int64)], 0
        for a, b in in_chunks(offsets, CHUNK_BYTES):
            ids, at = self._chunk(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], end_id)
            parts.append(ids)
            starts.append(at[1:] + total)
            total += len(ids)
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32), np.concatenate(starts)


@lru_cache(maxsize=4)
def piece_tokenizer(path: str, special: bool = False) -> PieceTokenizer:
    """The tokenizer of a file, loaded once in each Python worker."""
    return PieceTokenizer(path, special)
