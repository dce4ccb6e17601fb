"""Minimal acyclic transducers: a sorted list of terms as the smallest automaton, with each term's ordinal on its path.

Terms come in byte order. States that can no longer change are looked up among those already kept and shared, so common
endings are stored once. Every state knows how many terms end below each of its transitions; the sum of what is passed
over on the way is the term's ordinal in the list, and the way back leads from an ordinal to its term.

Transitions are kept in two arrays sorted by (state, byte), so many terms walk at once, a byte a step.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa

_ENTER = np.int64(256)


class Transducer:
    """``key`` is state * 256 + byte, ``target`` the state entered, ``skip`` the terms before those through that transition."""

    def __init__(self, terms: int, key: np.ndarray, target: np.ndarray, skip: np.ndarray, final: np.ndarray):
        self.terms, self.key, self.target, self.skip, self.final = terms, key, target, skip, final

    @classmethod
    def of(cls, terms: Iterable[bytes]) -> Transducer:
        """From distinct terms in ascending byte order."""
        shared: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        path: list[list] = [[False, []]]  # of the last term: whether it is final, and its transitions
        last, count = b"", 0

        def frozen(down_to: int) -> None:
            while len(path) > down_to + 1:
                final, out = path.pop()
                state = (final, tuple(out))
                number = shared.get(state)
                if number is None:
                    number = shared[state] = len(states)
                    states.append(state)
                path[-1][1][-1] = (path[-1][1][-1], number)

        for term in terms:
            if count and term <= last:
                raise ValueError("terms must be distinct and ascend")
            common, most = 0, min(len(term), len(last))
            while common < most and term[common] == last[common]:
                common += 1
            frozen(common)
            for byte in term[common:]:
                path[-1][1].append(byte)
                path.append([False, []])
            path[-1][0] = True
            last, count = term, count + 1
        frozen(0)
        states.append((path[0][0], tuple(path[0][1])))
        # the start gets number 0; states were kept after those they lead to
        order = len(states) - 1
        below = []
        for final, out in states:
            below.append(final + sum(below[number] for _, number in out))
        key, target, skip = [], [], []
        for number in range(order, -1, -1):
            final, out = states[number]
            passed = int(final)
            for byte, to in out:
                key.append((order - number) * 256 + byte)
                target.append(order - to)
                skip.append(passed)
                passed += below[to]
        final = np.array([f for f, _ in states[::-1]], dtype=bool)
        return cls(count, np.array(key, dtype=np.int64), np.array(target, dtype=np.int64), np.array(skip, dtype=np.int64), final)

    def ordinals(self, words: pa.Array) -> np.ndarray:
        """The ordinal of each word, or -1 where it is no term. All words walk at once."""
        _, offsets, data = words.cast(pa.large_binary()).buffers()
        starts = np.frombuffer(offsets, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        found = np.full(len(words), -1, dtype=np.int64)
        walking, state, passed = np.arange(len(words)), np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        step = 0
        while len(walking):
            ended = starts[walking] + step == starts[walking + 1]
            if ended.any():
                done = ended & self.final[state]
                found[walking[done]] = passed[done]
                walking, state, passed = walking[~ended], state[~ended], passed[~ended]
            if not len(walking) or not len(self.key):
                break
            wanted = state * _ENTER + raw[starts[walking] + step]
            at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            on = self.key[at] == wanted
            at = at[on]
            walking, state, passed = walking[on], self.target[at], passed[on] + self.skip[at]
            step += 1
        return found

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal."""
        if not 0 <= ordinal < self.terms:
            raise IndexError(ordinal)
        state, out = 0, bytearray()
        while not (self.final[state] and ordinal == 0):
            a, b = np.searchsorted(self.key, (state * 256, state * 256 + 256))
            at = a + int(np.searchsorted(self.skip[a:b], ordinal, side="right")) - 1
            out.append(int(self.key[at]) & 255)
            ordinal -= int(self.skip[at])
            state = int(self.target[at])
        return bytes(out)

    def to_bytes(self) -> bytes:
        sizes = np.array([self.terms, len(self.key), len(self.final)], dtype="<i8")
        most = max(int(self.key.max(initial=0)), self.terms)
        kind = "<u4" if most < 1 << 32 else "<u8"
        parts = [sizes.tobytes(), b"\4" if kind == "<u4" else b"\x08"]
        return b"".join(parts + [x.astype(kind).tobytes() for x in (self.key, self.target, self.skip)] + [np.packbits(self.final).tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        terms, arcs, states = np.frombuffer(data, dtype="<i8", count=3).tolist()
        width, at, arrays = data[24], 25, []
        for _ in range(3):
            arrays.append(np.frombuffer(data, dtype=f"<u{width}", count=arcs, offset=at).astype(np.int64))
            at += arcs * width
        return cls(terms, *arrays, np.unpackbits(np.frombuffer(data, dtype=np.uint8, offset=at), count=states).astype(bool))
