"""A compressed full-text index over passages of words: wavelet matrix of the Burrows-Wheeler transform, backward search,
and matching statistics of many passages at once.

The index holds passages, each with a weight, as one sequence of word numbers with a 0 behind each. A range of the suffix
array is extended by the word before it with two rank queries on the wavelet matrix. When no range of enough weight is
left, the parent range - the one of the longest beginning that more suffixes share, found by the lengths of common
prefixes - takes its place and is tried again. All passages are searched in step, from their ends to their beginnings.
"""

from __future__ import annotations

import numpy as np

#: Suffixes are told apart by so many words; longer matches are not asked for.
DEPTH_STEPS = 7
DEPTH = 1 << DEPTH_STEPS


class Bits:
    """A bit vector with rank: packed in 64-bit words, with the count of ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros(-(-len(packed) // 8) * 8 + 8, dtype=np.uint8)
        padded[: len(packed)] = packed
        self.words = padded.view("<u8")
        self.before = np.zeros(len(self.words), dtype=np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:], dtype=np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels, self.zeros = [], []
        for level in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            self.levels.append((level, Bits(bit)))
            self.zeros.append(len(bit) - int(bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        self.first = self._followed(np.arange(alphabet), np.zeros(alphabet, dtype=np.int64))

    def _followed(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for (level, bits), zeros in zip(self.levels, self.zeros):
            ones = bits.ones(at)
            at = np.where(symbol >> level & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._followed(symbol, at) - self.first[symbol]


def _suffix_order(text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes by their first ``DEPTH`` symbols, and their ranks by the first 1, 2, 4, .. symbols."""
    size = len(text)
    ranks = [text.astype(np.int64)]
    order = np.arange(size)
    for step in range(DEPTH_STEPS):
        reach = 1 << step
        rank = ranks[-1]
        behind = np.zeros(size, dtype=np.int64)
        if reach < size:
            behind[:-reach] = rank[reach:] + 1
        key = rank * (size + int(text.max(initial=0)) + 2) + behind
        order = np.argsort(key)
        ordered = key[order]
        fresh = np.zeros(size, dtype=np.int64)
        fresh[order[1:]] = np.cumsum(ordered[1:] != ordered[:-1])
        ranks.append(fresh)
    return order, ranks


def _common_prefixes(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """For each suffix but the first, how many symbols it shares with the one before in order; 0 at either end."""
    size = len(order)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(size + 1, dtype=np.int32)
    for step in range(DEPTH_STEPS, -1, -1):
        inside = (a < size) & (b < size)
        same = np.zeros(size - 1, dtype=bool)
        same[inside] = ranks[step][a[inside]] == ranks[step][b[inside]]
        shared[1:size] += same.astype(np.int32) << step
        a += same.astype(np.int64) << step
        b += same.astype(np.int64) << step
    return np.minimum(shared, DEPTH)


def _smaller_neighbours(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest place before and behind with a smaller value; the ends themselves where there is none."""
    size, found = len(values), []
    for flipped in (values, values[::-1]):
        nearest, open_ = np.arange(size) - 1, np.arange(1, size)
        # a place that is no smaller is passed over to the smaller one before it, which is known after as many steps
        while len(open_):
            open_ = open_[(nearest[open_] > 0) & (flipped[nearest[open_]] >= flipped[open_])]
            nearest[open_] = nearest[nearest[open_]]
        found.append(np.maximum(nearest, 0))
    return found[0], size - 1 - found[1][::-1]


class FmIndex:
    """Passages one behind another in ``text`` (numbers from 1), with where each begins and the last one ends."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, weights: np.ndarray):
        sizes = np.diff(starts)
        self.starts, self.text = starts, text
        self.alphabet = int(text.max(initial=0)) + 1
        laid = np.zeros(len(text) + len(sizes), dtype=np.int64)
        laid[np.arange(len(text)) + np.repeat(np.arange(len(sizes)), sizes)] = text
        order, ranks = _suffix_order(laid)
        self.shared = _common_prefixes(order, ranks)
        del ranks
        self.before, self.behind = _smaller_neighbours(self.shared)
        self.wavelet = WaveletMatrix(laid[order - 1], self.alphabet)  # the first suffix follows the last, as in a ring
        self.less = np.searchsorted(np.sort(laid), np.arange(self.alphabet))
        weight = np.repeat(weights, sizes + 1)
        self.weight = np.concatenate([[0], np.cumsum(weight[order])])

    def matching(self, least_weight: int) -> np.ndarray:
        """For each word of the passages the length of the longest sequence of words from there on, inside the passage,
        that stands in passages of at least ``least_weight`` together."""
        size = len(self.shared) - 1
        found = np.zeros(len(self.text), dtype=np.int32)
        at = self.starts[1:] - 1
        active = np.flatnonzero(at >= self.starts[:-1])
        at = at[active]
        first = self.starts[:-1][active]
        low, high, length = np.zeros(len(at), dtype=np.int64), np.full(len(at), size, dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        while len(at):
            word = self.text[at]
            a = self.less[word] + self.wavelet.rank(word, low)
            b = self.less[word] + self.wavelet.rank(word, high)
            longer = self.weight[b] - self.weight[a] >= least_weight
            longer &= b > a
            whole = length == 0
            found[at[longer]] = length[longer] + 1
            # a longer match, no match at all, or another try with the parent range
            side = np.where(self.shared[low] >= self.shared[high], low, high)
            parent = np.maximum(self.shared[low], self.shared[high]).astype(np.int64)
            top = parent == 0
            up_low, up_high = np.where(top, 0, self.before[side]), np.where(top, size, self.behind[side])
            low = np.where(longer, a, np.where(whole, 0, up_low))
            high = np.where(longer, b, np.where(whole, size, up_high))
            length = np.where(longer, length + 1, np.where(whole, 0, parent))
            at = np.where(longer | whole, at - 1, at)
            on = at >= first
            at, first, low, high, length = at[on], first[on], low[on], high[on], length[on]
        return found
