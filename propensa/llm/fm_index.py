"""FM-index over integer symbols: wavelet-tree ranks and sampled positions."""

from __future__ import annotations

import numpy as np

from propensa.llm.suffix_array import suffix_array

#: One suffix position in so many is kept.
SAMPLE = 16


class Bits:
    """A bit vector in 64-bit words, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(len(bits) // 64 * 64 + 64, bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words), np.uint32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """How many ones there are before each place."""
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word].astype(np.int64) + np.bitwise_count(below)

    def __getitem__(self, place: np.ndarray) -> np.ndarray:
        return (self.words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector a level, highest bits
    first, each level ordered by the bits above (zeros before ones)."""

    def __init__(self, sequence: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (sequence >> level) & 1 > 0
            self.ones.append(Bits(bit))
            self.zeros.append(len(bit) - int(bit.sum()))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low, high = np.zeros_like(place), place
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            bit = (symbol >> level) & 1
            before_low, before_high = self.ones[k].rank(low), self.ones[k].rank(high)
            low = np.where(bit, self.zeros[k] + before_low, low - before_low)
            high = np.where(bit, self.zeros[k] + before_high, high - before_high)
        return high - low


class FMIndex:
    """Index of ``text``, integers from 0 up to below ``size``.

    Inside, symbols are one higher and 0 is the end, which occurs once: only
    then does the order of the symbols before the suffixes agree with that of
    the suffixes themselves, and every walk back ends.
    """

    def __init__(self, text: np.ndarray, size: int):
        text = np.append(np.asarray(text, np.int64) + 1, 0)
        array = suffix_array(text, size + 1)
        self.last = text[array - 1]                      # symbol before each suffix
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size + 1))])
        self.tree = WaveletTree(self.last, size + 1)
        kept = array % SAMPLE == 0
        self.kept = Bits(kept)
        self.places = array[kept]

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.tree.rank(symbol, row)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the suffixes that start with each phrase (a row of
        equally long phrases), by backward search.  Phrases whose end does not
        occur are not carried on."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.last))
        alive = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, k] + 1
            low[alive], high[alive] = self.step(symbol, low[alive]), self.step(symbol, high[alive])
            alive = alive[high[alive] > low[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffix rows: walk back to a kept one."""
        rows, places = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        walked = 0
        while len(todo):
            at = rows[todo]
            kept = self.kept[at]
            places[todo[kept]] = self.places[self.kept.rank(at[kept])] + walked
            todo, at = todo[~kept], at[~kept]
            rows[todo] = self.step(self.last[at], at)
            walked += 1
        return places
