"""A compressed FM-index over many short word strings, searched in lockstep.

The strings are joined with separators that sort below every word, each its
own. The suffix array comes from prefix doubling and is let go once the index
stands, with the ranks and the text. What stays is the Burrows-Wheeler
transform as a wavelet tree in matrix form (one bit vector a level, packed in
64-bit words with running counts), on which backward search takes two ranks a
word, and one byte or two a row: how long a prefix it shares with the row
before, counted up to a window. All strings searched advance by one word at a
time together.
"""

from __future__ import annotations

import numpy as np


class _Bits:
    """A bit vector with constant-time counts of ones before a place."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(ones) - ones).astype(np.uint32 if n < 1 << 32 else np.int64)
        self.zeros = n - int(ones.sum())

    def rank1(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """``symbols`` (0 and up) of all strings, concatenated, and their lengths."""

    def __init__(self, symbols: np.ndarray, lens: np.ndarray, window: int):
        n_str, n = len(lens), len(symbols) + len(lens)
        ends = np.cumsum(lens + 1) - 1
        is_sep = np.zeros(n, bool)
        is_sep[ends] = True
        own = np.empty(n, np.int64)
        own[~is_sep] = symbols + n_str
        own[is_sep] = np.arange(n_str)
        rank, span, order = own, 1, None
        longest = int(lens.max(initial=0)) + 1
        while span < longest:
            rank, order = self._double(rank, span)
            span *= 2
        if order is None:
            order = np.argsort(rank, kind="stable")
        del rank
        self.n, self.window = n, window
        self.shared = self._shared(own, order)
        text = np.where(is_sep, 0, own - n_str + 1)  # all separators look alike to the wavelet tree
        bwt = text[order - 1]
        del own, order
        self.n_symbols = int(text.max(initial=0)) + 1
        self.levels: list[_Bits] = []
        for level in range(max(1, (self.n_symbols - 1).bit_length()) - 1, -1, -1):
            bit = (bwt >> level) & 1
            self.levels.append(_Bits(bit))
            bwt = np.concatenate([bwt[bit == 0], bwt[bit == 1]])
        counts = np.bincount(text, minlength=self.n_symbols)
        self.first = np.cumsum(counts) - counts
        # where the leaf of each symbol begins, for ranks counted from there
        self.leaf = self._down(np.arange(self.n_symbols), np.zeros(self.n_symbols, np.int64))
        self._begins: dict[int, np.ndarray] = {}
        self.n_intervals = len(self.begins(window))

    def _shared(self, own: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Words each row has in common with the row before, at most a window."""
        shared = np.zeros(self.n, np.min_scalar_type(self.window))
        alike = np.arange(1, self.n)
        for depth in range(self.window):
            # every separator is its own, so no comparison passes the end of a string
            alike = alike[own[order[alike - 1] + depth] == own[order[alike] + depth]]
            if not len(alike):
                break
            shared[alike] = depth + 1
        return shared

    def begins(self, length: int) -> np.ndarray:
        """First rows of the intervals of rows that agree in ``length`` words."""
        if length not in self._begins:
            self._begins[length] = np.flatnonzero(np.concatenate([np.ones(min(self.n, 1), bool), self.shared[1:] < length]))
        return self._begins[length]

    def interval(self, row: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number, first row and end of the intervals of ``length`` words that hold ``row``."""
        begins = self.begins(length)
        number = np.searchsorted(begins, row, side="right") - 1
        return number, begins[number], np.append(begins, self.n)[number + 1]

    @staticmethod
    def _double(rank: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(rank)
        nxt = np.zeros(n, np.int64)
        nxt[: max(n - span, 0)] = rank[span:] + 1
        key = rank * (int(nxt.max(initial=0)) + 1) + nxt
        order = np.argsort(key)
        key = key[order]
        out = np.empty(n, np.int64)
        out[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        return out, order

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits in zip(range(len(self.levels) - 1, -1, -1), self.levels):
            ones = bits.rank1(at)
            at = np.where((symbol >> level) & 1, bits.zeros + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the strings with ``symbol`` put in front."""
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.first[symbol] - self.leaf[symbol]
        return base + both[: len(symbol)], base + both[len(symbol) :]

    def match(self, symbols: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of any strings. For each place of each string: the
        matching statistic (words from there on that occur in the index, at
        most a window, and not beyond the string), and the number of the
        window's interval where that is a whole window, else -1.

        A word that cannot be put before the match shortens it to the longest
        prefix that it can precede, found by halving, and is tried again; a
        word that the index does not hold starts anew. Symbols are those of
        the index; -1 and numbers it does not have are unknown words."""
        begin = np.cumsum(lens) - lens
        statistic, out = np.zeros(len(symbols), np.int64), np.full(len(symbols), -1, np.int64)
        by_length = np.argsort(-lens, kind="stable")
        begin, lens = begin[by_length], lens[by_length]
        low, high = np.zeros(len(lens), np.int64), np.full(len(lens), self.n, np.int64)
        matched = np.zeros(len(lens), np.int64)
        for back in range(1, int(lens.max(initial=0)) + 1):
            active = int(np.searchsorted(-lens, -back, side="right"))
            at = begin[:active] + lens[:active] - back
            symbol = symbols[at] + 1
            known = (symbol > 0) & (symbol < self.n_symbols)
            symbol = np.where(known, symbol, 0)
            l, h = self.step(symbol, low[:active], high[:active])
            found = known & (h > l)
            m = np.where(found, matched[:active] + 1, 0)
            l, h = np.where(found, l, 0), np.where(found, h, self.n)
            again = np.flatnonzero(known & ~found & (matched[:active] > 0))
            if len(again):
                l[again], h[again], m[again] = self._shorten(symbol[again], low[again], matched[again])
            m = np.minimum(m, self.window)
            whole = np.flatnonzero(m == self.window)
            number, l[whole], h[whole] = self.interval(l[whole], self.window)
            out[at[whole]] = number
            statistic[at] = m
            low[:active], high[:active], matched[:active] = l, h, m
        return statistic, out

    def _shorten(self, symbol: np.ndarray, row: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of ``symbol`` before the longest prefix, shorter than
        ``length``, of the row ``row`` that it precedes somewhere, and their
        lengths (0, and all rows, where it precedes none)."""
        good, bad = np.full(len(row), -1, np.int64), length.copy()
        low, high = np.zeros(len(row), np.int64), np.full(len(row), self.n, np.int64)
        while True:
            open_ = np.flatnonzero(bad - good > 1)
            if not len(open_):
                return low, high, good + 1
            middle = (good[open_] + bad[open_]) // 2
            l, h = np.zeros(len(open_), np.int64), np.full(len(open_), self.n, np.int64)
            for k in np.unique(middle[middle > 0]):
                of = np.flatnonzero(middle == k)
                _, l[of], h[of] = self.interval(row[open_[of]], int(k))
            l, h = self.step(symbol[open_], l, h)
            hit = h > l
            good[open_[hit]], bad[open_[~hit]] = middle[hit], middle[~hit]
            low[open_[hit]], high[open_[hit]] = l[hit], h[hit]
