"""A compressed full-text index over many short strings, through which many patterns are streamed in lockstep.

The Burrows-Wheeler transform is kept as a wavelet matrix: one bit vector a level, packed in words
with a running count before each. ``rank`` goes down the levels once for a whole array of queries,
so one step of backward search costs a few array operations for all patterns together. Of the suffix array
every ``SAMPLE``-th text position is kept; the others are found by walking to one. The text itself isn't kept.
"""

from __future__ import annotations

import numpy as np

#: Text positions of which one is kept in the suffix array.
SAMPLE = 16


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class FMIndex:
    """Index of strings given as arrays of code points; each is ended by a sign of its own kind (code 0)."""

    def __init__(self, strings: list[np.ndarray]):
        size = np.array([len(s) + 1 for s in strings], np.int64)
        self.first = np.r_[0, np.cumsum(size)]
        text = np.zeros(int(self.first[-1]), np.int64)
        for s, at in zip(strings, self.first):
            text[at : at + len(s)] = s.astype(np.int64) + 1
        self.n = len(text)
        self.alphabet, text = np.unique(text, return_inverse=True)
        text = text.astype(np.int64)
        sa = self._suffixes(text, int(size.max()))
        bwt = text[sa - 1]
        self.levels = max(1, int(len(self.alphabet) - 1).bit_length())
        self.count = np.r_[0, np.cumsum(np.bincount(text, minlength=len(self.alphabet)))].astype(np.int32)
        self.words, self.before, self.zeros = [], [], []
        for lv in range(self.levels - 1, -1, -1):
            bit = (bwt >> lv & 1).astype(bool)
            w, before = self._packed(bit)
            self.words.append(w)
            self.before.append(before)
            self.zeros.append(int(len(bit) - bit.sum()))
            bwt = np.concatenate([bwt[~bit], bwt[bit]])
        # Rows whose text position is kept: every SAMPLE-th, and the strings' first places, where a walk must end.
        kept = sa % SAMPLE == 0
        kept[np.isin(sa, self.first[:-1])] = True
        self.kept = self._packed(kept)
        self.positions = sa[kept].astype(np.int32)
        self.base = self._walk(np.arange(len(self.alphabet)), np.zeros(len(self.alphabet), np.int64))

    @staticmethod
    def _packed(bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pad = np.zeros(-(len(bit) + 1) % 64 + len(bit) + 1, bool)
        pad[: len(bit)] = bit
        w = np.packbits(pad, bitorder="little").view(np.uint64)
        return w, np.r_[0, np.cumsum(np.bitwise_count(w).astype(np.int32), dtype=np.int32)]

    @staticmethod
    def _suffixes(text: np.ndarray, depth: int) -> np.ndarray:
        """Suffix array by prefix doubling, as deep as the longest string."""
        n = len(text)
        rank, step = text.copy(), 1
        while True:
            second = np.zeros(n, np.int64)
            second[: n - step] = rank[step:] + 1
            key = rank * (n + len(text) + 2) + second
            sa = np.argsort(key, kind="stable")
            sorted_key = key[sa]
            new = np.r_[0, np.cumsum(sorted_key[1:] != sorted_key[:-1])]
            rank = np.empty(n, np.int64)
            rank[sa] = new
            step *= 2
            if step >= depth or new[-1] == n - 1:
                return sa

    @staticmethod
    def _ones(vector: tuple[np.ndarray, np.ndarray], i: np.ndarray) -> np.ndarray:
        """Set bits in the first i places."""
        words, before = vector
        w = i >> 6
        return before[w] + np.bitwise_count(words[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))

    def _walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            ones = self._ones((self.words[k], self.before[k]), i)
            i = np.where(c >> (self.levels - 1 - k) & 1 == 1, self.zeros[k] + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often the character c stands in the first i places of the transform."""
        return self._walk(c, i) - self.base[c]

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Characters of a text by their numbers in the index, -1 for those that it hasn't."""
        p = points.astype(np.int64) + 1
        at = np.minimum(np.searchsorted(self.alphabet, p), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == p, at, -1)

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix interval of c followed by what [lo, hi) matches: a step of backward search."""
        n = len(c)
        known = np.maximum(c, 0)
        both = self.rank(np.concatenate([known, known]), np.concatenate([lo, hi])) + np.concatenate([self.count[known]] * 2)
        return both[:n], np.where(c < 0, both[:n], both[n:])

    def _before(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one place to the left."""
        c, i = np.zeros(len(row), np.int64), row
        for k in range(self.levels):
            bit = self.words[k][i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)
            ones = self._ones((self.words[k], self.before[k]), i)
            c = c << 1 | bit.astype(np.int64)
            i = np.where(bit == 1, self.zeros[k] + ones, i - ones)
        return self.count[c] + i - self.base[c]

    def positions_of(self, row: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array, by walking left to one that is kept."""
        out, todo, row, steps = np.empty(len(row), np.int64), np.arange(len(row)), row.astype(np.int64), 0
        while len(todo):
            there = self.kept[0][row >> 6] >> (row & 63).astype(np.uint64) & np.uint64(1) == 1
            out[todo[there]] = self.positions[self._ones(self.kept, row[there])] + steps
            todo, row, steps = todo[~there], self._before(row[~there]) if not there.all() else row[:0], steps + 1
        return out

    def walk(self, text: np.ndarray, end: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
        """Matching statistics: (query, start, lo, hi, whole) where the match that ends before end[q] loses an occurrence.

        Query q is streamed backwards through the index from text[end[q] - 1] to text[stop[q]] while others share the match, that is
        while its suffix interval holds more than one row. A start is given with the interval where the next step
        to the left would lose an occurrence, and, as ``whole``, where the walk ends at stop[q].
        """
        q = np.arange(len(end))
        lo, hi, pos = np.zeros(len(q), np.int64), np.full(len(q), self.n, np.int64), end.astype(np.int64)
        out: list[tuple] = []
        fresh = True
        while len(q):
            lo2, hi2 = self.extend(text[pos - 1], lo, hi)
            if not fresh:
                lost = hi2 - lo2 < hi - lo
                out.append((q[lost], pos[lost], lo[lost], hi[lost], np.zeros(int(lost.sum()), bool)))
            fresh = False
            pos = pos - 1
            shared = hi2 - lo2 > 1
            done = shared & (pos == stop[q])
            out.append((q[done], pos[done], lo2[done], hi2[done], np.ones(int(done.sum()), bool)))
            go = shared & ~done
            q, lo, hi, pos = q[go], lo2[go], hi2[go], pos[go]
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4 + (np.zeros(0, bool),)

    def window(self, text: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, lo, hi) of the windows text[start[q] : start[q] + length] that occur more than once."""
        q, _, lo, hi, whole = self.walk(text, start + length, start)
        return q[whole], lo[whole], hi[whole]

    def strings_at(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval number, string number) of the occurrences in suffix intervals."""
        size = hi - lo
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - size), size)
        rows, back = np.unique(at, return_inverse=True)
        return np.repeat(np.arange(len(lo)), size), (np.searchsorted(self.first, self.positions_of(rows), side="right") - 1)[back]
