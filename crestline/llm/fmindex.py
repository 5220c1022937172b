"""FM-index over the words of one shard: suffix array, wavelet matrix of the Burrows-Wheeler transform, sampled positions.

Symbols are 16-bit word numbers. Everything is an array operation over all patterns or occurrences at once.
"""

from __future__ import annotations

import numpy as np

LEVELS = 16


def suffix_array(sym: np.ndarray) -> np.ndarray:
    """Order of all suffixes of symbols below 65535, by prefix doubling from four words on; only suffixes that still tie are sorted again."""
    n = len(sym)
    if not n:
        return np.zeros(0, "int64")
    padded = np.concatenate([sym.astype("uint64") + np.uint64(1), np.zeros(4, "uint64")])
    key = np.zeros(n, "uint64")
    for i in range(4):
        key = (key << np.uint64(16)) | padded[i : i + n]
    sa = np.argsort(key, kind="stable")
    head = np.concatenate([[True], key[sa][1:] != key[sa][:-1]])
    rank = np.empty(n + 1, "int64")
    rank[n] = -1
    group = np.flatnonzero(head)[np.cumsum(head) - 1]
    rank[sa] = group
    h = 4
    while h < n:
        tied = ~head
        tied[:-1] |= ~head[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        s = sa[at]
        ahead = rank[np.minimum(s + h, n)]
        order = np.lexsort((ahead, rank[s]))
        s, ahead = s[order], ahead[order]
        own = rank[s]
        sa[at] = s
        first = np.concatenate([[True], (own[1:] != own[:-1]) | (ahead[1:] != ahead[:-1])])
        head[at] = first
        rank[s] = at[np.flatnonzero(first)[np.cumsum(first) - 1]]
        h *= 2
    return sa


class WaveletMatrix:
    """rank(c, i): how often c stands among the first i symbols; access(i). One bit per symbol and level."""

    def __init__(self, sym: np.ndarray):
        self.n = len(sym)
        words = self.n // 64 + 1
        self.bits, self.before, self.zeros = [], [], []
        cur = sym
        for level in range(LEVELS - 1, -1, -1):
            bit = (cur >> level) & 1
            packed = np.zeros(words * 8, "uint8")
            raw = np.packbits(bit.astype("uint8"), bitorder="little")
            packed[: len(raw)] = raw
            word = packed.view("<u8")
            self.bits.append(word)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(word), dtype="int64")[:-1]]))
            one = bit.astype(bool)
            self.zeros.append(int(self.n - one.sum()))
            cur = np.concatenate([cur[~one], cur[one]])

    def _ones(self, k: int, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype("uint64")) - np.uint64(1)
        return self.before[k][w] + np.bitwise_count(self.bits[k][w] & mask)

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros(len(i), "int64"), i.astype("int64")
        for k in range(LEVELS):
            one = ((c >> (LEVELS - 1 - k)) & 1).astype(bool)
            a, b = self._ones(k, lo), self._ones(k, hi)
            lo = np.where(one, self.zeros[k] + a, lo - a)
            hi = np.where(one, self.zeros[k] + b, hi - b)
        return hi - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros(len(i), "int64")
        for k in range(LEVELS):
            ones = self._ones(k, i)
            bit = (self.bits[k][i >> 6] >> (i & 63).astype("uint64")) & np.uint64(1)
            one = bit.astype(bool)
            c = (c << 1) | one
            i = np.where(one, self.zeros[k] + ones, i - ones)
        return c


class FMIndex:
    def __init__(self, sym: np.ndarray, sample: int = 4):
        # an end mark smaller than all symbols makes the transform reversible
        self.sym_n = len(sym)
        text = np.concatenate([sym.astype("uint16"), np.zeros(1, "uint16")])
        sa = suffix_array(text)
        self.bwt = WaveletMatrix(text[sa - 1])
        self.starts = np.searchsorted(text[sa], np.arange(65537))  # C: symbols smaller than c
        self.step = sample
        marked = sa % sample == 0
        self.mark_before = np.concatenate([[0], np.cumsum(marked)])
        self.marked = marked
        self.sampled = sa[marked]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all rows of ``patterns`` at once: ranges of the suffix array, empty where lo >= hi."""
        p = len(patterns)
        lo, hi = np.zeros(p, "int64"), np.full(p, self.sym_n + 1, "int64")
        for k in range(patterns.shape[1] - 1, -1, -1):
            live = np.flatnonzero(lo < hi)
            c = patterns[live, k].astype("int64")
            both = self.starts[np.concatenate([c, c])] + self.bwt.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
            lo[live], hi[live] = both[: len(live)], both[len(live) :]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array: walk back to the next sampled position."""
        out, at, steps = np.full(len(rows), -1, "int64"), rows.astype("int64").copy(), np.zeros(len(rows), "int64")
        open_ = np.arange(len(rows))
        while len(open_):
            hit = self.marked[at[open_]]
            done = open_[hit]
            out[done] = self.sampled[self.mark_before[at[done]]] + steps[done]
            open_ = open_[~hit]
            if len(open_):
                i = at[open_]
                c = self.bwt.access(i)
                at[open_] = self.starts[c] + self.bwt.rank(c, i)
                steps[open_] += 1
        return out
