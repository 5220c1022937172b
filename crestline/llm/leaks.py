"""Evaluation passages inside corpus documents.

Each training shard (documents of a task, a few million characters at a time) gets an FM-index over its words. Phrases
of the passages are looked up by backward search and located by sampled positions; phrases around distinctive words tell
which documents may hold which item. For all of these at once a bound is computed on the words that two stretches can
hold; those that reach it are aligned exactly: runs of equal words, chained over misread words and lines of other columns
into stretches. A document leaks an item if one or two stretches cover half of the passage.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crestline.llm.fmindex import FMIndex

PHRASE = 3  # words of a phrase that is searched
RARE_ITEMS, RARE_SHARE = 5, 0.02  # a word is distinctive if no more items, or no greater share of them, have it, or if it holds a digit
ALIKE_PHRASE = 5  # words of the phrases that tell passages that are nearly equal; these count as one item
LEAST_MARKED = 1  # distinctive words that any half of a passage has at least, whatever the number of items that have them
SHARD_CHARS = 3_000_000
PART_CHARS = 16_000_000  # characters of passages that go to the tasks at once; more are searched part by part
PART_WORDS = 40_000  # different words of one 16-bit alphabet
PAIRS_AT_ONCE = 20_000
TABLE = 2_000_000  # places of a table from couples of words of a few documents to their occurrences
SHARE = 0.5
LEAST_STRETCH = 7  # score of a stretch, about its equal words
KEPT = 1 / 3  # of the distinctive words in the stretches of a leak, so many are in unbroken phrases; the others may be misread or lost
MULT = np.uint64(0x9E3779B97F4A7C15)


UNSEEN = 0xFFFFFFFF


def _classes() -> tuple[np.ndarray, dict[str, int]]:
    """Class of each code point: letters and digits without case and accents, those that are misread for each other alike; 0: others.

    Latin letters have small numbers; others are worked out when they are first met and have numbers of their own.
    """
    small = {}
    for k, alike in enumerate(("ceo0", "ilj1", "nu", "s5"), 1):  # shapes that a scan confuses
        small |= dict.fromkeys(alike, k)
    table = np.full(0x110000, UNSEEN, "uint32")
    table[:0x30] = 0
    return table, small


FOLD, _SMALL = _classes()


def _class(ch: str) -> int:
    import unicodedata

    if not ch.isalnum() or unicodedata.category(ch) == "No":
        return 0
    base = unicodedata.normalize("NFKD", ch.lower())[0]
    return _SMALL.get(base) or 8 + ord(base)


def fold(cps: np.ndarray) -> np.ndarray:
    c = FOLD[cps]
    new = c == UNSEEN
    if new.any():
        for cp in np.unique(cps[new]).tolist():
            FOLD[cp] = _class(chr(cp))
        c = FOLD[cps]
    return c


DIGIT = np.zeros(0x110000, bool)
DIGIT[0x30:0x3A] = True
_HYPHEN = np.zeros(0x110000, bool)
for _c in "-­‐‑‒–—¬":
    _HYPHEN[ord(_c)] = True
_POW = np.array([pow(0x100000001B3, k, 2**64) for k in range(64)], "uint64")


class Words:
    """Words of many texts: hash of the folded letters, place in the text, document. A hyphen at a line end joins its word."""

    def __init__(self, texts: list[str]):
        joined = "\n\n".join(texts) + "\n\n"
        cps = np.frombuffer(joined.encode("utf-32-le", "replace"), "uint32")
        lens = np.array([len(t) + 2 for t in texts], "int64")
        self.doc_start = np.concatenate([[0], np.cumsum(lens)])
        newline = cps == 10
        broken = np.zeros(len(cps), bool)
        broken[:-1] = _HYPHEN[cps[:-1]] & newline[1:]
        # a blank after the hyphen is dropped as well
        soft = np.zeros(len(cps), bool)
        soft[:-2] = _HYPHEN[cps[:-2]] & (cps[1:-1] == 32) & newline[2:]
        gone = broken | soft
        gone[1:] |= broken[:-1] | soft[:-1]
        gone[2:] |= soft[:-2]
        at = np.flatnonzero(~gone)
        c = fold(cps[at])
        letter = np.concatenate([[False], c != 0, [False]])
        first = np.flatnonzero(letter[1:] & ~letter[:-1])
        last = np.flatnonzero(letter[:-1] & ~letter[1:])
        self.first_char, self.end_char = at[first[: len(last)]], at[last - 1] + 1
        size = last - first
        where = np.flatnonzero(c != 0)
        word = np.repeat(np.arange(len(first)), size)
        place = np.minimum(where - first[word], 63)
        self.letters, self.letter_start = c[where], np.concatenate([[0], np.cumsum(size)])
        # the letters of a word as a set of bits: words that share few can't be misread for each other
        bits = np.uint64(1) << (self.letters & 63).astype("uint64")
        self.size, self.bits = size, np.bitwise_or.reduceat(bits, self.letter_start[:-1]) if len(first) else np.zeros(0, "uint64")
        val = c[where].astype("uint64") * _POW[place]
        self.hash = np.add.reduceat(val, self.letter_start[:-1]) if len(first) else np.zeros(0, "uint64")
        self.hash = self.hash * MULT
        digit = DIGIT[cps[at]][where]
        self.has_digit = np.logical_or.reduceat(digit, self.letter_start[:-1]) if len(first) else np.zeros(0, bool)
        self.doc = np.searchsorted(self.doc_start, self.first_char, side="right") - 1
        # places where another column may begin: line ends, bars, wide gaps, also inside a word that a hyphen joined
        stop = newline | (cps == 124)
        stop[:-1] |= (cps[:-1] == 32) & (cps[1:] == 32)
        upto = np.concatenate([[0], np.cumsum(stop)])
        self.stop = np.zeros(len(self.first_char) + 1, bool)
        if len(self.first_char):
            self.stop[1:-1] = upto[self.first_char[1:]] > upto[self.end_char[:-1]]
            inner = upto[self.end_char] > upto[self.first_char]
            self.stop[:-1] |= inner
            self.stop[1:] |= inner
            self.stop[[0, -1]] = True
        self.stops = np.concatenate([[0], np.cumsum(self.stop)])

    def stop_near(self, k: np.ndarray, before: int, after: int) -> np.ndarray:
        n = len(self.stop)
        return self.stops[np.minimum(k + after + 1, n)] > self.stops[np.maximum(k - before, 0)]

    def spell(self, k: int) -> list[int]:
        return self.letters[self.letter_start[k] : self.letter_start[k + 1]].tolist()


def _least_marked(marked: np.ndarray, share: float) -> int:
    """Least number of marked words in any one or two stretches that make up ``share`` of a passage."""
    m, cum = len(marked), np.concatenate([[0], np.cumsum(marked)])
    k = min(m, int(np.ceil(share * m - 1e-9)))
    best = int((cum[k:] - cum[: m + 1 - k]).min())
    for s in range(1, k):
        before = np.minimum.accumulate(cum[s:] - cum[: m + 1 - s])  # of s words, up to each end
        after = np.minimum.accumulate((cum[k - s :] - cum[: m + 1 - k + s])[::-1])[::-1]
        best = min(best, int((before[: m + 1 - k] + after[s:]).min()))
    return best


class Passages:
    """What every task needs of the evaluation items: their words, numbered, and the phrases around distinctive ones."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.needs = ids, {}
        self.words = w = Words(texts)
        self.edge = np.searchsorted(w.doc, np.arange(len(ids) + 1))
        self.vocabulary = np.unique(w.hash)
        if len(self.vocabulary) > PART_WORDS:
            raise ValueError("too many different words for one 16-bit alphabet")
        self.number = np.searchsorted(self.vocabulary, w.hash)
        items = np.zeros(len(self.vocabulary), "int64")
        alike = self._alike()
        seen = np.unique(self.number.astype("int64") * max(1, len(ids)) + alike[w.doc])
        np.add.at(items, seen // max(1, len(ids)), 1)
        rare = (items[self.number] <= max(RARE_ITEMS, RARE_SHARE * len(np.unique(alike)))) | w.has_digit
        for a, b in zip(self.edge[:-1], self.edge[1:]):
            # where other items repeat a passage or it has few such words, the rarest it has are distinctive
            for many in np.unique(items[self.number[a:b]]):
                if _least_marked(rare[a:b], SHARE) >= LEAST_MARKED:
                    break
                rare[a:b] |= items[self.number[a:b]] <= many
        n = len(w.hash)
        at = np.arange(max(0, n - PHRASE + 1))
        inside = w.doc[at] == w.doc[at + PHRASE - 1] if len(at) else np.zeros(0, bool)
        marked = np.zeros(len(at), bool)
        for k in range(PHRASE):
            marked |= rare[at + k]
        at = at[inside & marked]
        grid = np.stack([self.number[at + k] for k in range(PHRASE)], axis=1) + 1 if len(at) else np.zeros((0, PHRASE), "int64")
        self.patterns, self.pattern_of = np.unique(grid, axis=0, return_inverse=True)
        self.pattern_of = self.pattern_of.reshape(-1)
        # every place of a phrase; it vouches for its distinctive words
        self.places = at
        self.rare = rare
        self.rare_in = [rare[a:b] for a, b in zip(self.edge[:-1], self.edge[1:])]
        # words of a passage that are neighbours or have one word between them, as every run of equal words has
        self.couples, self.couple_at, first = [], [], 0
        for gap in (1, 2):
            inside = w.doc[:-gap] == w.doc[gap:]
            code = self._couple(self.number + 1, gap)
            kinds = np.unique(code[inside])
            self.couples.append(kinds)
            self.couple_at.append(np.concatenate([np.where(inside, np.searchsorted(kinds, code) + first, -1), np.full(min(gap, n), -1)])[:n].astype("int32"))
            first += len(kinds)

    def _couple(self, numbers: np.ndarray, gap: int) -> np.ndarray:
        return numbers[:-gap].astype("int64") * (len(self.vocabulary) + 1) + numbers[gap:]

    def _alike(self) -> np.ndarray:
        """The first of the passages that are equal or nearly so, for each: half of the phrases in common, from one holder of a phrase to the next."""
        w, n, group = self.words, len(self.number), np.arange(len(self.ids))
        at = np.arange(max(0, n - ALIKE_PHRASE + 1))
        at = at[w.doc[at] == w.doc[at + ALIKE_PHRASE - 1]] if len(at) else at
        code = np.zeros(len(at), "uint64")
        for k in range(ALIKE_PHRASE):
            code = (code + self.number[at + k].astype("uint64") + np.uint64(1)) * MULT
            code ^= code >> np.uint64(29)
        by = np.lexsort((w.doc[at], code))
        code, doc = code[by], w.doc[at][by]
        same = (code[1:] == code[:-1]) & (doc[1:] != doc[:-1])
        pair, shared = np.unique(doc[:-1][same] * max(1, len(self.ids)) + doc[1:][same], return_counts=True)
        size = np.bincount(doc, minlength=len(self.ids))
        for p, c in zip(pair.tolist(), shared.tolist()):
            a, b = divmod(p, len(self.ids))
            if 2 * c >= min(size[a], size[b]):
                group[group == group[b]] = group[a]
        return group

    def need(self, share: float) -> np.ndarray:
        """Distinctive words that a leak of each passage shows at least, whichever part of the passage it is."""
        if share not in self.needs:
            self.needs[share] = np.array([max(1, int(np.ceil(KEPT * _least_marked(x, share)))) for x in self.rare_in], "int64")
        return self.needs[share]

    def symbols(self, words: Words) -> np.ndarray:
        """Word numbers from 1 on; words that no passage has are spread over the numbers left."""
        if not len(self.vocabulary):
            return np.ones(len(words.hash), "int64")
        k = np.minimum(np.searchsorted(self.vocabulary, words.hash), len(self.vocabulary) - 1)
        free = 65_530 - len(self.vocabulary)
        return np.where(self.vocabulary[k] == words.hash, k + 1, len(self.vocabulary) + 1 + (words.hash % np.uint64(free)).astype("int64"))


def _near(a: list[int], b: list[int]) -> bool:
    """Equal but for a few misread letters."""
    if abs(len(a) - len(b)) > 1 or not a or not b:
        return False
    allowed = max(1, len(a) // 3) if len(a) > 2 else 0
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= allowed
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return sum(x != y for x, y in zip(a[k:], b[k + 1 :])) <= allowed - 1


def _perhaps_near(x: Words, a: np.ndarray, y: Words, b: np.ndarray) -> np.ndarray:
    """False where ``_near`` is false for sure: a misread letter changes at most two letters of the set."""
    size = np.maximum(x.size[a], y.size[b])
    return (np.abs(x.size[a] - y.size[b]) <= 1) & (size > 2) & (np.bitwise_count(x.bits[a] ^ y.bits[b]) <= 2 * np.maximum(1, size // 3))


def _runs(doc: np.ndarray, item: np.ndarray) -> list[tuple[list[int], list[int]]]:
    """[(passage, document) words] of diagonal runs of equal words, over single unequal ones."""
    order = np.argsort(item, kind="stable")
    lo, hi = np.searchsorted(item[order], doc, "left"), np.searchsorted(item[order], doc, "right")
    many = hi - lo
    j = np.repeat(np.arange(len(doc)), many)
    if not len(j):
        return []
    i = order[np.arange(len(j)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)]
    diag = j - i
    by = np.lexsort((j, diag))
    i, j, diag = i[by], j[by], diag[by]
    new = np.concatenate([[True], (diag[1:] != diag[:-1]) | (j[1:] - j[:-1] > 2)])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(j))
    keep = tail - head >= 2
    i, j = i.tolist(), j.tolist()
    return [(i[a:b], j[a:b]) for a, b in zip(head[keep].tolist(), tail[keep].tolist())]


DENSITY = 0.75  # equal or misread words among those of a stretch
GAP_ITEM, GAP_DOC = 5, 60  # words that may be lost of the passage, and read in between, from one run to the next
GROWN = 2  # misread words by which a stretch may grow at each end
UNLIKE, LOST, AWAY = 1.5, 0.7, 1.5  # costs of an unequal word, a lost word, a run of words read in between


def _step(gi: np.ndarray, gj: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether words of something else are read in between, cost) of a step over gi words of the passage and gj of the document."""
    away = gj - np.maximum(gi, 0) > 2
    return away, np.maximum(0, np.maximum(-gi, -gj)) + LOST * np.maximum(gi, 0) + np.where(away, AWAY, 0.5 * np.abs(gj - gi))


class Aligner:
    """Aligns one passage with one document of the shard."""

    def __init__(self, passages: Passages, item: int, words: Words, numbers: np.ndarray, lo: int, hi: int, seen: dict):
        self.p, self.w, self.lo, self.hi = passages, words, lo, hi
        self.base, self.end = int(passages.edge[item]), int(passages.edge[item + 1])
        self.size = self.end - self.base
        # words by number and hash, and which of them are near: the same ones come up again and again
        self.item, self.doc, self.seen = passages.number[self.base : self.end].tolist(), words.hash[lo:hi].tolist(), seen
        self.blocks = []
        for i, j in _runs(numbers[lo:hi], passages.number[self.base : self.end] + 1):
            step = [k for k in range(len(i) - 1) if i[k + 1] - i[k] == 2]
            odd = sum(not self.near(i[k] + 1, j[k] + 1) for k in step)
            self.blocks.append((i[0], i[-1] + 1, j[0], j[-1] + 1, len(i) + len(step) - odd - UNLIKE * odd, len(i) + len(step) - odd))

    def near(self, i: int, j: int) -> bool:
        pair = self.item[i], self.doc[j]
        known = self.seen.get(pair)
        if known is None:
            known = self.seen[pair] = _near(self.p.words.spell(self.base + i), self.w.spell(self.lo + j))
        return known

    def stretches(self, least: int) -> list[tuple[int, int, int, int]]:
        """Chains of runs that keep the order: (first, end) in the passage, (first, end) in the document."""
        blocks = sorted((b for b in self.blocks if b[4] > 0), key=lambda b: (b[2], b[0]))
        if not blocks:
            return []
        i0, i1, j0, j1, own, equal = (np.array([b[k] for b in blocks]) for k in range(6))
        n = len(blocks)
        begins, ends = self.w.stop_near(self.lo + j0, 3, 1), self.w.stop_near(self.lo + j1, 1, 3)
        # all pairs (a before b) that may follow each other, with what the step costs; blocks are few
        gi, gj = i0[None, :] - i1[:, None], j0[None, :] - j1[:, None]
        away, cost = _step(gi, gj)
        ok = (gi >= -3) & (gi <= GAP_ITEM) & (gj >= -3) & (gj <= GAP_DOC) & (i1[None, :] > i1[:, None]) & (j1[None, :] > j1[:, None])
        # words of another column or an advert come and go at line ends only
        ok &= np.triu(np.ones((n, n), bool), 1) & (~away | (begins[None, :] & ends[:, None]))
        to, of = np.nonzero(ok.T)
        cost = cost[of, to]
        gains, best, back = own.tolist(), own.astype(float).tolist(), [-1] * n
        for b, a, c in zip(to.tolist(), of.tolist(), cost.tolist()):
            gain = best[a] + gains[b] - c
            if gain > best[b]:
                best[b], back[b] = gain, a
        best = np.array(best)
        used, out = set(), []
        for b in np.argsort(-best, kind="stable").tolist():
            if b in used:
                continue
            last, k, first, words = b, b, b, 0
            while k >= 0 and k not in used:
                used.add(k)
                words += int(equal[k])
                first, k = k, int(back[k])
            score = best[last] - (best[k] if k >= 0 else 0)
            # by chance, template words match but names and numbers between them don't
            if score >= least and words >= DENSITY * (i1[last] - i0[first]):
                out.append((int(i0[first]), int(i1[last]), int(j0[first]), int(j1[last])))
        return [self.extend(*s) for s in out]

    def extend(self, a: int, b: int, x: int, y: int) -> tuple[int, int, int, int]:
        """Moves both ends over up to GROWN misread words next to them."""
        for _ in range(GROWN):
            if a > 0 and x > 0 and self.near(a - 1, x - 1):
                a, x = a - 1, x - 1
            if b < self.size and self.lo + y < self.hi and self.near(b, y):
                b, y = b + 1, y + 1
        return a, b, x, y


def align(passages: Passages, item: int, words: Words, numbers: np.ndarray, lo: int, hi: int, seen: dict, least: int = LEAST_STRETCH):
    """(share of the passage covered by its best one or two stretches, their (first, end) words in the passages and in the shard)."""
    one = Aligner(passages, item, words, numbers, lo, hi, seen)
    spans = sorted(one.stretches(least), key=lambda s: s[0] - s[1])
    best, got = (spans[0][1] - spans[0][0], spans[:1]) if spans else (0, [])
    # each stretch with all later ones at once: those that add words and don't overlap in the document by more than two
    i0, i1, j0, j1 = np.array(spans).reshape(-1, 4).T
    for p, s in enumerate(spans):
        if 2 * (s[1] - s[0]) <= best:
            break
        a, b, x, y = i0[p + 1 :], i1[p + 1 :], j0[p + 1 :], j1[p + 1 :]
        adds = np.where(s[0] <= a, b > s[1], s[1] > b) & (np.minimum(s[3], y) - np.maximum(s[2], x) <= 2)
        cover = np.where(adds, s[1] - s[0] + b - a - np.maximum(0, np.minimum(s[1], b) - np.maximum(s[0], a)), 0)
        if len(cover) and cover.max() > best:
            k = int(cover.argmax())
            t = spans[p + 1 + k]
            best, got = int(cover[k]), [s, t] if s[0] <= t[0] else [t, s]
    return best / max(1, one.size), [(one.base + s[0], one.base + s[1], lo + s[2], lo + s[3]) for s in got]


def candidates(passages: Passages, words: Words, numbers: np.ndarray, share: float = SHARE) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(document, item, words of the passage, words of the shard) of all that may leak: distinctive words in phrases found by the shard's FM-index.

    ``vouched`` decides on the same words, after alignment; it would refuse all that is left out here.
    """
    if not len(passages.patterns) or not len(numbers):
        return []
    index = FMIndex(numbers)
    lo, hi = index.search(passages.patterns)
    many = np.maximum(hi - lo, 0)
    rows = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    found = index.locate(rows)
    pattern = np.repeat(np.arange(len(many)), many)
    inside = words.doc[found] == words.doc[np.minimum(found + PHRASE - 1, len(numbers) - 1)]
    found, pattern = found[inside], pattern[inside]
    # phrase occurrences to places in passages
    order = np.argsort(passages.pattern_of, kind="stable")
    a = np.searchsorted(passages.pattern_of[order], pattern, "left")
    b = np.searchsorted(passages.pattern_of[order], pattern, "right")
    place = passages.places[order[np.repeat(a, b - a) + np.arange((b - a).sum()) - np.repeat(np.cumsum(b - a) - (b - a), b - a)]]
    found = np.repeat(found, b - a)
    # one hit per distinctive word and spot
    hits = []
    for k in range(PHRASE):
        keep = passages.rare[place + k]
        hits.append((found[keep] + k, place[keep] + k))
    spot, word = (np.concatenate(x) for x in zip(*hits))
    if not len(spot):
        return []
    items, size = len(passages.ids), len(passages.rare)
    key = spot * size + word
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    spot, word = key // size, key % size
    pair = words.doc[spot] * items + passages.words.doc[word]
    # different words of each pair, wherever they stand
    several = pair * size + word
    several.sort()
    several = several[np.concatenate([[True], several[1:] != several[:-1]])] // size
    head = np.flatnonzero(np.concatenate([[True], several[1:] != several[:-1]]))
    which, count = several[head], np.diff(np.append(head, len(several)))
    which = which[count >= passages.need(share)[which % items]]
    which = which[_may_cover(passages, words, numbers, which // items, which % items, share)]
    # the hits of those left, by spot and, at a spot, from the last word on
    held = np.isin(pair, which)
    pair, spot, word = pair[held], spot[held], word[held]
    by = np.lexsort((-word, spot, pair))
    pair, spot, word = pair[by], spot[by], word[by]
    x, y = np.searchsorted(pair, which, "left").tolist(), np.searchsorted(pair, which, "right").tolist()
    return [(p // items, p % items, word[i:j], spot[i:j]) for p, i, j in zip(which.tolist(), x, y)]


def _may_cover(passages: Passages, words: Words, numbers: np.ndarray, doc: np.ndarray, item: np.ndarray, share: float) -> np.ndarray:
    """Whether two stretches of ``Aligner`` can reach the share, for all pairs of document and item at once.

    Runs of equal words are chained under the same conditions and costs, with words taken as misread that may be so by their
    letters, so chains hold at least the words of any stretch. Two stretches make up the share only if, for some place x of the
    passage, the best chain up to x and the best from x on hold DENSITY of it, with what their ends may grow.
    """
    out = np.zeros(len(doc), bool)
    if not len(doc):
        return out
    kinds = sum(map(len, passages.couples))
    known = np.where(numbers <= len(passages.vocabulary), numbers, 0)
    key, spot, first = [], [], 0
    for gap, codes in zip((1, 2), passages.couples):
        if len(codes):
            at = np.flatnonzero((known[:-gap] > 0) & (known[gap:] > 0) & (words.doc[:-gap] == words.doc[gap:]))
            code = passages._couple(known, gap)[at]
            k = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            same = codes[k] == code
            key.append(words.doc[at[same]] * kinds + k[same] + first)
            spot.append(at[same])
        first += len(codes)
    if not key:
        return out
    key, spot = np.concatenate(key), np.concatenate(spot)
    order = np.argsort(key, kind="stable")
    key, spot = key[order], spot[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, "int64")
    places = key[head], head, np.diff(np.append(head, len(key))), spot
    edge = np.searchsorted(words.doc, np.arange(words.doc[-1] + 2))
    for k in range(0, len(doc), PAIRS_AT_ONCE):
        some = slice(k, k + PAIRS_AT_ONCE)
        out[some] = _bound(passages, words, edge, places, kinds, doc[some], item[some], share)
    return out


def _bound(passages: Passages, words: Words, edge: np.ndarray, places, kinds: int, doc: np.ndarray, item: np.ndarray, share: float) -> np.ndarray:
    key, head, count, spot = places
    size = np.diff(passages.edge)[item]
    least = DENSITY * share * size
    out = np.zeros(len(doc), bool)
    if not len(key):
        return out
    # occurrences of each couple of the passages in each document, looked up in a table of a few documents at a time
    few = max(1, TABLE // kinds)
    slot = np.zeros(few * kinds, "int32")
    good, met, chunk = np.zeros(len(doc), bool), [[], []], doc // few
    turns = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
    for x, y in zip(turns.tolist(), np.append(turns[1:], len(doc)).tolist()):
        lowest = int(chunk[x]) * few * kinds
        a, b = np.searchsorted(key, [lowest, lowest + few * kinds]).tolist()
        slot[key[a:b] - lowest] = np.arange(a + 1, b + 1, dtype="int32")
        n = size[x:y]
        start = np.cumsum(n) - n
        at = np.arange(n.sum(), dtype="int32") - np.repeat(start, n).astype("int32")
        pair = np.repeat(np.arange(y - x, dtype="int32"), n)
        place = np.repeat(passages.edge[item[x:y]], n) + at
        line = np.repeat((doc[x:y] * kinds - lowest).astype("int32"), n)
        seen, got = np.zeros(len(at), bool), []
        for gap in (1, 2):
            kind = passages.couple_at[gap - 1][place]
            m = np.flatnonzero(kind >= 0)
            k = slot[line[m] + kind[m]]
            m = m[k > 0]
            seen[m] = seen[m + gap] = True
            got.append((m, k[k > 0] - 1))
        good[x:y] = np.add.reduceat(seen, start) + 4 * GROWN >= least[x:y]
        for gap, (m, k) in enumerate(got):
            keep = good[x:y][pair[m]]
            met[gap].append((pair[m][keep] + x, at[m][keep], k[keep]))
        slot[key[a:b] - lowest] = 0
    # couples that both have: pair, diagonal, place in the document, gap in one sortable number
    codes, width = [], int(np.diff(edge).max()) + int(size.max()) + 2
    for gap, got in enumerate(met):
        p, i, k = (np.concatenate(x) for x in zip(*got))
        n = count[k]
        j = spot[np.arange(n.sum()) + np.repeat(head[k] - (np.cumsum(n) - n), n)]
        p, i = np.repeat(p.astype("int64"), n), np.repeat(i, n)
        j = j - edge[doc[p]]
        codes.append(((p * width + j - i + int(size.max())) * width + j) * 2 + gap)
    code = np.concatenate(codes)
    if not len(code):
        return out
    code.sort()
    gap, code = code & 1, code >> 1
    j, line = code % width, code // width
    end = j + gap + 1
    first = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (j[1:] - end[:-1] > 2)]))
    base = edge[doc]
    p = line // width
    i = j - (line - p * width - int(size.max()))
    # words between equal ones that can't be misread
    step = np.flatnonzero((gap == 1) & np.concatenate([[True], code[1:] != code[:-1]]))
    odd = np.zeros(len(code), "int32")
    odd[step] = ~_perhaps_near(passages.words, passages.edge[item[p[step]]] + i[step] + 1, words, base[p[step]] + j[step] + 1)
    odd = np.add.reduceat(odd, first)
    p, i0, j0, j1 = p[first], i[first], j[first], end[np.append(first[1:], len(j)) - 1] + 1
    i1 = i0 + j1 - j0
    kept = i1 - i0 - odd - UNLIKE * odd > 0
    p, i0, i1, j0, j1, odd = p[kept], i0[kept], i1[kept], j0[kept], j1[kept], odd[kept]
    if not len(p):
        return out
    # steps from run to run, by the ends of runs in the passage
    longest = int(size.max()) + GAP_ITEM + 4
    by = np.argsort(p * longest + i1, kind="stable")
    p, i0, i1, j0, j1, odd = p[by], i0[by], i1[by], j0[by], j1[by], odd[by]
    own, ends = i1 - i0 - odd, p * longest + i1
    upon = np.concatenate([[0], np.cumsum(np.bincount(ends, minlength=len(doc) * longest))]).astype("int32")  # runs that end before a place
    lo, hi = upon[p * longest + np.maximum(i0 - GAP_ITEM, 0)], np.minimum(upon[p * longest + i0 + 4], upon[ends])
    n = np.maximum(hi - lo, 0)
    to, of = np.repeat(np.arange(len(ends)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - lo, n)
    gj = j0[to] - j1[of]
    ok = (gj >= -3) & (gj <= GAP_DOC) & (j1[to] > j1[of])
    to, of, gj = to[ok], of[ok], gj[ok]
    gi = i0[to] - i1[of]
    base = edge[doc][p]
    away, cost = _step(gi, gj)
    ok = ~away | (words.stop_near(base + j0, 3, 1)[to] & words.stop_near(base + j1, 1, 3)[of])
    to, of, cost = to[ok], of[ok], cost[ok]
    # what each run may grow by, if a stretch begins or ends with it
    item_base, item_end, doc_end = passages.edge[item][p], passages.edge[item + 1][p], edge[doc + 1][p]
    before, after, more, still = np.zeros(len(p), "int32"), np.zeros(len(p), "int32"), np.ones(len(p), bool), np.ones(len(p), bool)
    for k in range(1, GROWN + 1):
        more &= (i0 >= k) & (j0 >= k) & _perhaps_near(passages.words, np.maximum(item_base + i0 - k, 0), words, np.maximum(base + j0 - k, 0))
        still &= (item_base + i1 + k <= item_end) & (base + j1 + k <= doc_end)
        still &= _perhaps_near(passages.words, np.minimum(item_base + i1 + k, item_end) - 1, words, np.minimum(base + j1 + k, doc_end) - 1)
        before, after = before + more, after + still
    worth = own - UNLIKE * odd
    upto = _chains(to, of, cost, own, worth, before, i1) + after
    onward = _chains(of, to, cost, own, worth, after, longest - i0) + before
    # words of the passage up to x, of a chain that may go on beyond it, and from x on
    left, right = np.zeros((len(doc), longest), "int32"), np.zeros((len(doc), longest), "int32")
    np.maximum.at(left, (p, i1), upto)
    np.maximum.at(right, (p, i0), onward)
    x = np.arange(longest)
    cut = np.maximum.accumulate((left - x)[:, ::-1], axis=1)[:, ::-1] + x
    left = np.maximum.accumulate(np.maximum(left, cut), axis=1)
    right = np.maximum.accumulate(right[:, ::-1], axis=1)[:, ::-1]
    return good & ((left + right).max(1) >= least)


def _chains(to: np.ndarray, of: np.ndarray, cost: np.ndarray, own: np.ndarray, gain: np.ndarray, first_more: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Most words of a chain of runs that ends in each, one level after the other; a step is taken only if what is before is worth it. The first run may have more words."""
    order = np.argsort(level[to], kind="stable")
    to, of, cost = to[order], of[order], cost[order]
    worth, held = gain.astype("float64"), own + first_more
    at = level[to]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, "int64")
    for a, b in zip(first.tolist(), np.append(first[1:], len(at)).tolist()):
        keep = worth[of[a:b]] > cost[a:b]
        t, f, c = to[a:b][keep], of[a:b][keep], cost[a:b][keep]
        np.maximum.at(held, t, held[f] + own[t])
        np.maximum.at(worth, t, worth[f] + gain[t] - c)
    return held


def vouched(passages: Passages, word: np.ndarray, spot: np.ndarray, spans: list[tuple[int, int, int, int]]) -> bool:
    """Whether the stretches hold KEPT of their distinctive words, in order, in unbroken phrases. By chance, template words match but names and numbers don't."""
    held, of = set(), set()
    for a, b, x, y in spans:
        of |= set((a + np.flatnonzero(passages.rare[a:b])).tolist())
        inside = (word >= a) & (word < b) & (spot >= x) & (spot < y)
        held |= set(_ascending(word[inside].tolist()))
    return len(held) >= KEPT * len(of)


def _ascending(words: list[int]) -> list[int]:
    """A longest ascending row of the words."""
    ends, at, back = [], [], []
    for k, v in enumerate(words):
        i = bisect_left(ends, v)
        ends[i : i + 1], at[i : i + 1] = [v], [k]
        back.append(at[i - 1] if i else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(words[k])
        k = back[k]
    return out


def scan(passages: Passages, texts: list[str], share: float = SHARE):
    """(text, item, share, [(first, end) characters]) of every text that leaks an item."""
    words = Words(texts)
    numbers = passages.symbols(words)
    edge = np.searchsorted(words.doc, np.arange(len(texts) + 1))
    out, seen = [], {}
    for d, item, word, spot in candidates(passages, words, numbers, share):
        cover, spans = align(passages, item, words, numbers, int(edge[d]), int(edge[d + 1]), seen)
        if cover < share:
            continue
        # where a second stretch met by chance spoils the first, that may do alone
        size = int(passages.edge[item + 1] - passages.edge[item])
        spans = next((x for x in [spans, *([s] for s in spans if s[1] - s[0] >= share * size)] if vouched(passages, word, spot, x)), None)
        if spans:
            cover = cover if len(spans) > 1 else (spans[0][1] - spans[0][0]) / size
            off = int(words.doc_start[d])
            out.append((d, item, cover, [(int(words.first_char[a]) - off, int(words.end_char[b - 1]) - off) for *_, a, b in spans]))
    return out


def leaked_items(docs: DataFrame, id_col: str, text_col: str, items: DataFrame, item_col: str, passage_col: str, share: float = SHARE) -> DataFrame:
    """(id, item, cover, first_char, end_char): the stretches of every document that holds at least ``share`` of an item's words.

    One row per stretch, so one or two per document and item. Null and empty texts and passages leak nothing; equal passages
    are all reported; repeated documents each. Extra columns are ignored. Passages go to the tasks in parts of about
    PART_CHARS characters, equal ones together, so nothing that grows with the items is broadcast at once; each part scans
    the documents once. Words are distinctive among the passages of their part.
    """
    held = items.select(F.col(f"`{item_col}`").alias("i"), F.col(f"`{passage_col}`").alias("t")).where(F.length("t") > 0)
    parts = max(1, -(-(held.agg(F.sum(F.length("t"))).first()[0] or 0) // PART_CHARS))
    part = F.pmod(F.xxhash64(F.lower("t")), F.lit(parts))
    found = [_leaked(docs, id_col, text_col, held.where(part == k) if parts > 1 else held, share) for k in range(parts)]
    return reduce(DataFrame.unionAll, found)


def _alphabets(ids: list[int], texts: list[str]) -> list[Passages]:
    """All passages together, or in halves as long as they have too many different words for one alphabet."""
    if len(texts) > 1 and len(np.unique(Words(texts).hash)) > PART_WORDS:
        k = len(texts) // 2
        return _alphabets(ids[:k], texts[:k]) + _alphabets(ids[k:], texts[k:])
    return [Passages(ids, texts)]


def _leaked(docs: DataFrame, id_col: str, text_col: str, items: DataFrame, share: float) -> DataFrame:
    held = items.toArrow().sort_by([("t", "ascending"), ("i", "ascending")])
    passages = docs.sparkSession.sparkContext.broadcast(_alphabets(held.column("i").to_pylist(), held.column("t").to_pylist()))

    def run(batches):
        ids, texts, size = [], [], 0

        def shard():
            rows = [(ids[d], own.ids[i], cover, a, b) for own in passages.value for d, i, cover, spans in scan(own, texts, share) for a, b in spans]
            cols = list(zip(*rows)) if rows else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (kind, pa.int64(), pa.float64(), pa.int32(), pa.int32()))], names=["id", "item", "cover", "first_char", "end_char"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size >= SHARD_CHARS:
                    yield shard()
                    ids, texts, size = [], [], 0
        if texts:
            yield shard()

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where(F.length("text") > 0)
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, item long, cover double, first_char int, end_char int")


def removal_spans(leaks: DataFrame) -> DataFrame:
    """(id, first_char, end_char, items): leaked stretches of each document, merged where they overlap or touch."""
    from pyspark.sql import Window as W

    before = W.partitionBy("id").orderBy("first_char", "end_char")
    reach = F.max("end_char").over(before.rowsBetween(W.unboundedPreceding, -1))
    opened = leaks.withColumn("new", (reach.isNull() | (F.col("first_char") > reach)).cast("int")).withColumn("span", F.sum("new").over(before.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return opened.groupBy("id", "span").agg(F.min("first_char").alias("first_char"), F.max("end_char").alias("end_char"), F.countDistinct("item").alias("items")).drop("span")
