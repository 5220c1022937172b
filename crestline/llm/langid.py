"""Language of documents and of the stretches of mixed ones, by bit-sliced Bloom filters of n-grams.

One byte of a filter slot holds a bit per language, so a single look-up (k bytes, combined by AND) tells all languages
that contain an n-gram. Per-language popcounts, corrected for the filters' false positives, decide: per word for the
segmentation, per stretch for the confidence.

The filters are fitted on a sample of labelled rows, bounded by ``per_language`` documents of each language (those
with the smallest hash of the identifier, of ``sample_chars`` characters, or nearest to that where a language has too few);
every document is then classified, over its whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LANGS = ("de", "en", "es", "fr", "it", "nl", "pt")
# fixed values: notations of the languages
NAMES = {
    "de": ("de", "deu", "ger", "german", "deutsch"), "en": ("en", "eng", "english"), "es": ("es", "spa", "spanish"),
    "fr": ("fr", "fra", "fre", "french"), "it": ("it", "ita", "italian"), "nl": ("nl", "nld", "dut", "dutch"), "pt": ("pt", "por", "portuguese"),
}
ORDERS = (3, 4, 5)
LOG_SLOTS = 20
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # any odd numbers do
SWITCH = 5.0  # evidence, in n-grams, that a change of language has to bring; low, as 60 characters of close languages differ in few
LEAST_CHARS = 60
PER_LANGUAGE = 300
SAMPLE_CHARS = (200, 20_000)  # length of the documents that filters are best fitted on; all lengths are classified
STEP_CELLS = 1_000_000

_BITS = np.array([[(m >> i) & 1 for i in range(8)] for m in range(256)], "uint8")


def label_language(lang: Column) -> Column:
    """Code of the language that a label names in any notation, else null."""
    head = F.lower(F.regexp_extract(F.trim(lang), r"^([A-Za-z]+)", 1))
    return F.coalesce(*(F.when(head.isin(*names), F.lit(code)) for code, names in NAMES.items()))


def _alphabet() -> np.ndarray:
    """Class of every code point below 0x10000: letters of the Latin blocks by their lower case, others 0 (1..63; rare letters share)."""
    lut = np.zeros(65536, "uint8")
    ids = {}
    for letter in "abcdefghijklmnopqrstuvwxyzäöüßàâçéèêëîïôùûñáíóúãõìòœæ":
        ids[letter] = len(ids) + 1
    for cp in range(0x250):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            lut[cp] = ids.get(low, 63) if len(low) == 1 else 63
    lut[0x1E9E] = ids["ß"]
    return lut


ALPHABET = _alphabet()


class Text:
    """A batch of documents as one array of letter classes, with its words and n-grams."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts) + "\n"
        cps = np.frombuffer(joined.encode("utf-32-le", "replace"), "uint32")
        c = ALPHABET[np.minimum(cps, 65535)]
        self.c = np.concatenate([np.zeros(1, "uint8"), c, np.zeros(5, "uint8")])  # shifted by one
        lens = np.array([len(t) + 1 for t in texts], "int64")
        self.doc_start = np.concatenate([[0], np.cumsum(lens)])
        letter = self.c != 0
        self.word_start = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
        self.word_end = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1  # after the last letter
        self.word_doc = np.searchsorted(self.doc_start, self.word_start - 1, side="right") - 1

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, codes) of n-grams within a word and the blanks beside it."""
        c = self.c
        size = len(c) - n + 1
        ok = c[1 : 1 + size] != 0
        for i in range(2, n - 1):
            ok &= c[i : i + size] != 0
        at = np.flatnonzero(ok)
        code = np.zeros(len(at), "uint64")
        for i in range(n):
            code = (code << np.uint64(6)) | c[at + i].astype("uint64")
        return at, code | (np.uint64(n) << np.uint64(40))

    def word_of(self, at: np.ndarray) -> np.ndarray:
        """Word of the n-gram at each position: its second character belongs to it."""
        return np.searchsorted(self.word_start, at + 1, side="right") - 1


def _slots(code: np.ndarray) -> list[np.ndarray]:
    return [((code * np.uint64(m)) >> np.uint64(64 - LOG_SLOTS)).astype("int64") for m in MULTIPLIERS]


class Filters:
    """Bit-sliced Bloom filters: byte i of the table has bit l if language l set slot i."""

    def __init__(self, table: np.ndarray):
        self.table = table
        fill = np.array([((table >> i) & 1).mean() for i in range(len(LANGS))])
        self.false_rate = fill ** len(MULTIPLIERS)
        # evidence of an n-gram for each language: shared n-grams count by their share
        pop = _BITS[:, : len(LANGS)].sum(1)
        self.evidence = (_BITS[:, : len(LANGS)] / np.maximum(pop, 1)[:, None]).astype("float32").T.copy()

    @classmethod
    def fit(cls, texts: list[str], labels: list[int], least_docs: int = 2, least_share: float = 0.2) -> "Filters":
        """An n-gram belongs to the languages in whose documents it is at least ``least_share`` times as frequent as where it is most frequent."""
        table = np.zeros(1 << LOG_SLOTS, "uint8")
        if texts:
            t = Text(texts)
            labels = np.array(labels)
            docs = np.bincount(labels, minlength=len(LANGS))
            for n in ORDERS:
                at, code = t.grams(n)
                doc = t.word_doc[t.word_of(at)]
                codes, inv = np.unique(code, return_inverse=True)
                pair = np.unique(inv.astype("int64") * len(texts) + doc)
                df = np.zeros((len(codes), len(LANGS)), "float64")
                np.add.at(df, (pair // len(texts), labels[pair % len(texts)]), 1)
                rate = df / np.maximum(docs, 1)
                member = (df >= least_docs) & (rate >= least_share * rate.max(1, keepdims=True))
                mask = np.packbits(member, axis=1, bitorder="little")[:, 0]
                for s in _slots(codes):
                    np.bitwise_or.at(table, s, mask)
        return cls(table)

    def masks(self, code: np.ndarray) -> np.ndarray:
        out = None
        for s in _slots(code):
            got = self.table[s]
            out = got if out is None else out & got
        return out

    def words(self, t: Text) -> tuple[np.ndarray, np.ndarray]:
        """Evidence (languages x words) and number of n-grams of every word, corrected for false positives."""
        n_words = len(t.word_start)
        score = np.zeros((len(LANGS), n_words), "float32")
        total = np.zeros(n_words, "float32")
        for n in ORDERS:
            at, code = t.grams(n)
            if not len(at):
                continue
            word = t.word_of(at)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            mask = self.masks(code)
            for i in range(len(LANGS)):
                score[i, word[first]] += np.add.reduceat(self.evidence[i][mask], first)
            total[word[first]] += np.diff(np.append(first, len(at)))
        score -= self.false_rate[:, None].astype("float32") * total
        return score, total


def _viterbi(score: np.ndarray, bounds: list[tuple[int, int]], switch: float) -> list[np.ndarray]:
    """Best language of each word of each document (score columns a..b), changes costing ``switch``; all documents step together."""
    n, steps = len(bounds), max(b - a for a, b in bounds)
    state = np.zeros((n, len(LANGS)), "float64")
    back = np.full((steps, n, len(LANGS)), -1, "int8")
    order = sorted(range(n), key=lambda i: bounds[i][0] - bounds[i][1])
    start = np.array([bounds[i][0] for i in order])
    length = np.array([bounds[i][1] - bounds[i][0] for i in order])
    for k in range(steps):
        live = int(np.searchsorted(-length, -k, side="left"))
        s = state[:live]
        if k:
            best = s.argmax(1)
            top = s[np.arange(live), best] - switch
            move = top[:, None] > s
            back[k, :live] = np.where(move, best[:, None], np.arange(len(LANGS)))
            s = np.maximum(s, top[:, None])
        state[:live] = s + score[:, start[:live] + k].T
    out = [None] * n
    for r, i in enumerate(order):
        path = np.empty(length[r], "int8")
        lang = int(state[r].argmax())
        for k in range(length[r] - 1, -1, -1):
            path[k] = lang
            if k:
                lang = int(back[k, r, lang])
        out[i] = path
    return out


def _stretches(path: np.ndarray, at: np.ndarray, end: int, least: int) -> list[list[int]]:
    """[language, first word, after last word] of maximal runs; runs of under ``least`` characters go to their surroundings, shortest first."""
    cuts = np.flatnonzero(np.diff(path)) + 1
    first = [0, *cuts.tolist()]
    runs = [[int(path[a]), a, b] for a, b in zip(first, [*first[1:], len(path)])]
    chars = lambda r: (at[r[2]] if r[2] < len(at) else end) - at[r[1]]
    while len(runs) > 1:
        sizes = [chars(r) for r in runs]
        i = int(np.argmin(sizes))
        if sizes[i] >= least:
            break
        # to the longer neighbour
        left, right = sizes[i - 1] if i else -1, sizes[i + 1] if i + 1 < len(runs) else -1
        runs[i][0] = runs[i - 1][0] if left >= right else runs[i + 1][0]
        merged = [runs[0]]
        for r in runs[1:]:
            if r[0] == merged[-1][0]:
                merged[-1][2] = r[2]
            else:
                merged.append(r)
        runs = merged
    return runs


def classify(texts: list[str], filters: Filters, switch: float = SWITCH, least: int = LEAST_CHARS) -> list[list[tuple[str | None, float, int, int]]]:
    """(language, confidence, first character, after last character) of each stretch of each text. Blank texts have none; a text without any known n-gram has one of language None and confidence 0."""
    t = Text(texts)
    score, _ = filters.words(t)
    n_docs = len(texts)
    edge = np.searchsorted(t.word_doc, np.arange(n_docs + 1))
    cum = np.concatenate([np.zeros((len(LANGS), 1)), np.cumsum(score, axis=1, dtype="float64")], axis=1)
    whole = cum[:, edge[1:]] - cum[:, edge[:-1]]
    best = whole.argmax(0)
    # can any run of words in another language pay for a change? (largest sum of a run, document by document)
    mixed = np.zeros(n_docs, bool)
    if len(t.word_doc):
        base = best[t.word_doc]
        own = score[base, np.arange(len(base))]
        wall = -1e7 * np.arange(1, n_docs + 1)[t.word_doc]
        heads = np.flatnonzero(np.concatenate([[True], t.word_doc[1:] != t.word_doc[:-1]]))
        for i in range(len(LANGS)):
            gain = np.cumsum(score[i] - own, dtype="float64")
            before = np.concatenate([[0.0], gain[:-1]])
            low = np.minimum.accumulate(before + wall) - wall
            mixed[t.word_doc[heads]] |= np.maximum.reduceat(gain - low, heads) > switch
    split = np.flatnonzero(mixed & (best >= 0))
    paths = {}
    # documents of like length step together; the cells held at once are bounded unless a single document exceeds them
    split = split[np.argsort(edge[split + 1] - edge[split], kind="stable")].tolist()
    while split:
        part, longest = [], 0
        while split and (not part or max(longest, edge[split[-1] + 1] - edge[split[-1]]) * (len(part) + 1) <= STEP_CELLS):
            part.append(split.pop())
            longest = max(longest, int(edge[part[-1] + 1] - edge[part[-1]]))
        paths |= zip(part, _viterbi(score, [(int(edge[d]), int(edge[d + 1])) for d in part], switch))
    out = []
    for d, text in enumerate(texts):
        a, b, off = int(edge[d]), int(edge[d + 1]), int(t.doc_start[d])
        if not text.strip():
            out.append([])
            continue
        if a == b or whole[:, d].max() <= 0:
            out.append([(None, 0.0, 0, len(text))])
            continue
        at = t.word_start[a:b] - 1 - off
        runs = _stretches(paths[d], at, len(text), least) if d in paths else [[int(best[d]), 0, b - a]]
        rows = []
        for k, (lang, i, j) in enumerate(runs):
            s = np.sort(np.maximum(cum[:, a + j] - cum[:, a + i], 0))
            own = max(0.0, float(cum[lang, a + j] - cum[lang, a + i]))
            rival = float(s[-2] if own >= s[-1] else s[-1])
            rows.append((LANGS[lang], own / (own + rival) if own else 0.0, int(at[i]) if k else 0, int(at[j]) if k + 1 < len(runs) else len(text)))
        out.append(rows)
    return out


def fit_filters(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = PER_LANGUAGE, sample_chars: tuple[int, int] = SAMPLE_CHARS) -> Filters:
    """Filters from at most ``per_language`` labelled documents of each language; wrong labels are found by a first fit and corrected for the second.

    Documents of ``sample_chars`` (least, most) characters come first; where a language has too few, those nearest to that length follow.
    """
    known = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), label_language(F.col(f"`{lang_col}`")).alias("lang"))
    size = F.length("text")
    known = known.where(F.col("lang").isNotNull() & (F.length(F.trim("text")) > 0)).withColumn("h", F.xxhash64("id")).withColumn("off", F.greatest(F.lit(sample_chars[0]) - size, size - F.lit(sample_chars[1]), F.lit(0)))
    # only the hash and the identifier are ranked; the texts of the chosen documents follow by a join with a bounded side
    chosen = known.select("id", "lang", "off", "h").withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("off", "h", "id"))).where(F.col("k") <= per_language).select("id")
    sample = known.join(F.broadcast(chosen), "id").select("id", "text", "lang").toArrow().sort_by("id")
    texts, langs = sample.column("text").to_pylist(), [LANGS.index(x) for x in sample.column("lang").to_pylist()]
    first = Filters.fit(texts, langs)
    again = [(t, LANGS.index(r[0][0])) for t, r in zip(texts, classify(texts, first)) if len(r) == 1 and r[0][0]]
    return Filters.fit([t for t, _ in again], [x for _, x in again])


def language_stretches(docs: DataFrame, id_col: str, text_col: str, filters: Filters) -> DataFrame:
    """(id, seg_no, stretches, lang, confidence, first_char, end_char): every stretch of every document, numbered from 1 in text order, with their number.

    Null, empty and blank texts have no stretch; a text without letters of a known language has one with lang null and
    confidence 0; ties go to the first language by code. Extra columns are ignored.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(filters.table)  # 2^20 bytes, whatever the data

    def run(batches):
        own = Filters(held.value)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            # a few million characters at a time bound the memory
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size + len(texts[b]) <= 1_000_000):
                    size += len(texts[b])
                    b += 1
                rows = [(i, k + 1, len(stretches), *r) for i, stretches in zip(ids[a:b], classify(texts[a:b], own)) for k, r in enumerate(stretches)]
                cols = list(zip(*rows)) if rows else [[]] * 7
                types = (batch.schema.field(0).type, pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["id", "seg_no", "stretches", "lang", "confidence", "first_char", "end_char"])
                a = b

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where(F.col("id").isNotNull() & (F.length(F.trim("text")) > 0))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, seg_no int, stretches int, lang string, confidence double, first_char int, end_char int")
