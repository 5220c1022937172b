"""Fixed-capacity sequences of neighbouring documents, along a space-filling curve.

Documents become hashed word vectors, projected to few dimensions; the Hilbert key of the point orders them so that
neighbours on the curve are alike. The curve is cut into ranges, and every range is packed by itself: block by block along
the curve, largest first into the open sequence that it fills best, with open sequences handed on to the next block.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crestline.plans.scratch import Scratch

CAPACITY = 2048
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# fixed value: the pattern published with byte-level BPE vocabularies of this kind
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DIMS, DEPTH, FEATURES = 4, 8, 256
BLOCK = 48  # documents of the curve that are packed together
RANGE_TOKENS = 8_000_000
MOST_VOCABULARY = 64_000_000  # bytes of a vocabulary file, which is broadcast


def vocabulary(path: str) -> bytes:
    """The vocabulary file, read where the plan is made; it goes to the tasks, whose machines need not have it."""
    with open(path, "rb") as f:
        raw = f.read(MOST_VOCABULARY + 1)
    if len(raw) > MOST_VOCABULARY:
        raise ValueError(f"{path} is no vocabulary: more than {MOST_VOCABULARY} bytes")
    return raw


@lru_cache(maxsize=2)
def _encoding(raw: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokenizer(path: str):
    return _encoding(vocabulary(path))


def hilbert_keys(points: np.ndarray, depth: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points (rows) with ``depth`` bits a coordinate: inverse Gray code of the rotated bits."""
    x = points.astype("int64").T.copy()
    dims = len(x)
    q = 1 << (depth - 1)
    while q > 1:
        mask = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & mask)
            x[0] = np.where(high, x[0] ^ mask, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], "int64")
    q = 1 << (depth - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], "int64")
    for b in range(depth - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


_PLANES = np.random.default_rng(7).standard_normal((FEATURES, DIMS))


def curve_keys(texts: list[str]) -> np.ndarray:
    """Hilbert keys of the texts' hashed word vectors (bytes of words, hashed by position-free sums)."""
    joined = "\0".join(texts).encode("utf-8", "replace") + b"\0"
    raw = np.frombuffer(joined, "uint8")
    inside = raw > 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype("int8")))
    first, last = edge[::2], edge[1::2]
    doc = np.searchsorted(np.flatnonzero(raw == 0), first)
    n = len(texts)
    point = np.zeros((n, DIMS))
    if len(first):
        size = last - first
        place = np.minimum(np.arange(len(raw)) - np.repeat(first, size)[np.cumsum(inside) - 1], 31)[inside]
        power = np.array([pow(0x100000001B3, k, 2**64) for k in range(32)], "uint64")
        word = np.add.reduceat(raw[inside].astype("uint64") * power[place], np.concatenate([[0], np.cumsum(size)[:-1]]))
        feature = ((word * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype("int64")
        counts = np.zeros((n, FEATURES), "float32")
        np.add.at(counts, (doc, feature), 1)
        norm = np.sqrt((counts * counts).sum(1, keepdims=True))
        point = (counts / np.maximum(norm, 1)) @ _PLANES
    # a smooth step spreads the points over the grid
    grid = np.clip(((np.tanh(point / 1.5) + 1) / 2 * (1 << DEPTH)).astype("int64"), 0, (1 << DEPTH) - 1)
    return hilbert_keys(grid, DEPTH)


class Packer:
    """Best fit of blocks of items into open containers; ``place`` gives (container, offset) of every item."""

    def __init__(self, capacity: int):
        self.capacity, self.open, self.used = capacity, [], 0

    def place(self, sizes: list[int]) -> list[tuple[int, int]]:
        out: list = [None] * len(sizes)
        for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
            size = sizes[k]
            at = bisect_left(self.open, (size, -1))  # the least room that suffices
            if at < len(self.open):
                room, box = self.open.pop(at)
            else:
                room, box, self.used = self.capacity, self.used, self.used + 1
            out[k] = (box, self.capacity - room)
            if room > size or not size:
                insort(self.open, (room - size, box))
        return out


def pack_documents(docs: DataFrame, id_col: str, text_col: str, capacity: int = CAPACITY, path: str = TOKENIZER, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """(id, part, sequence, offset, first_token, n_tokens): where every document goes.

    A document longer than ``capacity`` fills whole sequences of its own and its rest is packed like a document (parts 0, 1, ...);
    all others stay whole. Null and empty texts take no tokens and come out with a sequence and an offset. Repeated identifiers and
    texts are placed row by row. ``sequence`` is unique, not dense. Extra columns are ignored; an empty table gives no row.
    """
    cut = Scratch(docs.sparkSession, "packing")
    words = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def measure(batches):
        enc = _encoding(words.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            size = [len(enc.encode_ordinary(t)) for t in texts]
            keys = np.concatenate([curve_keys(texts[a : a + 500]) for a in range(0, len(texts), 500)]) if texts else np.zeros(0, "int64")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(keys)], names=["id", "tokens", "key"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = dict(rows.dtypes)["id"]
    sized = cut.cut(rows.mapInArrow(measure, f"id {kind}, tokens long, key long"))
    total = sized.agg(F.sum("tokens")).first()[0] or 0
    ranges = max(1, -(-total // range_tokens))
    whole = F.floor(F.col("tokens") / capacity)
    parts = sized.select("id", "key", "tokens", F.explode(F.sequence(F.lit(0), F.when((F.col("tokens") % capacity == 0) & (F.col("tokens") > 0), whole - 1).otherwise(whole))).alias("part"))
    parts = parts.select("id", "key", F.col("part").cast("int").alias("part"), (F.col("part") * capacity).alias("first_token"), F.least(F.lit(capacity).cast("long"), F.col("tokens") - F.col("part") * capacity).alias("n_tokens"))
    # the hash splits documents with one key (copies, blank pages) among ranges
    order = ["key", "spread", "part"]
    along = parts.withColumn("spread", F.xxhash64("id")).repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def pack(batches):
        packer, held = Packer(capacity), []
        base = TaskContext.get().partitionId() << 40
        names = ["id", "part", "sequence", "offset", "first_token", "n_tokens"]

        def flush(rows):
            places = packer.place([r[3] for r in rows])
            cols = list(zip(*((r[0], r[1], base + box, off, r[2], r[3]) for r, (box, off) in zip(rows, places))))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (own, pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=names)

        for batch in batches:
            own = batch.schema.field(0).type
            held += zip(*(batch.column(i).to_pylist() for i in range(4)))
            while len(held) >= BLOCK:
                yield flush(held[:BLOCK])
                held = held[BLOCK:]
        if held:
            yield flush(held)

    return along.select("id", "part", "first_token", "n_tokens").mapInArrow(pack, f"id {kind}, part int, sequence long, offset int, first_token long, n_tokens long")
