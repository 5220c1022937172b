"""Bits of perceptual hashes (I5-I8), the gate (F19) and the pairs that pass it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.text import bound
from crestline.operators.components import label_nodes
from crestline.operators.joins import blocked_pairs, spread_join
from crestline.operators.linkage import spanning_forest
from crestline.plans.scratch import Scratch

BITS = 64


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def gate(p_dist: Column, d_dist: Column, t: tuple[int, int, int] = V.GATE) -> Column:
    """p within the first threshold, or within the second with d within the third. A null distance fails its part."""
    return F.coalesce(p_dist <= t[0], F.lit(False)) | F.coalesce((p_dist <= t[1]) & (d_dist <= t[2]), F.lit(False))


def _pack(bits: Column) -> Column:
    """Array of 64 booleans to a bigint, bit i at 2^i (bit 63 is the sign)."""
    return F.aggregate(F.transform(bits, lambda b, i: F.when(b, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(x))


def _doubles(block: Column) -> Column:
    return F.transform(block, lambda v: v.cast("double"))


def phash_bits(block: Column) -> Column:
    """Bit i: value i of an 8 x 8 block is above the median (mean of the two middle values, in double arithmetic)."""
    middle = lambda s: F.element_at(s, 32) + F.element_at(s, 33)
    return bound(_doubles(block), lambda x: bound(F.array_sort(x), lambda s: bound(middle(s), lambda m: _pack(F.transform(x, lambda v: v * 2 > m)))))


def dhash_bits(block: Column) -> Column:
    """Bit i: the next value of the row, cyclically, is larger."""
    nxt = lambda i: (F.floor(i / 8) * 8 + (i + 1) % 8).cast("int")
    return bound(_doubles(block), lambda x: _pack(F.transform(x, lambda v, i: F.get(x, nxt(i)) > v)))


def ahash_bits(block: Column) -> Column:
    """Bit i: value i is above the mean."""
    mean = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / F.size(x)
    return bound(_doubles(block), lambda x: bound(mean(x), lambda m: _pack(F.transform(x, lambda v: v > m))))


def hash_classes(hashes: DataFrame, key: str = "ord") -> DataFrame:
    """(k, p, d, class): rows with both hashes, one per key (of several the least p and d), and the least key of all rows with equal hashes."""
    cut = Scratch(hashes.sparkSession, "classes")
    rows = cut.cut(hashes.select(F.col(key).alias("k"), "p", "d").dropna().groupBy("k").agg(F.min(F.struct("p", "d")).alias("h")).select("k", "h.*"))
    heads = rows.groupBy("p", "d").agg(F.min("k").alias("class"))
    return cut.cut(spread_join(rows, heads, ["p", "d"]))


def _near_heads(heads: DataFrame, t: tuple[int, int, int], hot: int) -> DataFrame:
    """(i, j, p_dist, d_dist), i < j, maybe several times: pairs of rows (k, p, d) of different k that pass the gate, by multi-index hashing.

    p is cut into chunks of which one differs in at most two bits (pigeonhole); chunks with at most one bit flipped on
    either side are equal then.
    """
    cut = Scratch(heads.sparkSession, "near")
    radius = max(t[0], t[1])
    chunks = max(1, -(-(radius + 1) // 3))
    # a row becomes up to a hundred entries or more: its own number of tasks, which adaptive execution leaves as it is
    rows = heads.repartition(int(heads.sparkSession.conf.get("spark.sql.shuffle.partitions")), "k")
    cuts = [(BITS * c // chunks, BITS * (c + 1) // chunks) for c in range(chunks)]

    def variants(c: int, a: int, b: int) -> Column:
        part = F.shiftrightunsigned("p", a).bitwiseAND(F.lit((1 << (b - a)) - 1 if b - a < 64 else -1))
        flips = F.array(*(F.lit(m).cast("long") for m in [0, *((1 << i) if i < 63 else -(1 << 63) for i in range(b - a))]))
        return F.transform(flips, lambda m: F.struct(F.lit(c).alias("c"), part.bitwiseXOR(m).alias("v")))

    def joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        x, y = left.alias("x"), right.alias("y")
        pd, dd = distance(F.col("x.p"), F.col("y.p")), distance(F.col("x.d"), F.col("y.d"))
        on = F.col("x.k") < F.col("y.k")
        for k in keys:
            on = on & (F.col(f"x.{k}") == F.col(f"y.{k}"))
        # a generator keeps inferred filters out of the join's condition
        pair = F.struct(F.col("x.k").alias("i"), F.col("y.k").alias("j"), pd.alias("p_dist"), dd.alias("d_dist"))
        return x.join(y, on & gate(pd, dd, t)).select(F.inline(F.array(pair)))

    entries = cut.cut(rows.select("k", "p", "d", F.inline(F.concat(*(variants(c, a, b) for c, (a, b) in enumerate(cuts))))))
    return blocked_pairs(entries, ["c", "v"], ["k", "d"], joined, hot)


def gate_pairs(hashes: DataFrame, key: str = "ord", t: tuple[int, int, int] = V.GATE, hot: int = 20_000) -> DataFrame:
    """(i, j, p_dist, d_dist), i < j: pairs of different hashes that pass the gate, each by its first row; ``hash_classes`` has the rows of each.

    Rows with equal hashes are one member of a pair, so copies are not multiplied. Null hashes are in no pair.
    """
    heads = hash_classes(hashes, key).where(F.col("k") == F.col("class")).select("k", "p", "d")
    return _near_heads(heads, t, hot).distinct()


def _thin(batches):
    """Pairs of a task to a spanning forest of them; memory follows the rows, not the pairs."""
    held, waiting, n = [np.empty(0, "int64")] * 3, [], 0

    def settle(held, waiting):
        cols = [np.concatenate([h, *(w[i] for w in waiting)]) for i, h in enumerate(held)]
        keep = spanning_forest(*cols)
        return [c[keep] for c in cols]

    for batch in batches:
        waiting.append([batch.column(i).to_numpy(zero_copy_only=False).astype("int64") for i in range(3)])
        n += batch.num_rows
        if n >= max(200_000, 2 * len(held[0])):
            held, waiting, n = settle(held, waiting), [], 0
    held = settle(held, waiting)
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=["d", "src", "dst"])


def similar_groups(hashes: DataFrame, key: str = "ord", t: tuple[int, int, int] = V.GATE, hot: int = 20_000) -> DataFrame:
    """(node, component) of all rows with both hashes: the least key of those linked by the gate, directly or through others.

    Rows with equal p pass the gate, so p values are what is linked; pairs are never written: each task of the search keeps a
    spanning forest of those it meets.
    """
    cut = Scratch(hashes.sparkSession, "similar")
    rows = cut.cut(hashes.select(F.col(key).alias("k"), "p", "d").dropna().distinct())
    heads = rows.select(F.col("p").alias("k"), "p", "d").distinct()
    links = _near_heads(heads, t, hot).select(F.col("p_dist").cast("long").alias("d"), F.col("i").alias("src"), F.col("j").alias("dst")).mapInArrow(_thin, "d long, src long, dst long")
    first = cut.cut(rows.groupBy("p").agg(F.min("k").alias("k")))
    of = cut.cut(label_nodes(first, links.select("src", "dst"), "p").withColumnRenamed("node", "p").join(first, "p"))
    least = of.groupBy("component").agg(F.min("k").alias("least"))
    by_p = spread_join(of, least, ["component"]).select("p", F.col("least").alias("component"))
    return spread_join(rows.select("k", "p").distinct(), by_p, ["p"]).select(F.col("k").alias("node"), "component")
