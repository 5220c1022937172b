"""Single linkage down to k groups (C9, J2, W7): a minimum spanning forest by Boruvka rounds, cut after the merges that k allows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crestline.operators.components import connected_components, label_nodes
from crestline.operators.joins import spread_join
from crestline.operators.ranks import numbered
from crestline.plans.scratch import Scratch

BLOCK_ROWS = 8192
SLICE = 256
FOREST = "d int, i long, j long"


def spanning_forest(d: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Positions of the edges of the minimum spanning forest, in (d, i, j) order: the edges that Kruskal keeps.

    Boruvka rounds on arrays: every tree takes its first edge to another tree; the order is total, so no ring can arise.
    """
    order = np.lexsort((j, i, d))
    names, flat = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b = flat[: len(i)][order], flat[len(i) :][order]
    tree, alive, kept = np.arange(len(names)), np.flatnonzero(a != b), []
    while len(alive):
        x, y = tree[a[alive]], tree[b[alive]]
        apart = x != y
        alive, x, y = alive[apart], x[apart], y[apart]
        if not len(alive):
            break
        first = np.full(len(names), len(order))
        # edges stand in order: the last write of a reversed row is the first edge
        first[x[::-1]] = alive[::-1]
        other = np.full(len(names), len(order))
        other[y[::-1]] = alive[::-1]
        first = np.minimum(first, other)
        chosen = np.unique(first[first < len(order)])
        kept.append(chosen)
        u, v = tree[a[chosen]], tree[b[chosen]]
        label = np.arange(len(names))
        while True:
            low = np.minimum(label[u], label[v])
            now = label.copy()
            np.minimum.at(now, u, low)
            np.minimum.at(now, v, low)
            now = now[now]
            if (now == label).all():
                break
            label = now
        tree = label[tree]
    return order[np.sort(np.concatenate(kept))] if kept else np.zeros(0, "int64")


def _nearest(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
    """For every tree of the rows x the first edge (d, i, j) to a row of y of another tree."""
    b, q, s = y["k"].to_numpy(), y["p"].to_numpy().view("uint64"), y["tree"].to_numpy()
    by = np.argsort(b, kind="stable")
    b, q, s = b[by], q[by], s[by]
    out = []
    for k in range(0, len(x), SLICE):
        a, p, t = (x[c].to_numpy()[k : k + SLICE] for c in ("k", "p", "tree"))
        dist = np.bitwise_count(p.view("uint64")[:, None] ^ q[None, :])
        dist[t[:, None] == s[None, :]] = 255
        # of equal distances the least other row, which gives the least (i, j) for either end
        at = dist.argmin(1) if len(q) else np.zeros(0, "int64")
        if len(at):
            least = dist[np.arange(len(a)), at]
            got = least < 255
            out.append(np.stack([t[got], least[got].astype("int64"), np.minimum(a, b[at])[got], np.maximum(a, b[at])[got]]))
    rows = np.concatenate(out, axis=1) if out else np.zeros((4, 0), "int64")
    order = np.lexsort((rows[3], rows[2], rows[1], rows[0]))
    rows = rows[:, order]
    head = np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]) if rows.shape[1] else np.zeros(0, bool)
    return pd.DataFrame({"tree": rows[0, head], "d": rows[1, head].astype("int32"), "i": rows[2, head], "j": rows[3, head]})


def minimum_forest(hashes: DataFrame, key: str = "ord", block_rows: int | None = None) -> DataFrame:
    """(d, i, j): minimum spanning tree of all rows by p distance, ties by (i, j). Rows with a null key or p are left out; of rows with one key the least p counts.

    Rows with equal p hang on the least of them; the others are joined in Boruvka rounds: rows are cut into blocks, every pair of
    blocks is a task's worth of distances, and one edge per tree and block leaves it. Trees at least halve in each round.
    """
    block_rows = block_rows or BLOCK_ROWS
    cut = Scratch(hashes.sparkSession, "forest")
    rows = cut.cut(hashes.select(F.col(key).cast("long").alias("k"), "p").dropna().groupBy("k").agg(F.min("p").alias("p")))
    heads = cut.cut(rows.groupBy("p").agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("n")))
    twins = spread_join(rows.withColumnRenamed("k", "j"), heads.select("p", F.col("k").alias("i")), ["p"]).where("i <> j").select(F.lit(0).alias("d"), "i", "j")
    forest = [cut.cut(twins)]
    nodes = cut.cut(heads.select("k", "p", F.col("k").alias("tree")))
    blocks = max(1, -(-nodes.count() // block_rows))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    while True:
        own = nodes.withColumn("b", F.pmod(F.xxhash64("k"), F.lit(blocks)).cast("int"))
        left = own.withColumn("o", every).select(F.col("b").alias("bi"), F.col("o").alias("bj"), "k", "p", "tree")
        right = own.withColumn("o", every).select(F.col("o").alias("bi"), F.col("b").alias("bj"), "k", "p", "tree")
        near = left.groupBy("bi", "bj").cogroup(right.groupBy("bi", "bj")).applyInPandas(_nearest, "tree long, " + FOREST)
        best = near.groupBy("tree").agg(F.min(F.struct("d", "i", "j")).alias("e")).select("e.*").distinct()
        best = cut.cut(best)
        if best.isEmpty():
            break
        forest.append(best)
        tree_of = nodes.select("k", "tree")
        ends = best.join(tree_of.select(F.col("k").alias("i"), F.col("tree").alias("src")), "i").join(tree_of.select(F.col("k").alias("j"), F.col("tree").alias("dst")), "j")
        merged = connected_components(ends).select(F.col("node").alias("tree"), F.col("component").alias("now"))
        nodes = cut.cut(spread_join(nodes, merged, ["tree"], "left").select("k", "p", F.coalesce("now", "tree").alias("tree")))
    out = forest[0]
    for part in forest[1:]:
        out = out.unionByName(part)
    return out


def first_merges(forest: DataFrame, merges: int) -> DataFrame:
    """The first edges in (d, i, j) order. Whole distances are taken by their counts; only those of the last one are ranked."""
    counts = {r.d: r.n for r in forest.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 65 rows
    left, last = merges, None
    for d in sorted(counts):
        if counts[d] > left:
            last = d
            break
        left -= counts[d]
    if last is None:
        return forest
    whole = forest.where(F.col("d") < last)
    return whole.unionByName(numbered(forest.where(F.col("d") == last), ["i", "j"], "place").where(F.col("place") <= left).drop("place")) if left else whole


def single_linkage(hashes: DataFrame, k: int, key: str = "ord", unhashed: int = 0) -> DataFrame:
    """(node, component) after merging the nearest groups until k are left.

    k is at least 1; groups without a hash (``unhashed``) count but never merge, so the floor is their number plus one; nothing
    merges if there are k groups or fewer. Ties are merged in (distance, i, j) order.
    """
    rows = hashes.select(F.col(key).cast("long").alias("node"), "p").dropna().select("node").distinct()
    merges = max(0, rows.count() + unhashed - max(1, k))
    kept = first_merges(minimum_forest(hashes, key), merges)
    return label_nodes(rows, kept.select(F.col("i").alias("src"), F.col("j").alias("dst")))
