"""Similarity clusters by power iteration on sparse affinities.

1. Affinities. Pairs that pass the gate stream out of the candidate search; of those it meets, each task keeps the
   ``NEAREST`` of every vertex, which are affinities, and a spanning forest, so that what was linked stays linked. A dense group
   of n rows leaves a few times n pairs a task instead of n * n. The nearest of a vertex are the same however pairs are spread.
2. Power iteration. Several random vectors are multiplied by the row-normalised affinities, as joins. Vertices that
   the walk mixes well come to equal places; those that only a few links join stay apart.
3. k-means on the embedding. Centres start at vertices whose affinity sum is a local maximum, so k need not be given; centres
   that are no farther from each other than their members are from them become one; a vertex moves to the nearest centre
   among its own and its neighbours'. These are the sub-clusters; members rank by their affinity to the others.
4. Linked groups. Sub-clusters with a link between them are one linked group; they are merged by the linking operator.

All arithmetic is in whole numbers, so that a task repeated in another order of its rows gives the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crestline.llm.hamming import gate_links, usable
from crestline.llm.linking import link_groups
from crestline.operators.joins import spread_join
from crestline.operators.linkage import spanning_forest
from crestline.plans.scratch import Scratch

BITS = 64
BLOCK = 200_000
NEAREST = 12
VECTORS, ROUNDS, SETTLE = 4, 6, 1
APART = 2  # squared distance of two centres, in mean squared distances of their members, from which they stay apart
UNIT = 1024  # affinity of equal hashes; it falls by e every four bits


def _forest(a: np.ndarray, b: np.ndarray, dist: np.ndarray) -> np.ndarray:
    """Positions of the minimum spanning forest of the pairs. Ties are broken by the pair, so the forest is the same in whatever order and pieces they come: a repeated task gives the same rows."""
    return spanning_forest(dist, np.minimum(a, b), np.maximum(a, b))


def _nearest(a: np.ndarray, b: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Positions of the pairs that are among the ``most`` nearest of either end, ties by the other end; repeated pairs once."""
    order = np.lexsort((dist, np.maximum(a, b), np.minimum(a, b)))
    lo, hi = np.minimum(a, b)[order], np.maximum(a, b)[order]
    order = order[np.concatenate([[True], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])] if len(order) else order
    u, v, d, e = np.concatenate([a[order], b[order]]), np.concatenate([b[order], a[order]]), np.tile(dist[order], 2), np.tile(order, 2)
    by = np.lexsort((v, d, u))
    head = np.flatnonzero(np.concatenate([[True], u[by][1:] != u[by][:-1]])) if len(by) else np.zeros(0, "int64")
    place = np.arange(len(by)) - np.repeat(head, np.diff(np.append(head, len(by))))
    return np.unique(e[by[place < most]])


def _thin(batches):
    """Pairs of a task to their spanning forest and the nearest of each vertex; memory follows the vertices, not the pairs."""
    held = [np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0, "int64")]
    waiting, n = [], 0

    def settle():
        nonlocal held, waiting, n
        cols = [np.concatenate([h, *(w[i] for w in waiting)]) for i, h in enumerate(held)]
        keep = np.union1d(_forest(*cols), _nearest(*cols, NEAREST)) if len(cols[0]) else np.zeros(0, "int64")
        held, waiting, n = [c[keep] for c in cols], [], 0

    for batch in batches:
        waiting.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        n += batch.num_rows
        if n >= max(BLOCK, 2 * len(held[0])):
            settle()
    settle()
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=["a", "b", "dist"])


def sparse_affinities(rows: DataFrame, cut: Scratch, **gate) -> DataFrame:
    """(a, b, dist): links between p values: the nearest of each, and what keeps every linked group linked."""
    by_p, by_d = gate_links(rows, cut, **gate)
    links = by_p.select(F.col("p_a").alias("a"), F.col("p_b").alias("b"), F.col("p_dist").cast("long").alias("dist")).unionByName(
        by_d.select(F.col("p_a").alias("a"), F.col("p_b").alias("b"), F.col("p_dist").cast("long").alias("dist")))
    thin = links.mapInArrow(_thin, "a long, b long, dist long")
    return thin.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("dist").alias("dist"))


def nearest_affinities(links: DataFrame) -> DataFrame:
    """(u, v, w) both ways: the links that are among the NEAREST of either end. A vertex has at most NEAREST rows a task before they are ranked."""
    both = links.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v"), "dist"), F.struct(F.col("b").alias("u"), F.col("a").alias("v"), "dist"))))
    place = F.row_number().over(W.partitionBy("u").orderBy("dist", "v"))
    kept = both.withColumn("place", place).where(F.col("place") <= NEAREST).drop("place")
    weight = F.round(F.exp(-F.col("dist") / 4.0) * UNIT).cast("long").alias("w")
    return kept.select(F.inline(F.array(F.struct("u", "v", weight), F.struct(F.col("v").alias("u"), F.col("u").alias("v"), weight)))).distinct()


def _embedding(near: DataFrame, cut: Scratch, vectors: int, rounds: int) -> DataFrame:
    """(u, deg, x0, x1, ...): places of the vertices after the rounds."""
    names = [f"x{i}" for i in range(vectors)]
    degree = near.groupBy("u").agg(F.sum("w").alias("deg"))
    x = cut.cut(degree.select("u", "deg", *(F.shiftright(F.xxhash64("u", F.lit(i)), 33).alias(n) for i, n in enumerate(names))))
    for _ in range(rounds):
        # x <- (x + D^-1 A x) / 2; rows of a vertex that many are near to are summed before the shuffle
        pushed = near.join(x.select(F.col("u").alias("v"), *names), "v").groupBy("u").agg(*(F.sum(F.col("w") * F.col(n)).alias(f"s_{n}") for n in names))
        x = cut.cut(x.join(pushed, "u").select("u", "deg", *(F.shiftright(F.col(n) + F.expr(f"s_{n} div deg"), 1).alias(n) for n in names)))
    return x


def _gap(a: list, b: list):
    """Squared distance, in units that don't overflow when they are summed."""
    return sum((F.shiftright(p - q, 14) * F.shiftright(p - q, 14) for p, q in zip(a[1:], b[1:])), F.shiftright(a[0] - b[0], 14) * F.shiftright(a[0] - b[0], 14))


def _power_clusters(near: DataFrame, cut: Scratch, vectors: int, rounds: int, settle: int) -> DataFrame:
    """(v, centre) for every vertex with an affinity."""
    names = [f"x{i}" for i in range(vectors)]
    x = _embedding(near, cut, vectors, rounds)
    # first centres: every vertex follows its heaviest neighbour, if that is heavier than itself
    rank = F.struct(F.col("deg"), F.col("v"))
    best = near.select("u", "v").join(x.select(F.col("u").alias("v"), "deg"), "v").groupBy("u").agg(F.max(rank).alias("top"))
    up = F.when(F.col("top") > F.struct(F.col("deg"), F.col("u").alias("v")), F.col("top.v")).otherwise(F.col("u"))
    label = cut.cut(x.join(best, "u").select("u", up.alias("c")))
    moved = 1
    while moved:
        heads = label.select(F.col("u").alias("c"), F.col("c").alias("cc"))
        jump = cut.cut(spread_join(label, heads, ["c"]).select("u", F.col("cc").alias("c"), (F.col("c") != F.col("cc")).alias("moved")))
        moved = jump.where("moved").count()
        label = jump.select("u", "c")
    means = lambda rows: rows.groupBy("c").agg(*(F.expr(f"sum({n}) div count(*)").alias(f"m_{n}") for n in names))
    placed = cut.cut(x.join(label, "u").select("u", "c", *names))
    own = [F.col(n) for n in names]
    # centres whose distance is no more than their members' from them are one
    middle = cut.cut(means(placed))
    spread = spread_join(placed, middle, ["c"]).groupBy("c").agg((F.sum(_gap(own, [F.col(f"m_{n}") for n in names])) / F.count(F.lit(1))).alias("wide"))
    centre = cut.cut(middle.join(spread, "c"))
    side = lambda s: label.select(F.col("u").alias(s), F.col("c").alias(f"c_{s}"))
    touching = near.where("u < v").select("u", "v").join(side("u"), "u").join(side("v"), "v").select(F.least("c_u", "c_v").alias("c_u"), F.greatest("c_u", "c_v").alias("c_v")).where("c_u <> c_v").distinct()
    of = lambda s: centre.select(F.col("c").alias(f"c_{s}"), F.col("wide").alias(f"wide_{s}"), *(F.col(f"m_{n}").alias(f"{s}_{n}") for n in names))
    met = touching.join(of("u"), "c_u").join(of("v"), "c_v")
    one = met.where(_gap([F.col(f"u_{n}") for n in names], [F.col(f"v_{n}") for n in names]) <= APART * (F.col("wide_u") + F.col("wide_v")))
    merged = link_groups(one.select("c_u", "c_v"), "c_u", "c_v").select(F.col("vertex").alias("c"), F.col("group").alias("into"))
    placed = cut.cut(spread_join(placed, merged, ["c"], "left").select("u", F.coalesce("into", "c").alias("c"), *names))
    for _ in range(settle):
        label = placed.select("u", "c")
        middle = means(placed)
        offered = near.select("u", "v").join(label.select(F.col("u").alias("v"), "c"), "v").select("u", "c").unionByName(label).distinct()
        offered = spread_join(cut.cut(offered), middle, ["c"]).join(placed.drop("c"), "u")
        nearest = F.min(F.struct(_gap(own, [F.col(f"m_{n}") for n in names]).alias("gap"), F.col("c"))).getField("c")
        placed = cut.cut(offered.groupBy("u", *names).agg(nearest.alias("c")))
    return placed.select(F.col("u").alias("v"), F.col("c").alias("centre"))


def _labelled(hashes: DataFrame, cut: Scratch, vectors: int, rounds: int, settle: int, gate: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, affinities both ways, (v, centre, cluster)): sub-cluster and linked group of every p with a link."""
    rows = cut.cut(usable(hashes))
    links = cut.cut(sparse_affinities(rows, cut, **gate))
    near = cut.cut(nearest_affinities(links))
    label = cut.cut(_power_clusters(near, cut, vectors, rounds, settle))
    la = label.select(F.col("v").alias("a"), F.col("centre").alias("ca"))
    lb = label.select(F.col("v").alias("b"), F.col("centre").alias("cb"))
    crossing = links.join(la, "a").join(lb, "b").where("ca <> cb").select("ca", "cb").distinct()
    merged = link_groups(crossing, "ca", "cb").select(F.col("vertex").alias("centre"), F.col("group").alias("merged"))
    return rows, near, cut.cut(spread_join(label, merged, ["centre"], "left").select("v", "centre", F.coalesce("merged", "centre").alias("cluster")))


def similarity_clusters(hashes: DataFrame, vectors: int = VECTORS, rounds: int = ROUNDS, settle: int = SETTLE, **gate) -> DataFrame:
    """One row per member of each cluster of at least two rows: ``first_ord`` (its smallest ord),
    ``ord``, ``size`` and ``dist_sum``, by which members rank (the sum of p distances to all members is their internal affinity, negated).

    A cluster is all that is linked, directly or through others: sub-clusters with a link between them. Rows with a null ord, p or d
    are left out; redelivered rows count once; rows with equal hashes are members of one cluster; an empty table gives no row; extra
    columns are ignored.
    """
    cut = Scratch(hashes.sparkSession, "spectral")
    rows, _, label = _labelled(hashes, cut, vectors, rounds, settle, gate)
    whole = label.select(F.col("v").alias("p"), "cluster")
    # p values without a link are clusters of their own if several rows hold them
    member = cut.cut(spread_join(rows, whole, ["p"], "left").select("ord", "p", F.when(F.col("cluster").isNull(), F.col("p")).otherwise(F.col("cluster")).alias("cluster"), F.col("cluster").isNull().alias("alone")))
    bit = lambda i: F.shiftrightunsigned("p", i).bitwiseAND(F.lit(1))
    # the sum of distances to all members follows from how many members have each bit: no pairs
    stats = member.groupBy("alone", "cluster").agg(F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("size"), *(F.sum(bit(i)).alias(f"b{i}") for i in range(BITS))).where("size > 1")
    per = sum((F.when(bit(i) == 1, F.col("size") - F.col(f"b{i}")).otherwise(F.col(f"b{i}")) for i in range(1, BITS)), F.when(bit(0) == 1, F.col("size") - F.col("b0")).otherwise(F.col("b0")))
    return spread_join(member, stats, ["alone", "cluster"]).select("alone", "cluster", "first_ord", "size", "ord", per.alias("dist_sum"))


def similarity_subclusters(hashes: DataFrame, vectors: int = VECTORS, rounds: int = ROUNDS, settle: int = SETTLE, **gate) -> DataFrame:
    """(group_ord, first_ord, ord, size, affinity): members of the sub-clusters that the embedding tells apart within each linked group,
    by the smallest ord of group and sub-cluster, with the size of the sub-cluster and the member's affinity to its other hashes.

    Rows without hashes or without a similar or equal row are left out; redelivered rows count once; rows with equal p are in one
    sub-cluster, and each adds UNIT for every other of them.
    """
    cut = Scratch(hashes.sparkSession, "subclusters")
    rows, near, label = _labelled(hashes, cut, vectors, rounds, settle, gate)
    side = lambda s: label.select(F.col("v").alias(s), F.col("centre").alias(f"c_{s}"))
    held = cut.cut(rows.groupBy("p").agg(F.count(F.lit(1)).alias("copies")))
    inner = near.join(side("u"), "u").join(side("v"), "v").where("c_u = c_v").join(held.select(F.col("p").alias("v"), "copies"), "v")
    inner = inner.groupBy(F.col("u").alias("p")).agg(F.sum(F.col("w") * F.col("copies")).alias("near"))
    per = held.join(label.withColumnRenamed("v", "p"), "p", "left").join(inner, "p", "left").where("centre is not null or copies > 1")
    per = per.select("p", F.coalesce("centre", "p").alias("centre"), F.coalesce("cluster", "p").alias("cluster"), F.col("centre").isNull().alias("alone"), (F.coalesce("near", F.lit(0)) + (F.col("copies") - 1) * UNIT).alias("affinity"))
    member = cut.cut(spread_join(rows.select("ord", "p"), per, ["p"]))
    firsts = cut.cut(member.groupBy("alone", "cluster", "centre").agg(F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("size")))
    groups = firsts.groupBy("alone", "cluster").agg(F.min("first_ord").alias("group_ord"))
    firsts = spread_join(firsts, groups, ["alone", "cluster"])
    return spread_join(member, firsts.select("alone", "centre", "group_ord", "first_ord", "size"), ["alone", "centre"]).select("group_ord", "first_ord", "ord", "size", "affinity")


def with_typical(members: DataFrame) -> DataFrame:
    """Adds ``typical_ord``. One value per cluster and task is shuffled."""
    top = members.groupBy("first_ord").agg(F.min(F.struct("dist_sum", "ord")).getField("ord").alias("typical_ord"))
    return members.join(top, "first_ord")
