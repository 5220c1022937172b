"""Groups of records linked directly or through others: strip leaves, compress chains, solve the core, restore."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crestline.operators.joins import spread_join
from crestline.plans.scratch import Scratch


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))


def _degrees(edges: DataFrame) -> DataFrame:
    """Degree and, for degrees up to two, the neighbours. One aggregation, combined before the shuffle: hubs are no matter."""
    return _both_ways(edges).groupBy("u").agg(F.count(F.lit(1)).alias("deg"), F.min("v").alias("lo"), F.max("v").alias("hi"))


def _strip_leaves(edges: DataFrame, cut: Scratch) -> tuple[DataFrame, DataFrame]:
    """(parents, edges left). Of an edge between two leaves the larger is taken for the leaf."""
    leaf = cut.cut(_degrees(edges).where("deg = 1").select("u", F.col("lo").alias("v")))
    la = leaf.select(F.col("u").alias("a"), F.col("v").alias("b"), F.lit(True).alias("leaf_a"))
    lb = leaf.select(F.col("v").alias("a"), F.col("u").alias("b"), F.lit(True).alias("leaf_b"))
    # joined on both ends: the edges of a hub spread over all tasks
    marked = cut.cut(edges.join(la, ["a", "b"], "left").join(lb, ["a", "b"], "left"))
    gone = marked.where("leaf_a or leaf_b").select(F.when(F.col("leaf_b"), F.col("b")).otherwise(F.col("a")).alias("child"), F.when(F.col("leaf_b"), F.col("a")).otherwise(F.col("b")).alias("parent"))
    return gone, marked.where("leaf_a is null and leaf_b is null").select("a", "b")


def _compress_chains(edges: DataFrame, cut: Scratch) -> tuple[DataFrame, DataFrame, int] | None:
    """(parents, edges left, vertices taken out): every maximal chain of degree-two vertices becomes one edge.

    List ranking by pointer jumping: an arc (t, h) out of a chain vertex t is followed by (h, h's other neighbour)
    until its head is no chain vertex; jumps double, so a chain of n vertices takes log2 n rounds. Rings of
    degree-two vertices alone never end and stay for the core. None: there is no chain.
    """
    mid = cut.cut(_degrees(edges).where("deg = 2").select("u", "lo", "hi"))
    if mid.isEmpty():
        return None
    arcs = mid.select(F.inline(F.array(F.struct(F.col("u").alias("t"), F.col("lo").alias("h")), F.struct(F.col("u").alias("t"), F.col("hi").alias("h")))))
    nxt = mid.select(F.col("u").alias("h"), "lo", "hi")
    other = F.when(F.col("lo") == F.col("t"), F.col("hi")).otherwise(F.col("lo"))
    state = cut.cut(arcs.join(nxt, "h", "left").select(
        "t", "h", F.when(F.col("lo").isNull(), F.col("t")).otherwise(F.col("h")).alias("pt"), F.when(F.col("lo").isNull(), F.col("h")).otherwise(other).alias("ph"),
        F.col("lo").isNull().alias("done"), F.when(F.col("lo").isNull(), 0).otherwise(1).cast("long").alias("rank")))
    open_ = state.where("not done").count()
    while open_:
        ahead = state.select(F.col("t").alias("pt"), F.col("h").alias("ph"), F.col("pt").alias("qt"), F.col("ph").alias("qh"), F.col("done").alias("qdone"), F.col("rank").alias("qrank"))
        following = cut.cut(state.join(ahead, ["pt", "ph"]).select("t", "h", F.col("qt").alias("pt"), F.col("qh").alias("ph"), F.col("qdone").alias("done"), (F.col("rank") + F.col("qrank")).alias("rank")))
        cut.drop(state)
        state, before, open_ = following, open_, following.where("not done").count()
        if open_ == before:  # a chain always has arcs that end in this round: only rings are left
            break
    ends = state.where("done").groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.min("ph").alias("e1"), F.max("ph").alias("e2"), F.min("rank").alias("rank")).where("n = 2")
    ends = cut.cut(ends)
    taken = ends.count()
    if not taken:
        return None
    parents = ends.select(F.col("t").alias("child"), F.col("e1").alias("parent"))
    bridges = ends.where("e1 <> e2 and rank = 0").select(F.col("e1").alias("a"), F.col("e2").alias("b"))
    # the edges of a vertex of degree two are known by both ends, so those of a hub next to it spread over all tasks
    out = ends.select("t").join(mid.select(F.col("u").alias("t"), "lo", "hi"), "t").select("t", F.explode(F.array("lo", "hi")).alias("o"))
    out = out.select(F.least("t", "o").alias("a"), F.greatest("t", "o").alias("b")).distinct()
    rest = edges.join(out, ["a", "b"], "left_anti")
    return parents, cut.cut(rest.unionByName(bridges).distinct()), taken


def _stars(edges: DataFrame, cut: Scratch, hot: int | None) -> DataFrame:
    """(child, parent): large-star and small-star rounds until every vertex hangs on its group's least vertex. Neighbours of a hub don't gather."""
    def mark(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    # a: child, b: parent, b < a
    now = cut.cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = mark(now)
    while True:
        least = _both_ways(now).groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # the larger neighbours of a vertex are its rows as a parent
        up = now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        large = cut.cut(spread_join(up, least, ["u"], hot=hot).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = spread_join(large, least, ["a"], hot=hot).select(F.inline(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))).where("a <> b").distinct()
        before, now = now, cut.cut(small)
        cut.drop(before, large)
        marks = mark(now)
        if marks == seen:
            return now.select(F.col("a").alias("child"), F.col("b").alias("parent"))
        seen = marks


def link_groups(pairs: DataFrame, a: str, b: str, least_gain: float = 0.1, hot: int | None = None) -> DataFrame:
    """(vertex, group): for every vertex of a pair the least vertex linked to it, itself included.

    Pairs with a null end or two equal ends are left out; repeated and reversed pairs count once; extra columns
    are ignored; an empty table gives no row. Leaves are stripped and chains compressed in turns for as long as a
    turn takes at least ``least_gain`` of the edges; the rest is solved by star rounds and labels are handed back
    in reverse order. Links and labels stay distributed throughout, and no join brings more than ``hot`` rows of one vertex or
    group into a task: see ``spread_join``.
    """
    cut = Scratch(pairs.sparkSession, "link")
    x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
    edges = cut.cut(pairs.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct())
    first, removed = edges, []
    size = edges.count()
    while size:
        gone, left = _strip_leaves(edges, cut)
        removed.append(gone)
        chains = _compress_chains(left, cut)
        if chains:
            removed.append(chains[0])
            left = chains[1]
        n = left.count()
        gain, edges, size = 1 - n / size, left, n
        if gain < least_gain:
            break
    labels = _stars(edges, cut, hot) if size else edges.select(F.col("a").alias("child"), F.col("b").alias("parent")).limit(0)
    labels = labels.select(F.col("child").alias("vertex"), F.col("parent").alias("label"))
    for gone in reversed(removed):
        known = labels.select(F.col("vertex").alias("parent"), "label")
        labels = cut.cut(labels.unionByName(spread_join(cut.cut(gone), known, ["parent"], "left", hot).select(F.col("child").alias("vertex"), F.coalesce("label", "parent").alias("label"))))
    everyone = _both_ways(first).select(F.col("u").alias("vertex")).distinct()
    labels = cut.cut(everyone.join(labels, "vertex", "left").select("vertex", F.coalesce("label", "vertex").alias("label")))
    least = labels.groupBy("label").agg(F.min("vertex").alias("group"))
    return spread_join(labels, least, ["label"], hot=hot).select("vertex", "group")
