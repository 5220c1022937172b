"""Connected components of an edge table (C1-C7): star rounds until nothing moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crestline.operators.joins import spread_join
from crestline.plans.scratch import Scratch


def star_edges(rows: DataFrame, key: str, node: str, order: str, hot: int | None = None) -> DataFrame:
    """(src, dst): every row of a key to the key's first row (J3, J4): as many edges as rows, whatever the key's size. Null keys link nothing.

    Of rows that tie for the first the least node counts. Keys of more than ``hot`` rows don't gather in a task.
    """
    cut = Scratch(rows.sparkSession, "stars")
    held = cut.cut(rows.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(node).alias("dst"), F.col(order).alias("o")))
    # a combining aggregate and a join instead of a window, which would sort a hot key in one task
    heads = held.groupBy("k").agg(F.min(F.struct("o", "dst")).getField("dst").alias("src"))
    return spread_join(held.select("k", "dst"), heads, ["k"], hot=hot).where("src <> dst").select("src", "dst").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", hot: int | None = None) -> DataFrame:
    """(node, component): the least node linked to each node of an edge. Null ends and loops are left out.

    Neighbours of a hub, or of the first node of a giant group, don't gather in a task: see ``spread_join``.
    """
    cut = Scratch(edges.sparkSession, "components")
    x, y = F.col(src), F.col(dst)
    links = edges.where(x.isNotNull() & y.isNotNull() & (x != y))
    now = cut.cut(links.select(F.greatest(x, y).alias("child"), F.least(x, y).alias("parent")).distinct())
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("child").alias("node"), F.col("parent").alias("component")).unionByName(now.select(F.col("parent").alias("node"), F.col("parent").alias("component")).distinct())
        state = seen
        # larger neighbours go to the least neighbour; a node's smaller ones are its rows as a child, its larger ones those as a parent
        ways = now.select(F.inline(F.array(F.struct("child", "parent"), F.struct(F.col("parent").alias("child"), F.col("child").alias("parent")))))
        least = ways.groupBy("child").agg(F.least(F.min("parent"), F.first("child")).alias("m"))
        up = now.select(F.col("parent").alias("child"), F.col("child").alias("far"))
        wide = spread_join(up, least, ["child"], hot=hot).select(F.col("far").alias("child"), F.col("m").alias("parent")).distinct()
        # smaller neighbours go there as well
        wide = cut.cut(wide)
        least = wide.groupBy("child").agg(F.min("parent").alias("m"))
        pairs = spread_join(wide, least, ["child"], hot=hot)
        small = pairs.select(F.inline(F.array(F.struct(F.col("parent").alias("child"), F.col("m").alias("parent")), F.struct("child", F.col("m").alias("parent")))))
        before, now = now, cut.cut(small.where("child <> parent").distinct())
        cut.drop(before, wide)


def label_nodes(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """(node, component) of all nodes; a node without an edge is its own component."""
    found = connected_components(edges).withColumnRenamed("node", "__n")
    return nodes.select(F.col(node).alias("node")).distinct().join(found, F.col("node") == F.col("__n"), "left").select("node", F.coalesce("component", "node").alias("component"))


def connected(labels: DataFrame, pairs: DataFrame, a: str = "a", b: str = "b", node: str = "node", hot: int | None = None) -> DataFrame:
    """C4: adds ``connected`` to pairs of nodes: whether both have one component. An end without a component is linked to itself only; null ends to nothing."""
    cut = Scratch(pairs.sparkSession, "connected")
    side = lambda c, n: labels.select(F.col(node).alias(c), F.col("component").alias(n))
    one = cut.cut(spread_join(cut.cut(pairs), side(a, "__ca"), [a], "left", hot))
    both = spread_join(one, side(b, "__cb"), [b], "left", hot)
    return both.withColumn("connected", F.coalesce(F.coalesce("__ca", a) == F.coalesce("__cb", b), F.lit(False))).drop("__ca", "__cb")
