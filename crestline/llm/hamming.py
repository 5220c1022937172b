"""Codes that differ in few bits, by pigeonring filtering.

A 64-bit code is cut into m equal segments in a ring, with budgets T_0..T_{m-1} that sum to tau - m + 1.
If two codes differ in at most tau bits, some segment i exists from which every chain of l segments
holds at most (T_i + ... + T_{i+l-1}) + l - 1 differences: the numbers b_j - T_j - 1 sum to a negative
value around the ring, so by the cycle lemma all their partial sums from some i are negative. The first
link of the chain (b_i <= T_i <= 2) is an equi-join on segments with at most one bit set or cleared on either
side; longer links prune the candidates before the whole codes are compared. No pair is lost.

Codes are rotated so that the chain starts at bit 0: the condition of the join stays a few instructions
long, whichever the segment, and is compiled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.operators.joins import MOST_KEYS, spread_join
from crestline.plans.scratch import Scratch

BITS = 64


def ring(tau: int) -> list[int]:
    """Budgets of the segments, as few as keep every budget at two or less; their number divides 64."""
    m = next(m for m in (1, 2, 4, 8, 16, 32) if tau - m + 1 <= 2 * m)
    total = max(0, tau - m + 1)
    return [total // m + (i < total % m) for i in range(m)]


def _low(code: Column, bits: int) -> Column:
    return code if bits >= BITS else code.bitwiseAND(F.lit((1 << bits) - 1))


def _rotated(code: Column, by: int) -> Column:
    return code if not by else F.shiftrightunsigned(code, by).bitwiseOR(F.shiftleft(code, BITS - by))


def _bit(i: int) -> int:
    return 1 << i if i < BITS - 1 else -(1 << (BITS - 1))


SINGLE = 100  # flip number of all set bits of a segment whose budget is one


def _flipped(seg: int, turned: Column, bits: int, budget: int) -> Column:
    """Entries of one segment: as it is (flip 0), with each 0 set (flip i + 1) and, if the budget is two, with each 1 cleared (flip -(i + 1)).

    A pair that differs in one bit meets where its 0 is set; in two bits, where both 0s are set or, if they stand on
    one side, where one is set there and the other's 1 is cleared.
    """
    low = _low(turned, bits)

    def entry(value: Column, flip: Column) -> Column:
        return F.struct(F.lit(seg).cast("byte").alias("seg"), value.alias("value"), flip.cast("byte").alias("flip"), turned.alias("turned"))

    plain = F.array(entry(low, F.lit(0)))
    if not budget:
        return plain
    masks = F.array(*(F.struct(F.lit(i + 1).alias("n"), F.lit(_bit(i)).cast("long").alias("mask")) for i in range(bits)))
    zero = lambda x: low.bitwiseAND(x["mask"]) == 0
    if budget == 1:
        return F.concat(plain, F.transform(F.filter(masks, zero), lambda x: entry(low.bitwiseOR(x["mask"]), F.lit(SINGLE))))
    return F.concat(plain, F.transform(masks, lambda x: entry(low.bitwiseXOR(x["mask"]), F.when(zero(x), x["n"]).otherwise(-x["n"]))))


def _entries(nodes: DataFrame, budgets: list[int]) -> DataFrame:
    width = BITS // len(budgets)
    per = [_flipped(s, _rotated(F.col("code"), s * width), width, t) for s, t in enumerate(budgets)]
    return nodes.select("payload", F.inline(F.concat(*per)))


def _hot_values(nodes: DataFrame, budgets: list[int], hot: int) -> DataFrame | None:
    """(seg, value, blocks) of join keys that more than ``hot`` entries share, from counts of the plain segments; a local table of at
    most MOST_KEYS rows, or None."""
    width = BITS // len(budgets)
    base = _entries(nodes, [0] * len(budgets)).groupBy("seg", "value").agg(F.count(F.lit(1)).alias("n"))
    spread = F.coalesce(*(
        F.when(F.col("seg") == s, F.array(*(F.col("value").bitwiseXOR(F.lit(_bit(f - 1) if f else 0).cast("long")) for f in range((width if t else 0) + 1)))) for s, t in enumerate(budgets)))
    near = base.select("seg", F.explode(spread).alias("value"), "n").groupBy("seg", "value").agg(F.sum("n").alias("n"))
    # a row has at most 17 entries a segment, so not more keys than entries / hot are hot
    hot = max(hot, nodes.count() * sum(width + 1 if t else 1 for t in budgets) // MOST_KEYS)
    found = near.where(F.col("n") > hot).select("seg", "value", F.ceil(F.col("n") / hot).cast("int").alias("blocks"))
    held = found.collect()
    return nodes.sparkSession.createDataFrame(held, found.schema) if held else None


def near_codes(nodes: DataFrame, tau: int, keep=None, hot: int = 20_000) -> DataFrame:
    """Unordered pairs of distinct rows (``code`` bigint, ``payload`` bigint) whose codes differ in at most ``tau`` bits.

    Columns code_a, payload_a, code_b, payload_b, dist, with (code, payload) of a smaller; a pair may come out once per
    segment. ``keep(payload_a, payload_b)`` may restrict the pairs. Rows must be distinct and without nulls. Keys shared by more
    than ``hot`` entries are cut into blocks that are joined block by block, so no task holds a hot key alone.
    """
    budgets = ring(tau)
    m = len(budgets)
    width = BITS // m
    # a row becomes up to 60 entries: its own number of tasks, which adaptive execution leaves as it is
    hot_keys = _hot_values(nodes, budgets, hot)
    nodes = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "code")
    entries = _entries(nodes, budgets)
    # budgets of chains of 2 .. m - 1 links, by the segment they start from
    chains = [[sum(budgets[(s + i) % m] for i in range(n)) + n - 1 for s in range(m)] for n in range(2, m)]

    def matched(x: DataFrame, y: DataFrame, keys: list[str]) -> DataFrame:
        a, c = x.where(F.col("flip") >= 0).alias("a"), y.where(F.col("flip") < SINGLE).alias("c")
        diff = F.col("a.turned").bitwiseXOR(F.col("c.turned"))
        fa, fc = F.col("a.flip"), F.col("c.flip")
        cond = reduce(lambda u, v: u & v, [F.col(f"a.{k}") == F.col(f"c.{k}") for k in keys])
        # where both flip or neither does, both orders of a pair meet; that is settled after the join, whose condition has to stay short
        cond = cond & ((fa > 0) | (fc == 0)) & ((fa != fc) | (fc == 0)) & ((fc >= 0) | (fa + fc < 0))
        for n, by_seg in enumerate(chains, 2):
            spare = F.lit(by_seg[0]) if len(set(by_seg)) == 1 else F.element_at(F.array(*map(F.lit, by_seg)), F.col("a.seg").cast("int") + 1)
            cond = cond & (F.bit_count(_low(diff, n * width)) <= spare)
        cond = cond & (F.bit_count(diff) <= tau)
        if keep is not None:
            cond = cond & keep(F.col("a.payload"), F.col("c.payload"))
        # a generator keeps what follows out of the join's condition
        hit = F.struct(F.col("a.seg").alias("seg"), F.col("a.turned").alias("ta"), F.col("a.payload").alias("pa"), F.col("c.turned").alias("tb"), F.col("c.payload").alias("pb"))
        found = a.join(c.hint("merge"), cond).select(F.inline(F.array(hit)))
        back = lambda t: F.coalesce(*(F.when(F.col("seg") == s, _rotated(F.col(t), BITS - s * width if s else 0)) for s in range(m)))
        found = found.select(F.struct(back("ta").alias("code"), F.col("pa").alias("payload")).alias("x"), F.struct(back("tb").alias("code"), F.col("pb").alias("payload")).alias("y"))
        found = found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x <> y")
        return found.select(*(F.col(f"{v}.{k}").alias(f"{k}_{n}") for n, v in (("a", "x"), ("b", "y")) for k in ("code", "payload")))

    if hot_keys is None:
        both = matched(entries, entries, ["seg", "value"])
    else:
        tagged = entries.join(F.broadcast(hot_keys), ["seg", "value"], "left")
        usual = tagged.where(F.col("blocks").isNull()).drop("blocks")
        warm = tagged.where(F.col("blocks").isNotNull()).withColumn("own", F.pmod(F.xxhash64("turned", "payload"), F.col("blocks").cast("long")).cast("int"))
        warm = warm.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        side = ["seg", "value", "flip", "turned", "payload"]
        left = warm.select(*side, F.col("own").alias("bi"), F.col("other").alias("bj"))
        right = warm.select(*side, F.col("other").alias("bi"), F.col("own").alias("bj"))
        both = matched(usual, usual, ["seg", "value"]).unionByName(matched(left, right, ["seg", "value", "bi", "bj"]))
    return both.withColumn("dist", F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))))


T1_P, T2_P, T2_D = 10, 12, 10  # fixed values of the gate: p <= 10, or p <= 12 and d <= 10


def usable(hashes: DataFrame) -> DataFrame:
    """Rows with an ord and both hashes, redelivered rows once."""
    return hashes.select("ord", "p", "d").dropna().distinct()


def gate_links(rows: DataFrame, cut: Scratch, t1: int = T1_P, t2: int = T2_P, t2d: int = T2_D, hot: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """The gate between different p: pairs of p values that pass by p alone (any d), and pairs of (p, d) values that pass only with d. Pairs may be repeated."""
    codes = cut.cut(rows.select(F.col("p").alias("code"), F.lit(0).cast("long").alias("payload")).distinct())
    by_p = near_codes(codes, t1, hot=hot)
    apart = lambda a, b: F.bit_count(a.bitwiseXOR(b)).between(t1 + 1, t2)
    by_d = near_codes(cut.cut(rows.select(F.col("d").alias("code"), F.col("p").alias("payload")).distinct()), t2d, keep=apart, hot=hot)
    return (
        by_p.select(F.col("code_a").alias("p_a"), F.col("code_b").alias("p_b"), F.col("dist").cast("long").alias("p_dist")),
        by_d.select(F.col("payload_a").alias("p_a"), F.col("code_a").alias("d_a"), F.col("payload_b").alias("p_b"), F.col("code_b").alias("d_b"), F.bit_count(F.col("payload_a").bitwiseXOR(F.col("payload_b"))).cast("long").alias("p_dist")),
    )


CHUNK = 500  # rows of one hash that are handled together


def _chunks(rows: DataFrame, keys: list[str], cut: Scratch, chunk: int) -> tuple[DataFrame, DataFrame]:
    """((keys, chunk, chunks, ords), (keys, chunks)): the rows of each hash in pieces of about ``chunk``, told by their ord."""
    counts = cut.cut(rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks")))
    own = spread_join(rows.select("ord", *keys), counts, keys)
    piece = F.pmod(F.xxhash64("ord"), F.col("chunks").cast("long")).cast("int").alias("chunk")
    return cut.cut(own.groupBy(*keys, piece, "chunks").agg(F.collect_list("ord").alias("ords"))), counts


def _expanded(links: DataFrame, keys: list[str], pieces: DataFrame, counts: DataFrame, cut: Scratch) -> DataFrame:
    """(x, y): all pairs of rows of linked hashes; a link of two hashes with many rows becomes many rows first, one per pair of pieces."""
    names = {"a": [f"{k}_a" for k in keys], "b": [f"{k}_b" for k in keys]}
    rows = links
    for s in "ab":
        table = counts.select(*(F.col(k).alias(f"{k}_{s}") for k in keys), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias(f"n_{s}"))
        # few pieces each, mostly one
        rows = rows.join(table, names[s])
    rows = cut.cut(rows)
    for s in "ab":
        table = pieces.select(*(F.col(k).alias(f"{k}_{s}") for k in keys), F.col("chunk").alias(f"n_{s}"), F.col("ords").alias(f"ords_{s}"))
        rows = cut.cut(spread_join(rows, table, [*names[s], f"n_{s}"]))
    return rows.select(F.explode("ords_a").alias("x"), "ords_b").select("x", F.explode("ords_b").alias("y"))


def similar_pairs(hashes: DataFrame, chunk: int = CHUNK, **gate) -> DataFrame:
    """(ord_a, ord_b), ord_a < ord_b: every pair of different rows that passes the gate, each once.

    Rows with a null ord, p or d are in no pair; redelivered rows count once; equal hashes are a pair. Extra columns are ignored; an
    empty table gives no row. The pairs of equal hashes are as many as the square of their rows: pieces of ``chunk`` rows meet, so no
    task makes more than chunk x chunk of them at a time. ``similar_classes`` has the same without any pair of copies.
    """
    cut = Scratch(hashes.sparkSession, "pairs")
    rows = cut.cut(usable(hashes))
    by_p, by_d = (cut.cut(x.drop("p_dist").distinct()) for x in gate_links(rows, cut, **gate))
    pieces, counts = _chunks(rows, ["p"], cut, chunk)
    met = pieces.select("p", F.col("chunk").alias("n_a"), F.col("ords").alias("ords_a"), F.explode(F.sequence(F.col("chunk"), F.col("chunks") - 1)).alias("chunk"))
    met = met.join(pieces.select("p", "chunk", "ords"), ["p", "chunk"])
    same = met.select("n_a", "chunk", F.explode("ords_a").alias("x"), "ords").select("n_a", "chunk", "x", F.explode("ords").alias("y")).where((F.col("n_a") < F.col("chunk")) | (F.col("x") < F.col("y"))).select("x", "y")
    wide = _expanded(by_p, ["p"], pieces, counts, cut)
    tight = _expanded(by_d, ["p", "d"], *_chunks(rows, ["p", "d"], cut, chunk), cut)
    both = same.unionByName(wide).unionByName(tight)
    return both.where("x <> y").select(F.least("x", "y").alias("ord_a"), F.greatest("x", "y").alias("ord_b"))


def similar_classes(hashes: DataFrame, **gate) -> DataFrame:
    """(ord, class_ord, copies, links): for every row with both hashes the first row with equal ones, how many share them, and the number of
    other rows that pass the gate with it. Linear in rows and in pairs of different hashes; redelivered rows count once."""
    cut = Scratch(hashes.sparkSession, "classes")
    rows = cut.cut(usable(hashes))
    by_p, by_d = (cut.cut(x.drop("p_dist").distinct()) for x in gate_links(rows, cut, **gate))
    classes = cut.cut(rows.groupBy("p", "d").agg(F.min("ord").alias("class_ord"), F.count(F.lit(1)).alias("copies")))
    of_p = cut.cut(classes.groupBy("p").agg(F.sum("copies").alias("n")))
    ways = by_p.select(F.inline(F.array(F.struct(F.col("p_a").alias("p"), F.col("p_b").alias("q")), F.struct(F.col("p_b").alias("p"), F.col("p_a").alias("q")))))
    near = ways.join(of_p.select(F.col("p").alias("q"), "n"), "q").groupBy("p").agg(F.sum("n").alias("near"))
    side = lambda x, y: F.struct(F.col(f"p_{x}").alias("p"), F.col(f"d_{x}").alias("d"), F.col(f"p_{y}").alias("q"), F.col(f"d_{y}").alias("e"))
    more = by_d.select(F.inline(F.array(side("a", "b"), side("b", "a"))))
    more = more.join(classes.select(F.col("p").alias("q"), F.col("d").alias("e"), "copies"), ["q", "e"]).groupBy("p", "d").agg(F.sum("copies").alias("more"))
    counted = cut.cut(classes.join(of_p, "p").join(near, "p", "left").join(more, ["p", "d"], "left").select(
        "p", "d", "class_ord", "copies", (F.col("n") - 1 + F.coalesce("near", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("links")))
    return spread_join(rows, counted, ["p", "d"]).select("ord", "class_ord", "copies", "links")
