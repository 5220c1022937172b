"""Joins whose hot keys don't gather in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000  # rows of one key that a task may hold
MOST_KEYS = 10_000  # keys that are ever handed to every task


def heavy_keys_of(rows: DataFrame, keys: list[str], hot: int | None = None) -> DataFrame | None:
    """A local table of the keys that more than ``hot`` rows share, or None. Of n rows no more than n / hot keys can be heavy, and
    ``hot`` is raised to n / MOST_KEYS, so it never has more than MOST_KEYS rows. ``rows`` is read twice: cut it first."""
    hot = hot or HOT_ROWS
    n = rows.count()
    hot = max(hot, n // MOST_KEYS)
    if n <= hot:
        return None
    found = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > hot).select(*keys)
    held = found.collect()
    return rows.sparkSession.createDataFrame(held, found.schema) if held else None


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner", hot: int | None = None) -> DataFrame:
    """``rows`` joined with a table of one row per key. Rows of heavy keys stay where they are and meet a broadcast of those keys'
    rows (at most MOST_KEYS), the others are shuffled. Null keys match nothing. ``how``: inner or left; ``rows`` is read twice or more."""
    heavy = heavy_keys_of(rows.dropna(subset=keys), keys, hot)
    if heavy is None:
        return rows.join(table, keys, how)
    heavy = F.broadcast(heavy.withColumn("__hot", F.lit(True)))
    tagged = rows.join(heavy, keys, "left")
    heads = table.join(heavy.drop("__hot"), keys)
    cold = tagged.where("__hot is null").drop("__hot").join(table, keys, how)
    warm = tagged.where("__hot").drop("__hot").join(F.broadcast(heads), keys, how)
    return cold.unionByName(warm)


def blocked_pairs(entries: DataFrame, keys: list[str], row: list[str], joined: Callable[[DataFrame, DataFrame, list[str]], DataFrame], hot: int = 20_000) -> DataFrame:
    """``joined(left, right, keys)`` over all pairs of entries with equal keys, where a key of more than ``hot`` entries is cut into
    blocks by ``row`` and joined block by block, so that no task holds all its pairs. Every ordered pair meets once. ``entries`` is read several times."""
    hot = max(hot, entries.count() // MOST_KEYS)
    counts = entries.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > hot)
    found = counts.select(*keys, F.ceil(F.col("__rows") / hot).cast("int").alias("__blocks"))
    held = found.collect()  # at most MOST_KEYS rows
    if not held:
        return joined(entries, entries, keys)
    tagged = entries.join(F.broadcast(entries.sparkSession.createDataFrame(held, found.schema)), keys, "left")
    usual = tagged.where("__blocks is null").drop("__blocks")
    own = F.pmod(F.xxhash64(*row), F.col("__blocks").cast("long")).cast("int")
    warm = tagged.where("__blocks is not null").withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    left = warm.select(*entries.columns, F.col("__own").alias("__i"), F.col("__other").alias("__j"))
    right = warm.select(*entries.columns, F.col("__other").alias("__i"), F.col("__own").alias("__j"))
    return joined(usual, usual, keys).unionByName(joined(left, right, [*keys, "__i", "__j"]))
