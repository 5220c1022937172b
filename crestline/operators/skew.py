"""Per-key results when a few keys hold most rows, by value-frequency compression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def value_frequencies(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """(k, field, value, weight): how often each key holds each value of each field.

    Shuffled by key *and* value, so the rows of a hot key spread over all tasks, and counted
    before the shuffle, so equal rows travel once per task. A null value counts as a row of
    its field but not as a value (``value`` is null). Null keys form a group of their own.
    """
    taken = df.select(F.col(f"`{key}`").alias("k"), *(F.col(f"`{v}`").cast("string").alias(f"v{i}") for i, v in enumerate(values)))
    pairs = F.array(*(F.struct(F.lit(v).alias("field"), F.col(f"v{i}").alias("value")) for i, v in enumerate(values)))
    return taken.select("k", F.inline(pairs)).groupBy("k", "field", "value").agg(F.count(F.lit(1)).alias("weight"))


def key_profile(df: DataFrame, key: str, distinct: dict[str, str] | None = None, mode: dict[str, str] | None = None) -> DataFrame:
    """One row per key: ``records`` and, exactly, distinct counts and modes of other fields.

    ``distinct`` and ``mode`` map an output name to a field. Modes ignore nulls, ties go to the
    smallest value by bytes; a key without a value has mode null. An empty table gives no row.
    """
    distinct, mode = distinct or {}, mode or {}
    fields = list(dict.fromkeys([*distinct.values(), *mode.values()])) or [key]
    freq = value_frequencies(df, key, fields)
    first = fields[0]
    aggs = [F.sum(F.when(F.col("field") == first, F.col("weight"))).alias("records")]
    for name, f in distinct.items():
        aggs.append(F.count(F.when((F.col("field") == f) & F.col("value").isNotNull(), 1)).alias(name))
    for name, f in mode.items():
        held = (F.col("field") == f) & F.col("value").isNotNull()
        # max weight, then min value, as a single associative aggregate: least of (-weight, value)
        aggs.append(F.min(F.when(held, F.struct((-F.col("weight")).alias("w"), F.col("value").alias("v")))).getField("v").alias(name))
    # partial aggregation sends one row per key and task, however hot the key
    return freq.groupBy("k").agg(*aggs).withColumnRenamed("k", key)


def key_percentiles(df: DataFrame, key: str, value: str, shares: list[float], width: int = 1024) -> DataFrame:
    """Exact percentiles of an integral field per key: the smallest value whose cumulated weight reaches ``share`` of all.

    Values are compressed to (key, value, weight), cut into buckets of ``width``, and only the bucket
    that holds the wanted rank is opened: no task sorts all values of a hot key. Null values do not
    count; keys without values give no row. Columns: key, ``share``, ``percentile``.
    """
    freq = (
        df.where(F.col(f"`{value}`").isNotNull())
        .select(F.col(f"`{key}`").alias("k"), F.col(f"`{value}`").cast("long").alias("v"))
        .groupBy("k", "v").agg(F.count(F.lit(1)).alias("w"))
        .withColumn("b", F.floor(F.col("v") / width))
    )
    buckets = freq.groupBy("k", "b").agg(F.sum("w").alias("bw"))
    by_key = W.partitionBy("k").orderBy("b").rowsBetween(W.unboundedPreceding, W.currentRow)
    total = W.partitionBy("k")
    cum = buckets.select("k", "b", "bw", F.sum("bw").over(by_key).alias("upto"), F.sum("bw").over(total).alias("n"))
    wanted = (
        cum.withColumn("share", F.explode(F.array(*(F.lit(float(s)) for s in shares))))
        .withColumn("rank", F.greatest(F.ceil(F.col("share") * F.col("n")), F.lit(1)))
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("bw")))
        .select("k", "b", "share", (F.col("rank") - (F.col("upto") - F.col("bw"))).alias("rank"))
    )
    inside = W.partitionBy("k", "b", "share").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    opened = wanted.withColumnRenamed("k", "wk").withColumnRenamed("b", "wb")
    return (
        freq.join(opened, F.col("k").eqNullSafe(F.col("wk")) & (F.col("b") == F.col("wb")))
        .withColumn("upto", F.sum("w").over(inside))
        .where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("w") < F.col("rank")))
        .select(F.col("k").alias(key), "share", F.col("v").alias("percentile"))
    )


def heavy_keys(profile: DataFrame, key: str, share: float, rows: DataFrame | None = None) -> DataFrame:
    """Non-null keys that hold more than ``share`` of all records of a ``key_profile``. ``rows``: the table itself, whose rows are
    counted without making the profile a second time."""
    total = profile.agg(F.sum("records")).scalar() if rows is None else rows.agg(F.count(F.lit(1))).scalar()
    return profile.where(F.col(key).isNotNull() & (F.col("records") > total * share))
