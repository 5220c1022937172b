"""Extraction report (G1-G3, G13, K6). Empty strings count as missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.functions import fixed_values as V


def there(c: Column) -> Column:
    return F.coalesce(c != "", F.lit(False))


def share(n: Column, of: Column) -> Column:
    """Percentage to one decimal; null of nothing."""
    return F.round(n * 100.0 / F.nullif(of, F.lit(0)), 1)


def totals(results: DataFrame) -> DataFrame:
    t = results.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(there(F.col("logo_url"))).alias("found"),
        F.count_if(there(F.col("downloaded_path"))).alias("downloaded"), F.count_if(there(F.col("error"))).alias("errors"))
    return t.select("*", share(F.col("found"), F.col("total")).alias("found_pct"), share(F.col("downloaded"), F.col("total")).alias("downloaded_pct"))


def strategy_histogram(results: DataFrame) -> DataFrame:
    """(source_strategy, n, pct of found), most frequent first."""
    found = results.agg(F.count_if(there(F.col("logo_url")))).scalar()
    counts = results.where(there(F.col("source_strategy"))).groupBy("source_strategy").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("source_strategy", "n", share(F.col("n"), found).alias("pct")).orderBy(F.desc("n"), "source_strategy")


def file_types(results: DataFrame) -> DataFrame:
    """(ext, n) of downloaded files; jpeg counts as jpg, unknown endings as 'other'."""
    path = F.lower("downloaded_path")
    ext = F
    for e in V.EXTENSIONS:
        ext = ext.when(path.endswith(e), ".jpg" if e == ".jpeg" else e)
    return results.where(there(F.col("downloaded_path"))).groupBy(ext.otherwise("other").alias("ext")).agg(F.count(F.lit(1)).alias("n"))
