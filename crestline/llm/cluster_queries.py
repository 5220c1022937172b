"""Queries of problem 3."""

from __future__ import annotations

from pyspark.sql import functions as F

from crestline.llm.spectral import similarity_clusters, similarity_subclusters, with_typical
from crestline.plans.session import table


def p3_found(spark, folder):
    """Members of every cluster of at least two rows of hashes."""
    return with_typical(similarity_clusters(table(spark, folder, "hashes"))).select("first_ord", "typical_ord", "ord")


def p3_clusters(spark, folder):
    """Size and most typical member of every cluster."""
    return similarity_clusters(table(spark, folder, "hashes")).groupBy("first_ord").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct("dist_sum", "ord")).getField("ord").alias("typical_ord"), F.min("dist_sum").alias("typical_dist_sum"))


def p3_subclusters(spark, folder):
    """Size and most typical member, by affinity to the others, of what the embedding tells apart in every linked group. SQL can't iterate it; tested on planted clusters."""
    top = F.min(F.struct((-F.col("affinity")).alias("less"), "ord")).getField("ord")
    return similarity_subclusters(table(spark, folder, "hashes")).groupBy("group_ord", "first_ord").agg(F.count(F.lit(1)).alias("members"), top.alias("typical_ord"))


QUERIES = {"p3_found": p3_found, "p3_clusters": p3_clusters, "p3_subclusters": p3_subclusters}

_CLUSTERS = """h AS (SELECT DISTINCT ord, p, d FROM hashes WHERE ord IS NOT NULL AND p IS NOT NULL AND d IS NOT NULL),
  e AS (SELECT x.ord AS a, y.ord AS b FROM h x JOIN h y ON x.ord <> y.ord
        WHERE bit_count(xor(x.p, y.p)) <= 10 OR (bit_count(xor(x.p, y.p)) <= 12 AND bit_count(xor(x.d, y.d)) <= 10)),
  r(v, x) AS (SELECT a, a FROM e UNION SELECT r.v, e.b FROM r JOIN e ON r.x = e.a),
  g AS (SELECT v AS ord, min(x) AS first_ord FROM r GROUP BY v),
  s AS (SELECT g.first_ord, g.ord, sum(bit_count(xor(hx.p, hy.p))) AS dist_sum
        FROM g JOIN g o ON g.first_ord = o.first_ord JOIN h hx ON hx.ord = g.ord JOIN h hy ON hy.ord = o.ord GROUP BY ALL),
  t AS (SELECT *, row_number() OVER (PARTITION BY first_ord ORDER BY dist_sum, ord) AS k, count(*) OVER (PARTITION BY first_ord) AS members FROM s)"""

SQL = {
    "p3_found": f"WITH RECURSIVE {_CLUSTERS} SELECT s.first_ord, t.ord AS typical_ord, s.ord FROM s JOIN t ON s.first_ord = t.first_ord AND t.k = 1",
    "p3_clusters": f"WITH RECURSIVE {_CLUSTERS} SELECT first_ord, members, ord AS typical_ord, CAST(dist_sum AS BIGINT) AS typical_dist_sum FROM t WHERE k = 1",
}
