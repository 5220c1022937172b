"""Queries of problems 4 and 5."""

from __future__ import annotations

from pyspark.sql import functions as F

from crestline.llm.hamming import T1_P, T2_D, T2_P, similar_classes, similar_pairs
from crestline.llm.linking import link_groups
from crestline.plans.session import table


def matches(pairs):
    """Rows of match_pairs that are matches; a missing distance fails its part of the gate."""
    gate = (F.col("p_dist") <= T1_P) | ((F.col("p_dist") <= T2_P) & (F.col("d_dist") <= T2_D))
    by = F.col("via").isin("same_url", "same_file") | ((F.col("via") == "phash") & gate)
    return pairs.where(by & F.col("domain_a").isNotNull() & F.col("domain_b").isNotNull() & (F.col("domain_a") != F.col("domain_b")))


def p4_groups(spark, folder):
    """Every domain of a match with the group it belongs to."""
    return link_groups(matches(table(spark, folder, "match_pairs")), "domain_a", "domain_b").select(F.col("vertex").alias("domain"), F.col("group").alias("group_domain"))


def p4_found(spark, folder):
    """Smallest domain of each linked group with each other domain of it."""
    return p4_groups(spark, folder).where("group_domain <> domain").select("group_domain", "domain")


def p5_found(spark, folder):
    """Pairs of rows of hashes that pass the gate."""
    return similar_pairs(table(spark, folder, "hashes"))


def p5_classes(spark, folder):
    """Every row of hashes with its class of equal ones and the number of its links."""
    return similar_classes(table(spark, folder, "hashes"))


QUERIES = {"p4_found": p4_found, "p4_groups": p4_groups, "p5_found": p5_found, "p5_classes": p5_classes}

_MATCHES = """m AS (SELECT DISTINCT domain_a AS a, domain_b AS b FROM match_pairs WHERE domain_a IS NOT NULL AND domain_b IS NOT NULL AND domain_a <> domain_b
    AND (via IN ('same_url', 'same_file') OR (via = 'phash' AND (p_dist <= 10 OR (p_dist <= 12 AND d_dist <= 10))))),
  e AS (SELECT a, b FROM m UNION SELECT b, a FROM m),
  r(v, x) AS (SELECT a, a FROM e UNION SELECT r.v, e.b FROM r JOIN e ON r.x = e.a),
  g AS (SELECT v AS domain, min(x) AS group_domain FROM r GROUP BY v)"""

SQL = {
    "p4_found": f"WITH RECURSIVE {_MATCHES} SELECT group_domain, domain FROM g WHERE group_domain <> domain",
    "p4_groups": f"WITH RECURSIVE {_MATCHES} SELECT group_domain, domain FROM g",
    "p5_classes": """WITH h AS (SELECT DISTINCT ord, p, d FROM hashes WHERE ord IS NOT NULL AND p IS NOT NULL AND d IS NOT NULL),
        l AS (SELECT x.ord, count(*) AS links FROM h x JOIN h y ON x.ord <> y.ord
              WHERE bit_count(xor(x.p, y.p)) <= 10 OR (bit_count(xor(x.p, y.p)) <= 12 AND bit_count(xor(x.d, y.d)) <= 10) GROUP BY x.ord)
        SELECT h.ord, min(h.ord) OVER (PARTITION BY p, d) AS class_ord, count(*) OVER (PARTITION BY p, d) AS copies, coalesce(links, 0) AS links FROM h LEFT JOIN l USING (ord)""",
    "p5_found": """WITH h AS (SELECT DISTINCT ord, p, d FROM hashes WHERE ord IS NOT NULL AND p IS NOT NULL AND d IS NOT NULL)
        SELECT x.ord AS ord_a, y.ord AS ord_b FROM h x JOIN h y ON x.ord < y.ord
        WHERE bit_count(xor(x.p, y.p)) <= 10 OR (bit_count(xor(x.p, y.p)) <= 12 AND bit_count(xor(x.d, y.d)) <= 10)""",
}
