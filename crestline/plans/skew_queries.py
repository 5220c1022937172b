"""Queries of problem 1 and their SQL."""

from __future__ import annotations

from crestline.operators.skew import heavy_keys, key_percentiles, key_profile
from crestline.plans.session import table

HOT_SHARE = 0.01


def p1_found(spark, folder):
    """Addresses that hold more than 1 % of all records as stored."""
    rows = table(spark, folder, "extraction_results")
    profile = key_profile(rows, "logo_url", distinct={"domains": "domain"})
    return heavy_keys(profile, "logo_url", HOT_SHARE, rows).select("logo_url")


def p1_address_profile(spark, folder):
    """Records, domains, files and most frequent strategy of every address."""
    return key_profile(
        table(spark, folder, "extraction_results"), "logo_url",
        distinct={"domains": "domain", "files": "downloaded_path"}, mode={"top_strategy": "source_strategy"},
    )


def p1_address_times(spark, folder):
    """Exact median and 95th percentile of the extraction time of every address."""
    return key_percentiles(table(spark, folder, "extraction_results"), "logo_url", "extraction_time_ms", [0.5, 0.95])


def p1_group_profile(spark, folder):
    """How many groups, over how many runs, have each size. Runs that were delivered twice count once."""
    from pyspark.sql import functions as F

    runs = table(spark, folder, "clustering_results").groupBy("run_id").agg(F.min_by("groups", "finished_at").alias("groups"))
    groups = runs.select("run_id", F.explode("groups").alias("g")).select("run_id", F.col("g.count").alias("group_size"))
    return key_profile(groups, "group_size", distinct={"runs": "run_id"})


QUERIES = {"p1_found": p1_found, "p1_address_profile": p1_address_profile, "p1_address_times": p1_address_times, "p1_group_profile": p1_group_profile}

SQL = {
    "p1_found": "SELECT logo_url FROM extraction_results WHERE logo_url IS NOT NULL GROUP BY logo_url HAVING count(*) > 0.01 * (SELECT count(*) FROM extraction_results)",
    "p1_address_profile": """
        WITH m AS (SELECT logo_url, source_strategy, row_number() OVER (PARTITION BY logo_url ORDER BY count(*) DESC, source_strategy) AS r
                   FROM extraction_results WHERE source_strategy IS NOT NULL GROUP BY logo_url, source_strategy)
        SELECT e.logo_url, e.records, e.domains, e.files, m.source_strategy AS top_strategy
        FROM (SELECT logo_url, count(*) AS records, count(DISTINCT domain) AS domains, count(DISTINCT downloaded_path) AS files
              FROM extraction_results GROUP BY logo_url) e
        LEFT JOIN m ON m.logo_url IS NOT DISTINCT FROM e.logo_url AND m.r = 1""",
    "p1_address_times": """
        WITH w AS (SELECT logo_url, extraction_time_ms AS v, row_number() OVER (PARTITION BY logo_url ORDER BY extraction_time_ms) AS r,
                          count(*) OVER (PARTITION BY logo_url) AS n FROM extraction_results WHERE extraction_time_ms IS NOT NULL)
        SELECT logo_url, s.share, CAST(v AS BIGINT) AS percentile FROM w, (VALUES (0.5::DOUBLE), (0.95::DOUBLE)) s(share)
        WHERE r = greatest(ceil(s.share * n), 1)""",
    "p1_group_profile": """
        SELECT g.count AS group_size, count(*) AS records, count(DISTINCT run_id) AS runs
        FROM (SELECT run_id, unnest(groups) AS g FROM (SELECT DISTINCT ON (run_id) run_id, groups FROM clustering_results ORDER BY run_id)) GROUP BY g.count""",
}
