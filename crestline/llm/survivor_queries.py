"""Queries of problem 2."""

from __future__ import annotations

from pyspark.sql import functions as F

from crestline.llm.survivors import Bundle, consistent_survivors
from crestline.plans.session import table


def _inputs(spark, folder):
    groups = table(spark, folder, "clustering_results").select("run_id", F.explode("groups").alias("g")).where("g.count > 1")
    members = groups.select("run_id", F.col("g.group_id").alias("group_id"), F.explode("g.domains").alias("domain"))
    # one row per strategy
    trust = table(spark, folder, "strategy_trust").groupBy(F.col("strategy").alias("source_strategy")).agg(F.max("trust").alias("trust"))
    records = table(spark, folder, "extraction_results").join(trust, "source_strategy", "left")
    return members, records


def _file(tiers: list[int] | None = None, unknown: int | None = None) -> Bundle:
    return Bundle(
        "file", ["result_id", "domain", "source_strategy", "downloaded_path", "extracted_at", "logo_url"],
        trust=[F.coalesce("trust", F.lit(unknown)), F.unix_micros("extracted_at"), F.col("result_id")], tiers=tiers,
        usable=(F.col("downloaded_path") != "") & (F.coalesce(F.col("error"), F.lit("")) == ""),
    )


def _address() -> Bundle:
    """The address that a file of the domain was found at, with its score."""
    return Bundle(
        "address", ["logo_url", "_best_score"], trust=[F.col("_best_score"), F.col("result_id")],
        usable=F.col("logo_url") != "", determinants=["domain", "downloaded_path"],
    )


def _timing(tiers: list[int] | None = None, answered: int = 1) -> Bundle:
    """The newest complete timing of the same domain and address, one that was answered first."""
    return Bundle(
        "timing", ["http_status", "extraction_time_ms", "_best_score"], tiers=tiers,
        trust=[F.when(F.col("http_status") == 200, answered).otherwise(0), F.unix_micros("extracted_at"), F.col("result_id")],
        usable=F.col("http_status").isNotNull(), determinants=["domain", "logo_url"],
    )


def p2_found(spark, folder):
    """The surviving record of every group of several domains: its file decides, then its address and timing."""
    members, records = _inputs(spark, folder)
    return consistent_survivors(members, ["run_id", "group_id"], "domain", records, [_file(), _address(), _timing()]).select("run_id", "group_id", "result_id")


def p2_survivors(spark, folder):
    """The surviving record with its file, address and the newest complete timing of the same domain and address."""
    members, records = _inputs(spark, folder)
    return consistent_survivors(members, ["run_id", "group_id"], "domain", records, [_file(), _timing()]).withColumn("extracted_at", F.unix_micros("extracted_at"))


ANSWERED = 5  # steps of trust that an answered request is worth


def p2_bundles(spark, folder):
    """File and timing traded off: a less trusted file wins if its address was answered."""
    members, records = _inputs(spark, folder)
    bundles = [_file([0, 1, 2], 0), _timing([0, 3, 4], ANSWERED)]
    return consistent_survivors(members, ["run_id", "group_id"], "domain", records, bundles).select("run_id", "group_id", "result_id", "domain", "http_status", "extraction_time_ms")


QUERIES = {"p2_found": p2_found, "p2_survivors": p2_survivors, "p2_bundles": p2_bundles}

_TOP = """g AS (SELECT DISTINCT run_id, g.group_id AS group_id, unnest(g.domains) AS domain
        FROM (SELECT run_id, unnest(groups) AS g FROM clustering_results) WHERE g.count > 1),
  c AS (SELECT g.run_id, g.group_id, t.trust, e.*, row_number() OVER (PARTITION BY g.run_id, g.group_id
               ORDER BY t.trust DESC NULLS LAST, e.extracted_at DESC NULLS LAST, e.result_id DESC) AS k
        FROM g JOIN extraction_results e USING (domain) LEFT JOIN strategy_trust t ON t.strategy = e.source_strategy
        WHERE e.downloaded_path <> '' AND coalesce(e.error, '') = '')"""

SQL = {
    "p2_found": f"WITH {_TOP} SELECT run_id, group_id, result_id FROM c WHERE k = 1",
    "p2_survivors": f"""WITH {_TOP},
  x AS (SELECT domain, logo_url, http_status, extraction_time_ms, _best_score, row_number() OVER (PARTITION BY domain, logo_url
               ORDER BY (http_status = 200) DESC, extracted_at DESC NULLS LAST, result_id DESC) AS k
        FROM extraction_results WHERE http_status IS NOT NULL)
  SELECT c.run_id, c.group_id, c.result_id, c.domain, c.source_strategy, c.downloaded_path, epoch_us(c.extracted_at) AS extracted_at, c.logo_url, x.http_status, x.extraction_time_ms, x._best_score
  FROM c LEFT JOIN x ON x.k = 1 AND x.domain = c.domain AND x.logo_url IS NOT DISTINCT FROM c.logo_url WHERE c.k = 1""",
    "p2_bundles": f"""WITH {_TOP}, x AS (SELECT DISTINCT domain, logo_url, http_status, extraction_time_ms, extracted_at, result_id FROM extraction_results WHERE http_status IS NOT NULL),
  y AS (SELECT c.run_id, c.group_id, c.result_id, c.domain, x.http_status, x.extraction_time_ms, row_number() OVER (PARTITION BY c.run_id, c.group_id
        ORDER BY x.result_id IS NOT NULL DESC, coalesce(c.trust, 0) + CASE WHEN x.http_status = 200 THEN {ANSWERED} ELSE 0 END DESC, c.extracted_at DESC NULLS LAST, c.result_id DESC,
                 x.extracted_at DESC NULLS LAST, x.result_id DESC) AS j
        FROM c LEFT JOIN x ON x.domain = c.domain AND x.logo_url IS NOT DISTINCT FROM c.logo_url)
  SELECT run_id, group_id, result_id, domain, http_status, extraction_time_ms FROM y WHERE j = 1""",
}
