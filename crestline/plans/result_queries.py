"""Queries on candidates and result rows. Each record of extraction_results stands for one candidate of its domain, in the order of delivery."""

from __future__ import annotations

from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.operators.candidates import best, best_per_address, ranked, source_candidates
from crestline.operators.clustering import is_ok
from crestline.operators.downloads import override, retry_class
from crestline.operators.extraction import extract_candidates
from crestline.operators.report import file_types, strategy_histogram, totals
from crestline.plans.address_queries import SCORES, any_token
from crestline.plans.session import table


def _results(spark, folder):
    return table(spark, folder, "extraction_results")


def _once(spark, folder):
    """Redelivered records once: they differ in ``loaded_at`` only."""
    return _results(spark, folder).drop("loaded_at").distinct()


def _candidates(spark, folder):
    rows = _once(spark, folder).where("domain is not null and logo_url <> ''")
    return rows.select("domain", F.col("logo_url").alias("url"), F.coalesce("_best_score", F.lit(0)).alias("score"), F.col("source_strategy").alias("strategy"), F.col("result_id").alias("pos"))


def candidate_dedup(spark, folder):
    return best_per_address(_candidates(spark, folder))


def candidate_best(spark, folder):
    return best(_candidates(spark, folder))


def candidate_top(spark, folder):
    return ranked(_candidates(spark, folder)).select("domain", "rank", "url", "score", "strategy")


def fallback_candidates(spark, folder):
    """Icons of search engines for domains by the rules of gating: records with a page stand for pages, icon records for probes."""
    rows = _once(spark, folder).where("domain is not null and logo_url <> ''")
    probes = rows.select("domain", F.col("source_strategy").alias("strategy"), F.col("logo_url").alias("url"), F.lit(1000).alias("bytes"))
    opened = rows.where("http_status = 200").select("domain").distinct()
    found = rows.where(F.col("source_strategy").isin("json_ld", "img_tag", "link_tag")).select("domain").distinct()
    return source_candidates(probes, opened, found).select("domain", "strategy", "url", "score").distinct()


def extraction_totals(spark, folder):
    """Of all records, each once however often it was delivered, as in all queries of this module."""
    return totals(_once(spark, folder))


def strategy_counts(spark, folder):
    return strategy_histogram(_once(spark, folder))


def file_type_counts(spark, folder):
    return file_types(_once(spark, folder))


def ok_and_failed(spark, folder):
    rows = _once(spark, folder)
    return rows.groupBy("domain").agg(F.count_if(is_ok(F.col("downloaded_path"), F.col("error"))).alias("ok"), F.count_if(~is_ok(F.col("downloaded_path"), F.col("error"))).alias("failed"))


def retry_routing(spark, folder):
    c = retry_class(*(F.col(x) for x in ("logo_url", "source_strategy", "downloaded_path", "error")))
    return _once(spark, folder).select("result_id", c.alias("retry")).where("retry is not null")


def override_merge(spark, folder):
    """The first record of each domain, replaced entirely by its last rendered one."""
    rows = _once(spark, folder).where("domain is not null").select("domain", "result_id", "logo_url", "source_strategy", "downloaded_path", "error")
    all_of = F.struct(*rows.columns[1:])
    first = rows.groupBy("domain").agg(F.min_by(all_of, "result_id").alias("r")).select("domain", "r.*")
    again = rows.where(F.col("source_strategy").startswith("playwright")).groupBy("domain").agg(F.max_by(all_of, "result_id").alias("r")).select("domain", "r.*")
    return override(first, again)


def synthetic_pages(spark, folder):
    """A page per domain out of its first record: an icon link, a share image and a header with the logo, linked to the home page."""
    rows = _once(spark, folder).where("domain is not null and logo_url <> ''").groupBy("domain").agg(F.min_by("logo_url", "result_id").alias("u"))
    html = F.concat(
        F.lit("<html><head><title>"), F.col("domain"), F.lit('</title><link rel="icon" href="'), F.col("u"), F.lit('"><meta property="og:image" content="'), F.col("u"),
        F.lit('"></head><body><div class="site-header"><a href="/"><p><img class="logo" src="'), F.col("u"), F.lit('"></a></div><footer><img src="/footer.png"></footer></body></html>'))
    return rows.select("domain", F.concat(F.lit("https://"), F.col("domain"), F.lit("/")).alias("base_url"), html.alias("html"), "u")


def page_candidates(spark, folder):
    """All candidates of the synthetic pages."""
    got = extract_candidates(synthetic_pages(spark, folder).drop("u"))
    return got.select("domain", "strategy", "url", "score")


def json_props(spark, folder):
    """Properties of events as variants: those that parse, with their number."""
    doc = F.try_parse_json("props")
    return table(spark, folder, "events").select("event_id", F.try_variant_get(doc, "$.k", "int").alias("k"), F.schema_of_variant(doc).startswith("OBJECT").alias("is_object"))


def weekly_strategies(spark, folder):
    """Records per strategy and week of extraction, each once."""
    week = F.unix_seconds(F.date_trunc("week", "extracted_at")).alias("week")
    return _once(spark, folder).groupBy(week, "source_strategy").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (
    json_props, weekly_strategies, candidate_dedup, candidate_best, candidate_top, fallback_candidates, extraction_totals, strategy_counts, file_type_counts, ok_and_failed, retry_routing, override_merge, page_candidates)}

# a record is told by its number; deliveries differ in their time of loading only
_EACH = "(SELECT DISTINCT ON (result_id) * FROM extraction_results ORDER BY result_id)"
_C = """o AS (SELECT DISTINCT * EXCLUDE (loaded_at) FROM extraction_results),
  c AS (SELECT domain, logo_url AS url, coalesce(_best_score, 0) AS score, source_strategy AS strategy, result_id AS pos FROM o WHERE domain IS NOT NULL AND logo_url <> ''),
  b AS (SELECT domain, url, score, strategy, first_pos FROM (SELECT *, min(pos) OVER (PARTITION BY domain, url) AS first_pos,
        row_number() OVER (PARTITION BY domain, url ORDER BY score DESC, pos) AS k FROM c) WHERE k = 1),
  r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY score DESC, first_pos) AS rank FROM b)"""
_THERE = lambda c: f"coalesce({c} <> '', false)"
_OK = f"({_THERE('downloaded_path')} AND coalesce(error, '') = '')"
_LIST = lambda tokens: ", ".join(f"'{t}'" for t in tokens)
_SOURCES = " ".join(f"WHEN '{k}' THEN {v}" for k, v in V.SOURCE_SCORES.items())
_CONTEXT = "concat_ws(' ', 'logo', p)"
# on the synthetic pages: own class logo, in a header, first image, linked to the home page
_IMG = f"""{' + '.join(f'({e})' for e in SCORES.values())} + 50 + 30 + 20 + 40
    - CASE WHEN {any_token(_CONTEXT, V.DEALER_WORDS)} THEN 20 ELSE 0 END - CASE WHEN {any_token(_CONTEXT, V.PARTNER_WORDS)} THEN 25 ELSE 0 END"""
SQL = {
    "json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, json_type(props) = 'OBJECT' AS is_object FROM events",
    "weekly_strategies": "SELECT CAST(epoch(date_trunc('week', extracted_at AT TIME ZONE 'UTC')) AS BIGINT) AS week, source_strategy, count(*) AS n FROM (SELECT DISTINCT * EXCLUDE (loaded_at) FROM extraction_results) GROUP BY 1, 2",
    "page_candidates": f"""WITH o AS (SELECT domain, arg_min(logo_url, result_id) AS url FROM extraction_results WHERE domain IS NOT NULL AND logo_url <> '' GROUP BY domain),
  u AS (SELECT domain, url, lower(url) AS l, regexp_extract(lower(url), '([^/]*)$', 1) AS f, lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)) AS p FROM o),
  v AS (SELECT * FROM u WHERE NOT {any_token('f', V.REJECT_FILENAME)} AND NOT {any_token('l', V.REJECT_ADDRESS)} AND NOT (contains(f, 'flag') AND NOT contains(f, 'logo')) AND NOT {any_token('l', V.THIRD_PARTY)})
  SELECT domain, 'link_tag' AS strategy, url, CASE WHEN ends_with(l, '.svg') THEN 65 ELSE 40 END AS score FROM v
  UNION ALL SELECT domain, 'meta_tag', url, 45 + CASE WHEN {any_token('l', V.LIKELY_LOGO)} THEN 20 ELSE 0 END - CASE WHEN {any_token('l', V.META_BRANDS)} THEN 60 ELSE 0 END FROM v
  UNION ALL SELECT domain, 'img_tag', url, {_IMG} FROM v WHERE {_IMG} > 0""",
    "candidate_dedup": f"WITH {_C} SELECT * FROM b",
    "candidate_best": f"WITH {_C} SELECT domain, url, score, strategy FROM r WHERE rank = 1",
    "candidate_top": f"WITH {_C} SELECT domain, rank, url, score, strategy FROM r WHERE rank <= {V.SPARES + 1}",
    "fallback_candidates": f"""WITH {_C},
  s AS (SELECT DISTINCT o.domain, source_strategy AS strategy, logo_url AS url, CASE source_strategy {_SOURCES} END AS score FROM o WHERE domain IS NOT NULL AND logo_url <> ''),
  p AS (SELECT DISTINCT domain FROM o WHERE domain IS NOT NULL AND logo_url <> '' AND http_status = 200),
  f AS (SELECT DISTINCT domain FROM o WHERE domain IS NOT NULL AND logo_url <> '' AND source_strategy IN ('json_ld', 'img_tag', 'link_tag')),
  u AS (SELECT * FROM s WHERE score IS NOT NULL AND strategy <> 'duckduckgo_icon' AND (NOT starts_with(strategy, 'wp_json') OR (domain NOT IN (SELECT domain FROM p) AND (strategy <> 'wp_json_icon' OR starts_with(url, 'http')))))
  SELECT * FROM u UNION ALL SELECT * FROM s WHERE strategy = 'duckduckgo_icon' AND domain NOT IN (SELECT domain FROM u) AND domain NOT IN (SELECT domain FROM f)""",
    "extraction_totals": f"""SELECT *, round(found * 100.0::DOUBLE / nullif(total, 0), 1) AS found_pct, round(downloaded * 100.0::DOUBLE / nullif(total, 0), 1) AS downloaded_pct FROM (
        SELECT count(*) AS total, count(*) FILTER ({_THERE('logo_url')}) AS found, count(*) FILTER ({_THERE('downloaded_path')}) AS downloaded, count(*) FILTER ({_THERE('error')}) AS errors FROM {_EACH})""",
    "strategy_counts": f"""SELECT source_strategy, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM {_EACH} WHERE logo_url <> ''), 1) AS pct
        FROM {_EACH} WHERE source_strategy <> '' GROUP BY 1""",
    "file_type_counts": "SELECT CASE " + " ".join(f"WHEN ends_with(lower(downloaded_path), '{e}') THEN '{'.jpg' if e == '.jpeg' else e}'" for e in V.EXTENSIONS) + f" ELSE 'other' END AS ext, count(*) AS n FROM {_EACH} WHERE downloaded_path <> '' GROUP BY 1",
    "ok_and_failed": f"SELECT domain, count(*) FILTER ({_OK}) AS ok, count(*) FILTER (NOT {_OK}) AS failed FROM {_EACH} GROUP BY domain",
    "retry_routing": f"""SELECT DISTINCT result_id, CASE WHEN {_THERE('error')} OR NOT {_THERE('logo_url')} THEN 'failed' ELSE 'weak' END AS retry FROM extraction_results
        WHERE {_THERE('error')} OR NOT {_THERE('logo_url')} OR ({_THERE('downloaded_path')} AND (ends_with(downloaded_path, '.ico') OR coalesce(source_strategy IN ({_LIST(V.WEAK_ALWAYS)}), false)))""",
    "override_merge": f"""WITH {_C},
  a AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY starts_with(coalesce(source_strategy, ''), 'playwright') DESC,
        CASE WHEN starts_with(coalesce(source_strategy, ''), 'playwright') THEN -result_id ELSE result_id END) AS k FROM o WHERE domain IS NOT NULL)
  SELECT domain, result_id, logo_url, source_strategy, downloaded_path, error FROM a WHERE k = 1""",
}
