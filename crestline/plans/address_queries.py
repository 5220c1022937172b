"""Queries on addresses and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.scoring import url_rules
from crestline.functions.text import pattern_of
from crestline.functions.urls import icon_size_bonus, is_likely_logo, is_valid_image, normalize_url, sanitize_filename, url_extension, url_filename, url_host, url_path
from crestline.operators.candidates import distinct_domains, first_domains
from crestline.plans.session import table

FIRST = 30  # of the test mode


def _urls(spark, folder):
    return table(spark, folder, "extraction_results").select("logo_url").where("logo_url is not null").distinct()


def domains_distinct(spark, folder):
    return distinct_domains(table(spark, folder, "domains")).select("ord", "domain")


def domains_first(spark, folder):
    return first_domains(table(spark, folder, "domains"), FIRST).select("ord", "domain")


def url_parts(spark, folder):
    u = F.col("logo_url")
    return _urls(spark, folder).select("logo_url", url_path(u).alias("path"), url_host(u).alias("host"), url_filename(u).alias("filename"), url_extension(u).alias("ext"))


def url_validity(spark, folder):
    u = F.col("logo_url")
    return _urls(spark, folder).select("logo_url", is_valid_image(u).alias("valid"), is_likely_logo(u).alias("likely"))


def url_scores(spark, folder):
    rules = url_rules(F.col("logo_url"))
    total = sum(rules.values(), F.lit(0))
    return _urls(spark, folder).select("logo_url", *(c.alias(n) for n, c in rules.items()), total.alias("total"))


def file_names(spark, folder):
    rows = table(spark, folder, "domains").select("domain").where("domain is not null").distinct()
    return rows.select("domain", sanitize_filename(F.col("domain")).alias("name"))


def url_resolution(spark, folder):
    """Host-relative, protocol-relative and absolute forms of every address resolve to it again."""
    u = F.col("logo_url")
    forms = F.explode(F.array(u, F.regexp_replace(u, "^https:", ""), url_path(u), F.lit("data:image/png;base64,AA"), F.lit("  "))).alias("raw")
    rows = _urls(spark, folder).where(u.rlike("^https://")).select("logo_url", forms)
    return rows.select("logo_url", "raw", normalize_url(F.col("raw"), u).alias("url"))


def size_bonus(spark, folder):
    """Icon size bonus of sizes made of the numbers at hand."""
    sizes = table(spark, folder, "extraction_results").select("extraction_time_ms").distinct().select(F.concat_ws("x", "extraction_time_ms", F.lit("1")).alias("sizes"))
    return sizes.select("sizes", icon_size_bonus(F.col("sizes")).alias("bonus"))


QUERIES = {f.__name__: f for f in (domains_distinct, domains_first, url_parts, url_validity, url_scores, file_names, url_resolution, size_bonus)}


def any_token(text: str, tokens: list[str]) -> str:
    return f"regexp_matches({text}, '{pattern_of(tokens)}')"


_U = "u AS (SELECT DISTINCT logo_url, lower(logo_url) AS l, regexp_extract(lower(logo_url), '([^/]*)$', 1) AS f, lower(regexp_extract(logo_url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)) AS p FROM extraction_results WHERE logo_url IS NOT NULL)"
_EXT = "CASE " + " ".join(f"WHEN ends_with(p, '{e}') THEN '{e}'" for e in V.EXTENSIONS) + " WHEN contains(l, 'format=png') THEN '.png' WHEN contains(l, 'format=svg') THEN '.svg' ELSE '.png' END"
SCORES = {
    "L1": "CASE WHEN contains(l, 'logo') THEN 40 ELSE 0 END",
    "L4": "CASE WHEN ends_with(l, '.svg') OR contains(l, '/svg') THEN 20 WHEN ends_with(l, '.png') THEN 10 WHEN ends_with(l, '.jpg') OR ends_with(l, '.jpeg') THEN 5 ELSE 0 END",
    "L18": f"CASE WHEN {any_token('p', V.OTHER_LOGO_PATHS)} THEN -20 ELSE 0 END",
    "L19": "CASE WHEN contains(l, 'capital') AND contains(l, 'logo') THEN -15 ELSE 0 END",
    "L20": "CASE WHEN contains(l, 'icon') AND NOT contains(l, 'logo') THEN -10 ELSE 0 END",
    "L21": "CASE WHEN regexp_matches(l, 'social|facebook|twitter') THEN -40 ELSE 0 END",
    "L22": f"CASE WHEN {any_token('l', V.PLATFORMS)} THEN -60 ELSE 0 END",
    "L23": "CASE WHEN contains(l, 'flag') THEN -60 ELSE 0 END + CASE WHEN contains(l, 'favicon') THEN -15 ELSE 0 END",
    "L24": "CASE WHEN contains(f, 'footer') THEN -25 ELSE 0 END",
    "L27": f"CASE WHEN {any_token('p', V.CONTENT_DIRS)} AND NOT contains(p, 'logo') THEN -25 ELSE 0 END",
}
SQL = {
    "domains_distinct": "SELECT min(ord) AS ord, domain FROM domains WHERE domain IS NOT NULL GROUP BY domain",
    "domains_first": f"SELECT min(ord) AS ord, domain FROM domains WHERE domain IS NOT NULL GROUP BY domain ORDER BY 1 LIMIT {FIRST}",
    "url_parts": f"""WITH {_U} SELECT logo_url, regexp_extract(logo_url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path,
        lower(regexp_extract(logo_url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^@/?#]*@)?([^:/?#]*)', 1)) AS host, f AS filename, {_EXT} AS ext FROM u""",
    "url_validity": f"""WITH {_U} SELECT logo_url, {any_token('l', V.LIKELY_LOGO)} AS likely, l <> '' AND NOT {any_token('f', V.REJECT_FILENAME)} AND NOT {any_token('l', V.REJECT_ADDRESS)}
        AND NOT (contains(f, 'flag') AND NOT contains(f, 'logo')) AND NOT {any_token('l', V.THIRD_PARTY)} AS valid FROM u""",
    "url_scores": f"WITH {_U} SELECT logo_url, {', '.join(f'{e} AS {n}' for n, e in SCORES.items())}, {' + '.join(f'({e})' for e in SCORES.values())} AS total FROM u",
    "file_names": r"SELECT DISTINCT domain, regexp_replace(domain, '[^\p{L}\p{M}\p{N}_\-.]', '_', 'g') AS name FROM domains WHERE domain IS NOT NULL",
    "url_resolution": f"""WITH {_U} SELECT logo_url, r.raw, CASE WHEN r.k < 3 THEN CASE WHEN r.k = 2 THEN regexp_extract(logo_url, '^(https://[^/?#]+)', 1) || r.raw ELSE logo_url END END AS url
        FROM u, LATERAL (VALUES (0, logo_url), (1, regexp_replace(logo_url, '^https:', '')), (2, regexp_extract(logo_url, '^https://[^/?#]*([^?#]*)', 1)), (3, 'data:image/png;base64,AA'), (4, '  ')) r(k, raw)
        WHERE regexp_matches(logo_url, '^https://')""",
    "size_bonus": "SELECT DISTINCT concat_ws('x', extraction_time_ms, '1') AS sizes, CASE WHEN extraction_time_ms IS NULL THEN 0 ELSE least(extraction_time_ms // 10, 30) END AS bonus FROM extraction_results",
}
