"""Both scores in full, over contexts made of every record by its number, against the rules in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.scoring import image_rules, rendered_score
from crestline.functions.text import pattern_of
from crestline.plans.address_queries import SCORES
from crestline.plans.session import table

# what the attributes around an image may be; record n takes the value at n * step, cyclically
ALT = ["", "logo", "Home", "BMW", "Acme Logo", " brand ", "cart", "A name of no less than thirty letters", "partner"]
CLASS = ["", "Logo", "nav-logo main", "dealer logo", "site-logo", "header_logo", "brand", "search icon", "navbar-brand", "custom-logo", "dealer header-logo"]
ID = ["", "logo", "nav_logo", "x", "brand-logo", "footer", "dealer-logo"]
PARENT = ["", "logo", "logo dealer", "home-logo", "sponsor-row", "branding-logo", "cart", "wrap", "Logo"]
GRAND = ["", "top-logo", "the-logo", "dealer-logo", "client list", "header"]
TAG = ["header", "nav", "div", "HEADER", ""]
HREF = ["", "/", "#", "./", "https://other.test/", "https://other.test", "https://other.test/a", "/karriere-x", "mailto:a@b", "/partner/x"]
CHOICES = {"alt": (ALT, 1), "class": (CLASS, 2), "id": (ID, 3), "parent_class": (PARENT, 5), "parent_id": (ID, 7), "grandparent_class": (GRAND, 11), "grandparent_id": (ID, 13), "grandparent_tag": (TAG, 17), "parent_href": (HREF, 19)}
FLAGS = {"is_in_header": 2, "is_in_footer": 3, "is_in_nav": 5}


def _pick(values: list[str], step: int):
    return F.element_at(F.array(*map(F.lit, values)), ((F.col("result_id") * step + F.floor(F.col("result_id") / 7)) % len(values) + 1).cast("int"))


def contexts(spark, folder):
    rows = table(spark, folder, "extraction_results").where("domain is not null and logo_url is not null").select("result_id", "domain", F.col("logo_url").alias("url")).distinct()
    flags = [(F.col("result_id") % k == 0).alias(n) for n, k in FLAGS.items()]
    return rows.select("result_id", "domain", "url", *(_pick(v, s).alias(n) for n, (v, s) in CHOICES.items()), *flags, (F.col("result_id") % 13).cast("int").alias("dom_position"))


def score_full(spark, folder):
    """Every rule of the static score."""
    c = contexts(spark, folder)
    rules = image_rules({n: F.col(n) for n in c.columns})
    return c.select("result_id", *(r.cast("int").alias(n) for n, r in rules.items()))


def browser_score(spark, folder):
    """The score of rendered images; null where one is no candidate."""
    c = contexts(spark, folder).withColumnsRenamed({"url": "src", "is_in_header": "in_header", "is_in_footer": "in_footer", "is_in_nav": "in_nav", "dom_position": "idx", "parent_href": "link_href"})
    n = F.col("result_id")
    c = c.withColumns({
        "in_logo_widget": n % 4 == 0, "top_px": (n % 400).cast("double"), "natural_w": (n % 900).cast("int"), "natural_h": (n % 450).cast("int"), "visible": n % 6 != 0,
        "page_origin": F.concat(F.lit("https://www."), "domain")})
    return c.select("result_id", rendered_score({k: F.col(k) for k in c.columns}).alias("score"))


QUERIES = {f.__name__: f for f in (score_full, browser_score)}


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _any(text: str, tokens: list[str]) -> str:
    return f"regexp_matches({text}, '{pattern_of(tokens)}')"


_CONTEXT = "c AS (SELECT result_id, domain, url, " + ", ".join(f"{_list(v)}[(result_id * {s} + result_id // 7) % {len(v)} + 1] AS {n}" for n, (v, s) in CHOICES.items()) + ", " + ", ".join(
    f"result_id % {k} = 0 AS {n}" for n, k in FLAGS.items()) + """, result_id % 13 AS dom_position
  FROM (SELECT DISTINCT result_id, domain, logo_url AS url FROM extraction_results WHERE domain IS NOT NULL AND logo_url IS NOT NULL)),
  d AS (SELECT *, lower(url) AS l, regexp_extract(lower(url), '([^/]*)$', 1) AS f, lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)) AS p, lower(alt) AS al, lower(class) AS cl, lower(id) AS i,
        lower(parent_class) AS pc, lower(parent_id) AS pi, lower(grandparent_class) AS gc, lower(grandparent_id) AS gi, lower(grandparent_tag) AS gt, trim(alt) AS brand FROM c)"""
_ALL = "concat_ws(' ', al, cl, i, pc, pi, gc, gi, p)"
_NEAR = "(" + " OR ".join(_any(x, V.NAV_LOGO) for x in ("cl", "i", "pc", "pi")) + ")"
_FAR = f"({_any('gc', V.NAV_LOGO)} OR {_any('gi', V.NAV_LOGO)})"
_TEXTS = ("cl", "i", "pc", "pi", "al")
_WORDS = " OR ".join(_any(t, ["brand", "site-logo", "site_logo", "header-logo", "header_logo", "navbar-brand", "custom-logo"]) for t in _TEXTS)
_SIGNAL = f"(contains(l, 'logo') OR {_NEAR} OR {_FAR} OR contains(pi || '|' || pc, 'logo') OR contains(gi || '|' || gc, 'logo') OR contains(cl || '|' || i, 'logo') OR contains(al, 'logo') OR {_WORDS})"
_HOME = "(parent_href IN ('/', './') OR regexp_matches(parent_href, '^https?://[^/?#]*/*([?#].*)?$'))"
_L10 = " + ".join(
    f"CASE WHEN contains({t}, 'brand') THEN 25 ELSE 0 END + CASE WHEN {_any(t, ['site-logo', 'site_logo'])} THEN 60 ELSE 0 END + CASE WHEN {_any(t, ['header-logo', 'header_logo'])} THEN CASE WHEN contains({t}, 'dealer') THEN 10 ELSE 55 END ELSE 0 END"
    f" + CASE WHEN contains({t}, 'navbar-brand') THEN 50 ELSE 0 END + CASE WHEN contains({t}, 'custom-logo') THEN 50 ELSE 0 END" for t in _TEXTS)
_FOLD = "regexp_replace(lower({}), '[^a-z0-9]', '', 'g')"
_RULES = SCORES | {
    "L2": f"CASE WHEN brand NOT IN ('logo', 'home', '') AND lower(brand) NOT IN ('logo', 'home') AND length(brand) < 30 AND {_FOLD.format('brand')} <> '' AND {_FOLD.format('domain')} <> '' AND NOT contains({_FOLD.format('domain')}, {_FOLD.format('brand')}) AND contains(l, 'logo') THEN -80 ELSE 0 END",
    "L3": f"CASE WHEN {_any('lower(parent_href)', V.CAREER_LINKS)} THEN -60 ELSE 0 END",
    "L5": f"CASE WHEN {_NEAR} THEN 100 WHEN {_FAR} THEN 80 ELSE 0 END",
    "L6": "CASE WHEN pi = 'logo' OR pc = 'logo' THEN 80 WHEN contains(pi, 'logo') OR contains(pc, 'logo') THEN CASE WHEN contains(pi, 'dealer') OR contains(pc, 'dealer') THEN 20 ELSE 50 END ELSE 0 END",
    "L7": "CASE WHEN contains(gi, 'logo') OR contains(gc, 'logo') THEN CASE WHEN contains(gi, 'dealer') OR contains(gc, 'dealer') THEN 15 ELSE 40 END ELSE 0 END",
    "L8": "CASE WHEN contains(cl, 'logo') OR contains(i, 'logo') THEN CASE WHEN contains(cl, 'nav') OR contains(i, 'nav') THEN 70 WHEN contains(cl, 'dealer') OR contains(i, 'dealer') THEN 15 ELSE 50 END ELSE 0 END",
    "L9": "CASE WHEN contains(al, 'logo') THEN 30 ELSE 0 END",
    "L10": _L10,
    "L11": "CASE WHEN is_in_header THEN 30 + CASE WHEN contains(pc, 'logo') OR contains(pi, 'logo') OR contains(gc, 'logo') THEN 40 ELSE 0 END ELSE 0 END",
    "L12": "CASE WHEN is_in_nav THEN 20 ELSE 0 END + CASE WHEN gt IN ('header', 'nav') THEN 25 ELSE 0 END",
    "L13": "CASE WHEN dom_position <= 3 THEN 20 WHEN dom_position <= 10 THEN 10 ELSE 0 END",
    "L14": "CASE WHEN is_in_footer THEN -20 ELSE 0 END",
    "L15": f"CASE WHEN {_any(_ALL, V.DEALER_WORDS)} THEN -20 ELSE 0 END",
    "L16": f"CASE WHEN {_any(_ALL, V.PARTNER_WORDS)} THEN -25 ELSE 0 END",
    "L17": f"CASE WHEN NOT {_SIGNAL} AND {_any(_ALL, V.UI_WORDS)} THEN -60 ELSE 0 END",
    "L25": f"CASE WHEN {_HOME} THEN 40 ELSE 0 END",
    "L26": f"CASE WHEN {_SIGNAL} OR {_HOME} THEN 0 ELSE -40 END",
}
_CTX = "concat_ws(' ', l, al, cl, i, pc, pi, gc, gi)"
_OWN = "concat_ws(' ', cl, i, pc, al)"
_SHOWN = "result_id % 6 <> 0"
_B2 = " + ".join([
    f"CASE WHEN contains({_CTX}, 'logo') THEN 50 ELSE 0 END", f"CASE WHEN contains({_CTX}, 'brand') THEN 30 ELSE 0 END",
    f"CASE WHEN regexp_matches({_CTX}, 'nav_logo|nav-logo|navigation-logo|navigation_logo') THEN 80 ELSE 0 END", f"CASE WHEN regexp_matches({_CTX}, 'home-logolink|home-logo|home_logo') THEN 80 ELSE 0 END",
    f"CASE WHEN regexp_matches({_CTX}, 'site-logo|site_logo') THEN 70 ELSE 0 END", f"CASE WHEN regexp_matches({_CTX}, 'header-logo|header_logo') THEN 60 ELSE 0 END",
    "CASE WHEN contains(cl, 'logo') OR contains(i, 'logo') THEN 40 ELSE 0 END", "CASE WHEN pc = 'logo' OR pi = 'logo' THEN 60 ELSE 0 END", "CASE WHEN is_in_header THEN 30 ELSE 0 END", "CASE WHEN is_in_nav THEN 20 ELSE 0 END",
    "CASE WHEN result_id % 400 < 200 THEN 25 ELSE 0 END", "CASE WHEN is_in_footer THEN -30 ELSE 0 END", "CASE WHEN trim(parent_href) IN ('/', './') OR trim(parent_href) IN (origin, origin || '/') THEN 40 ELSE 0 END",
    f"CASE WHEN contains({_CTX}, 'dealer') THEN -20 ELSE 0 END", f"CASE WHEN regexp_matches({_CTX}, 'partner|sponsor') THEN -25 ELSE 0 END", f"CASE WHEN contains({_CTX}, 'flag') THEN -60 ELSE 0 END",
    "CASE WHEN ends_with(url, '.svg') THEN 15 ELSE 0 END", "CASE WHEN dom_position < 5 THEN 10 ELSE 0 END", f"CASE WHEN {_SHOWN} THEN 0 ELSE -50 END",
    f"CASE WHEN result_id % 400 < 200 AND {_SHOWN} AND result_id % 900 > 30 AND result_id % 450 > 10 THEN 5 ELSE 0 END"])
_HOST = "lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^@/?#]*@)?([^:/?#]*)', 1))"
_ORIGIN = "replace(lower(regexp_extract(origin, '^https://(?:[^@/?#]*@)?([^:/?#]*)', 1)), 'www.', '')"
SQL = {
    "score_full": f"WITH {_CONTEXT} SELECT result_id, {', '.join(f'({e})::INT AS {n}' for n, e in _RULES.items())} FROM d",
    "browser_score": f"""WITH {_CONTEXT}, o AS (SELECT *, 'https://www.' || domain AS origin FROM d), e AS (SELECT *, {_B2} AS s0, {_HOST} AS h, {_ORIGIN} AS pg,
        url = '' OR starts_with(url, 'data:') AND NOT (starts_with(url, 'data:image/svg+xml') AND length(url) > 200) OR {_any('l', V.RENDERED_REJECT)} OR (contains(f, 'flag') AND NOT contains(f, 'logo'))
        OR ({_any(_OWN, V.RENDERED_UI)} AND NOT contains({_OWN}, 'logo')) AS bad FROM o),
  g AS (SELECT *, s0 + CASE WHEN result_id % 900 > 600 AND result_id % 450 > 300 AND s0 < 50 THEN -30 ELSE 0 END AS s1 FROM e),
  k AS (SELECT *, s1 + CASE WHEN result_id % 4 = 0 AND NOT is_in_header THEN 30 ELSE 0 END AS s2, h <> '' AND NOT contains(h, pg) AND NOT contains(pg, replace(h, 'www.', '')) AS abroad FROM g)
  SELECT result_id, CASE WHEN NOT bad AND NOT (abroad AND s1 < 50) AND (is_in_header OR is_in_nav OR result_id % 4 = 0) AND s2 > 10 THEN s2::INT END AS score FROM k""",
}
