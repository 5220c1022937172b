"""Cases whose results are known, on inline tables: what the stored tables have no example of. SQL works them out where it can, else lists what the rules demand."""

from __future__ import annotations

import struct

from pyspark.sql import functions as F

from crestline.functions.images import hash_images
from crestline.functions.regions import in_footer, in_header, in_logo_widget, in_nav, is_captcha_page, is_dealer_address, is_framework_icon, is_ui_icon
from crestline.functions.svg import data_uri_bytes, data_uri_valid, fix_current_color, render_ready, sanitize_svg, svg_data_uri, too_small
from crestline.functions.urls import alnum_fold, content_extension, image_source, is_home_link, srcset_first
from crestline.operators.candidates import wordpress_candidates
from crestline.operators.downloads import attempt_downloads, result_rows, valid_curl, valid_download
from crestline.operators.extraction import extract_candidates
from crestline.operators.rendered import rendered_backgrounds, rendered_json_ld, rendered_shapes, rendered_top, with_regions
from crestline.operators.strategies import manifest_icons
from crestline.plans.scratch import Scratch
from crestline.plans.session import table
from crestline.sources.sinks import write_files, write_results
from crestline.sources.tables import ATTEMPTS, LOGO_RESULT, fetch_plan, first_pages, read_domains, read_results

XMLNS = 'xmlns="http://www.w3.org/2000/svg"'
LONG = "m0 0h9" * 60


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    return str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"


def listed(columns: str, rows: list[tuple]) -> str:
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(_literal, r)) + ')' for r in rows)}) t({columns})"


# number, markup, made to stand alone, ready for a renderer, inline form
SVG_CASES = [
    (1, '<svg viewbox="0 0 90 90"><path d=""/></svg>', f'<svg {XMLNS} viewBox="0 0 90 90"><path d=""/></svg>', f'<svg {XMLNS} viewBox="0 0 90 90"><path d=""/></svg>', '<svg viewbox="0 0 90 90"><path d=""/></svg>'),
    (2, f'<svg {XMLNS} fill="currentColor"/>', f'<svg {XMLNS} fill="#000000"/>', f'<svg {XMLNS} fill="currentColor"/>', f'<svg {XMLNS} fill="#000000"/>'),
    (3, f'<svg {XMLNS} fill="currentColor"><g fill="red" stroke="CurrentColor"/></svg>', f'<svg {XMLNS} fill="currentColor"><g fill="red" stroke="#000000"/></svg>', f'<svg {XMLNS} fill="currentColor"><g fill="red" stroke="CurrentColor"/></svg>', f'<svg {XMLNS} fill="currentColor"><g fill="red" stroke="#000000"/></svg>'),
    (4, f"<svg {XMLNS} fill='#fff'><g fill=\"white\"/><g fill=\"none\"/></svg>", f"<svg {XMLNS} fill='#000000'><g fill=\"#000000\"/><g fill=\"none\"/></svg>", f"<svg {XMLNS} fill='#000000'><g fill=\"#000000\"/><g fill=\"none\"/></svg>", f"<svg {XMLNS} fill='#fff'><g fill=\"white\"/><g fill=\"none\"/></svg>"),
    (5, f'<svg {XMLNS} fill="#fff"><g fill="red"/></svg>', f'<svg {XMLNS} fill="#fff"><g fill="red"/></svg>', f'<svg {XMLNS} fill="#fff"><g fill="red"/></svg>', f'<svg {XMLNS} fill="#fff"><g fill="red"/></svg>'),
    (6, f'<svg {XMLNS} style="color:red;display: none"/>', f'<svg {XMLNS} />', f'<svg {XMLNS} style="color:red;display: none"/>', f'<svg {XMLNS} style="color:red;display: none"/>'),
    (7, f'<svg {XMLNS} style="display:block"/>', f'<svg {XMLNS} />', f'<svg {XMLNS}/>', f'<svg {XMLNS} style="display:block"/>'),
    (8, f'<svg {XMLNS}><style>.a{{fill:currentColor;stroke: currentcolor}}</style></svg>', f'<svg {XMLNS}><style>.a{{fill:#000000;stroke:#000000}}</style></svg>', f'<svg {XMLNS}><style>.a{{fill:currentColor;stroke: currentcolor}}</style></svg>', f'<svg {XMLNS}><style>.a{{fill:#000000;stroke:#000000}}</style></svg>'),
    (9, "no markup", "no markup", "no markup", "no markup"), (10, "", "", "", ""),
]
BOXES = [('<svg viewBox="0 0 10 10">', True), ('<svg viewBox="0 0 10 100">', False), ('<svg viewBox="0,0,10,10">', False), ('<svg width="10" height="19.5">', True), ('<svg width="20" height="10">', False),
         ('<SVG VIEWBOX=" 0 0 19 19.9">', True), ('<svg viewBox="-1 0 9 9">', False), ("<svg viewBox='0 0 5 5' width='90' height='90'>", True), ("<svg><g width='5' height='5'></svg>", False), ("", False)]


def svg_fixes(spark, folder):
    """P7-P10."""
    s = F.col("s")
    rows = spark.createDataFrame([c[:2] for c in SVG_CASES], "n int, s string")
    return rows.select("n", sanitize_svg(s).alias("alone"), render_ready(s).alias("ready"), fix_current_color(s).alias("inline"))


def svg_sizes(spark, folder):
    """F9."""
    return spark.createDataFrame(BOXES, "s string, e boolean").select("s", too_small(F.col("s")).alias("small"))


MARKUPS = [f"<svg>{'x' * n}é+%</svg>" for n in (0, 100, 384, 385, 386, 900)]


def data_uris(spark, folder):
    """400 bytes are enough."""
    uri = svg_data_uri(F.col("s"))
    return spark.createDataFrame([(m,) for m in MARKUPS], "s string").select("s", uri.alias("uri"), F.decode(data_uri_bytes(uri), "utf-8").alias("back"), data_uri_valid(uri).alias("valid"))


FILES = [(u, s, t, n, w, h) for u in ("https://a.test/l.ico", "https://a.test/l.png", "https://a.test/l.svg", "https://a.test/l?format=svg") for s, t in ((200, "image/png"), (200, "IMAGE/X-ICON"), (200, "image/svg+xml"), (200, "text/html"), (200, "text/plain"), (404, "image/jpeg"), (200, "image/webp"), (None, None))
         for n, w, h in ((199, 9, 9), (200, 9, 9), (499, 9, 9), (500, 801, 401), (500, 801, 400), (250_000, None, None), (250_001, 9, 9))]


def download_rules(spark, folder):
    """F14, F15, P16 over every combination of address, answer and size."""
    rows = spark.createDataFrame(FILES, "url string, status int, kind string, n int, w int, h int")
    u, s, k, w, h = (F.col(c) for c in ("url", "status", "kind", "w", "h"))
    content = F.encode(F.repeat(F.lit("x"), F.col("n")), "utf-8")
    return rows.select("url", "status", "kind", "n", "w", "h", valid_download(u, s, k, content, w, h).alias("http"), valid_curl(s, k, content).alias("curl"), *(content_extension(k, u, way).alias(f"ext_{way}") for way in ("http", "curl", "icon", "browser")))


PAGE = f"""<html><head><title>A</title><link rel="Shortcut ICON" href="/f.png" sizes="512x512"><link rel="apple-touch-icon" href="t.png"><link rel=icon href="/i.SVG"><link rel=image_src href=/s.png><link rel=stylesheet href=/c.css>
<meta property="og:image" content="/og-logo.png"><meta name="msapplication-TileImage" content="/tile.png"><meta name=keywords content=/k.png>
<script type="application/ld+json">[{{"logo": {{"contentUrl": "/ld.png"}}}}, {{"logo": "/haendler/l.png", "image": {{"url": "brand.png"}}}}, {{"image": "/photo.png"}}]</script><script type="application/ld+json">{{</script></head>
<body><div class="site-header"><a href="https://p.test/" class="brand" aria-label="go home"><svg viewBox="0 0 90 90">{LONG}</svg></a><a href="/"><svg></svg><img src="/in-link.png"></a><a href="#"><svg class="menu">{LONG}</svg></a>
<div style="background:url(/bg-brand.png)"></div></div><header><div class="logo"><svg viewBox="0 0 10 10">{LONG}</svg></div></header>
<nav><span id="brand"><svg>{LONG}{LONG}</svg></span></nav><div class="card-header"><a href="/"><img src="/card-logo.png"></a></div><footer><a href="/"><svg>{LONG}</svg></a></footer></body></html>"""
_B64 = "'data:image/svg+xml;base64,' || to_base64(encode({}))"


def page_strategies(spark, folder):
    """X1, X2, X4-X8 with F10: every kind of find on one page, none on a challenge page, a broken one and one that was not read."""
    rows = [("p.test", "https://p.test/d/", PAGE), ("q.test", "https://q.test/", "<title>Just a Moment...</title><link rel=icon href=/i.png>"), ("r.test", "https://r.test/", "x" * 100 + "DataDome<link rel=icon href=/i.png>"), ("s.test", "https://s.test/", "<link rel=icon href='/i.png'><a <"), ("t.test", "https://t.test/", None)]
    return extract_candidates(spark.createDataFrame(rows, "domain string, base_url string, html string")).where("strategy <> 'img_tag'").select("domain", "strategy", "url", "score")


PAGE_FINDS = [("p.test", "link_tag", "https://p.test/f.png", 70), ("p.test", "link_tag", "https://p.test/d/t.png", 60), ("p.test", "link_tag", "https://p.test/i.SVG", 65), ("p.test", "link_tag", "https://p.test/s.png", 35),
              ("p.test", "meta_tag", "https://p.test/og-logo.png", 65), ("p.test", "meta_tag", "https://p.test/tile.png", 35),
              ("p.test", "json_ld", "https://p.test/ld.png", 90), ("p.test", "json_ld", "https://p.test/haendler/l.png", 50), ("p.test", "json_ld", "https://p.test/d/brand.png", 70),
              ("p.test", "svg_fallback", "https://p.test/in-link.png", 75), ("p.test", "css_background", "https://p.test/bg-brand.png", 55), ("s.test", "link_tag", "https://s.test/i.png", 40)]

ATTRS = [({"src": "/a.png"}, "/a.png"), ({"src": "data:image/gif;base64,R0", "data-src": "/b.png"}, "/b.png"), ({"src": "about:blank", "data-original": "/c.png", "data-lazy": "/d.png"}, "/c.png"), ({"data-lazy": "/d.png", "srcset": "/e.png 2x"}, "/d.png"),
         ({"srcset": " /e.png 1x, /f.png 2x"}, "/e.png"), ({"src": "", "alt": "x"}, None), ({"src": "data:image/svg+xml,%3Csvg" + "x" * 200, "data-src": "/g.png"}, "data:image/svg+xml,%3Csvg" + "x" * 200), ({"src": "data:image/svg+xml,%3Csvg", "data-lazy-src": "/h.png"}, "/h.png")]


def image_attributes(spark, folder):
    """P5, P6."""
    rows = spark.createDataFrame([(k, a) for k, (a, _) in enumerate(ATTRS)], "n int, attrs map<string,string>")
    return rows.select("n", image_source(F.col("attrs")).alias("src"), srcset_first(F.col("attrs")["srcset"]).alias("first"))


NODE = "array<struct<tag:string,classes:array<string>,id:string,role:string>>"
# number, nodes from the nearest on, header, nav, footer, widget
REGIONS = [(1, [("div", ["Card-Header"], "", "")], False, False, False, False), (2, [("div", ["foo-header"], "", "")], True, False, False, False), (3, [("div", ["section__header"], "", "")], True, False, False, False), (4, [("body", ["site-header"], "", "")], False, False, False, False),
           (5, [("p", [], "", ""), ("header", [], "", "")], True, False, False, False), (6, [("div", [], "Masthead", "")], True, False, False, False), (7, [("div", [], "", "Banner")], True, False, False, False), (8, [("nav", [], "", "")], False, True, False, False),
           (9, [("ul", ["Nav-Menu"], "", "")], False, True, False, False), (10, [("ul", [], "", "navigation")], False, True, False, False), (11, [("div", ["my-footer-row"], "", "")], False, False, True, False), (12, [("footer", [], "main-nav", "")], False, True, True, False),
           (13, [("div", ["site-branding"], "", "")], False, False, False, True), (14, [], False, False, False, False), (15, [("div", ["panel_header"], "", "")], False, False, False, False)]


def page_regions(spark, folder):
    """F4-F6, F13."""
    rows = spark.createDataFrame([(k, n) for k, n, *_ in REGIONS], f"n int, a {NODE}")
    a = F.col("a")
    return rows.select("n", in_header(a).alias("header"), in_nav(a).alias("nav"), in_footer(a).alias("footer"), in_logo_widget(a).alias("widget"))


def rendered_regions(spark, folder):
    """B1: from the element itself on, tags in capitals, widgets anywhere in the class text."""
    rows = spark.createDataFrame([(k, [(t.upper(), c, i, r) for t, c, i, r in n]) for k, n, *_ in REGIONS] + [(16, [("IMG", ["x-site-logo-img"], "", ""), ("HEADER", [], "", "")]), (17, None)], f"n int, path {NODE}")
    return with_regions(rows).select("n", F.col("in_header").alias("header"), F.col("in_nav").alias("nav"), F.col("in_footer").alias("footer"), F.col("in_logo_widget").alias("widget"))


HINTS = [("Menu-icon", "https://a.test/Dealer-Logo.png", True, True, True, False), ("logo", "https://a.test/haendler.svg", False, True, False, False), ("loading", "https://a.test/filiale/x", True, True, False, False), ("fa-home", "https://a.test/Vue-Logo.png", True, False, False, True), (None, None, False, False, False, False), ("x", "https://a.test/vite.svg", False, False, False, True)]


def hint_rules(spark, folder):
    """F11-F13 in both forms: the rendered ones lack a hint and a word."""
    rows = spark.createDataFrame([(k, *h[:2]) for k, h in enumerate(HINTS)], "n int, cls string, url string")
    return rows.select("n", is_ui_icon(F.col("cls")).alias("icon"), is_ui_icon(F.col("cls"), rendered=True).alias("icon_rendered"), is_dealer_address(F.col("url")).alias("dealer"), is_dealer_address(F.col("url"), rendered=True).alias("dealer_rendered"), is_framework_icon(F.col("url")).alias("framework"))


TITLES = [("Just a moment...", "", True), ("My CAPTCHA", "", True), ("Shop", "<script src=//geo.Captcha-Delivery.com>", True), ("Shop", "x" * 5000 + "datadome", False), ("Shop", "x" * 4992 + "datadome", True), (None, "page", False), (None, None, False)]


def captcha_filter(spark, folder):
    """F10."""
    rows = spark.createDataFrame([(k, *t[:2]) for k, t in enumerate(TITLES)], "n int, title string, html string")
    return rows.select("n", is_captcha_page(F.col("title"), F.col("html")).alias("challenge"))


LINKS = [("/", True), ("#", True), ("", True), ("./", True), ("https://other.test", True), ("http://other.test//", True), ("https://other.test/a", False), ("https://base.test/shop", True), ("mailto:a@b", False), ("//x", False), (None, True)]


def home_links(spark, folder):
    """What counts as a link to the home page of https://base.test/shop/, and P15."""
    return spark.createDataFrame([(k, h) for k, (h, _) in enumerate(LINKS)], "n int, href string").select("n", is_home_link(F.col("href"), F.lit("https://base.test/shop/")).alias("home"), alnum_fold(F.col("href")).alias("fold"))


def rendered_parts(spark, folder):
    """The five best of drawings, backgrounds and scripts of a rendered page."""
    drawing = '<svg viewBox="0 0 90 90" fill="currentColor">' + "x" * 200 + "</svg>"
    shape = "page string, idx int, markup string, classes string, aria_hidden string, in_header boolean, in_nav boolean, logo_around boolean, link_href string, link_img string, color string, page_origin string"
    shapes = spark.createDataFrame([
        ("p", 1, drawing, "", "", True, False, True, None, None, "rgb(255, 0, 16)", "https://p.test"), ("p", 2, drawing, "icon", "", True, False, True, None, None, "", ""), ("p", 3, drawing, "", "", False, True, False, "https://p.test/", "https://p.test/i.png", "", "https://p.test"),
        ("p", 4, '<svg viewBox="0,0,9,9">' + "x" * 300, "", "", True, True, True, None, None, "", ""), ("p", 5, drawing, "", "true", True, True, True, None, None, "", ""), ("p", 6, drawing, "", "", False, False, True, "/", None, "", "")], shape)
    boxes = spark.createDataFrame([("p", 1, "DIV", "my-Logo", 'url("/b.png")', True), ("p", 2, "DIV", "x", 'url("/b.png")', True), ("p", 3, "DIV", "brand logo", "url(/c.svg)", True), ("p", 4, "FOOTER", "logo", "url(/c.svg)", True), ("p", 5, "DIV", "logo", "linear-gradient(red)", True), ("p", 6, "DIV", "logo", "url(/d.png)", False)],
                                  "page string, idx int, tag string, classes string, background string, in_header_or_nav boolean")
    scripts = spark.createDataFrame([("p", 1, '{"logo": "/filiale.png"}'), ("p", 2, '[{"logo": {"contentUrl": "/franchise.png"}}]'), ("p", 3, "{"), ("q", 1, '{"logo": {"url": ""}}')], "page string, idx int, text string")
    return rendered_top([rendered_shapes(shapes), rendered_backgrounds(boxes), rendered_json_ld(scripts)])


_RED = '<svg viewBox="0 0 90 90" fill="#ff0010">' + "x" * 200 + "</svg>"


def saved_results(spark, folder):
    """A spare that can be fetched replaces address, strategy and path; a favicon is the last resort."""
    top = spark.createDataFrame([("a.test", 1, "https://a.test/l.png", 120, "img_tag"), ("a.test", 2, "https://a.test/i.webp", 40, "link_tag"), ("b.test", 1, "https://b.test/l.svg", 90, "json_ld"), ("c.test", 1, "https://c.test/x.png", 50, "meta_tag"), ("e.test", 1, "https://e.test/x.png", 50, "meta_tag")], "domain string, rank int, url string, score int, strategy string")
    svg = b'<svg viewbox="0 0 90 90" fill="currentColor">' + b"x" * 600 + b"</svg>"
    files = spark.createDataFrame([("a.test", "https://a.test/l.png", 404, "image/png", bytes(900), 1, 1, "http"), ("a.test", "https://a.test/i.webp", 200, "image/webp", bytes(900), 1, 1, "http"), ("b.test", "https://b.test/l.svg", 403, "", svg, 0, 0, "http"), ("b.test", "https://b.test/l.svg", 200, "image/svg+xml", svg, 0, 0, "curl"), ("c.test", "https://c.test/x.png", 200, "text/html", bytes(900), 1, 1, "http")],
                                  "domain string, url string, http_status int, content_type string, content binary, width int, height int, via string")
    domains = spark.createDataFrame([(f"{d}.test",) for d in "abcde"], "domain string")
    saved = attempt_downloads(top, files)
    return result_rows(domains, top.where("rank = 1"), saved, spark.createDataFrame([("c.test", "c.test.png"), ("d.test", "d.test.ico")], "domain string, path string"))


_GOOGLE = "https://www.google.com/s2/favicons?domain={}&sz=128"
SAVED = [("a.test", "https://a.test/i.webp", "link_tag", "a.test.webp", None, 120), ("b.test", "https://b.test/l.svg", "json_ld", "b.test.svg", None, 90), ("c.test", _GOOGLE.format("c.test"), "google_favicon_fallback", "c.test.png", None, 50),
         ("d.test", _GOOGLE.format("d.test"), "google_favicon_fallback", "d.test.ico", None, 0), ("e.test", "https://e.test/x.png", "meta_tag", None, None, 50)]


def stored_contents(spark, folder):
    """K3 with P7: vector images stand alone when they are written, but for those that came by curl; nothing else is touched."""
    svg = '<svg viewbox="0 0 90 90" fill="currentColor">' + "x" * 600 + "</svg>"
    rows = [(f"{k}.test", f"https://{k}.test/l{e}", 200, t, svg.encode(), 0, 0, via) for k, (e, t, via) in enumerate([(".svg", "image/svg+xml", "http"), (".svg", "image/svg+xml", "curl"), (".png", "image/png", "http"), ("", "image/svg+xml", "http")])]
    files = spark.createDataFrame(rows, "domain string, url string, http_status int, content_type string, content binary, width int, height int, via string")
    top = files.select("domain", F.lit(1).alias("rank"), "url", F.lit(1).alias("score"), F.lit("x").alias("strategy"))
    return attempt_downloads(top, files).select("domain", "path", F.decode("content", "utf-8").alias("text"))


_RAW, _ALONE = '<svg viewbox="0 0 90 90" fill="currentColor">' + "x" * 600 + "</svg>", f'<svg {XMLNS} viewBox="0 0 90 90" fill="#000000">' + "x" * 600 + "</svg>"


def wordpress_media(spark, folder):
    """S9, S10."""
    roots = spark.createDataFrame([("a", '{"site_logo": 7, "site_icon_url": "https://a/i.png"}'), ("b", '{"site_logo": "7", "site_icon_url": "/i.png"}'), ("c", '{"site_logo": 0}'), ("d", "[1]"), ("e", '{"site_logo": 9}'), ("f", None)], "domain string, body string")
    media = spark.createDataFrame([("a", 7, '{"source_url": "https://a/l.png"}'), ("a", 8, '{"source_url": "https://a/x.png"}'), ("b", 7, '{"source_url": "https://b/l.png"}'), ("e", 9, '{"source_url": ""}'), ("e", 9, "broken")], "domain string, media_id int, body string")
    return wordpress_candidates(roots, media).select("domain", "strategy", "url")


def manifest_finds(spark, folder):
    """S4, X7."""
    rows = spark.createDataFrame([("p", "https://a.test/m/x.json", '{"icons": [{"src": "i.png", "sizes": "192x192"}, {"src": "/vue-logo.png"}, {"src": "/n.png", "sizes": "any"}, {"src": ""}]}'), ("q", "https://a.test/m", "broken"), ("r", "https://a.test/m", None)], "page string, manifest_url string, body string")
    return manifest_icons(rows).select("page", "url", "score")


def page_choice(spark, folder):
    """S3: the page of each domain out of its attempts."""
    long = "<" + "x" * 2001
    rows = [("a", 0, 0, 0, 500, None, None), ("a", 0, 0, 1, 403, long, "r"), ("a", 1, 0, 0, 200, "late", "l"), ("b", 0, 0, 0, 200, "", "e"), ("b", 0, 0, 1, 200, "skipped", "s"), ("b", 0, 1, 0, 200, "www", "w"), ("c", 0, 0, 0, 404, "short", "x"), ("d", 0, 0, 0, 500, long, "x"), ("d", 2, 1, 1, None, None, None)]
    return first_pages(spark.createDataFrame(rows, ATTEMPTS)).select("domain", "base_url", "http_status", F.length("html").alias("chars"))


def requests(spark, folder):
    """The requests for every domain of the input list; agents are three."""
    domains = table(spark, folder, "domains").select("domain").distinct()
    return fetch_plan(domains).select("domain", "attempt", "variant", "scheme", "url", F.col("agent").between(0, 2).alias("known"))


def domains_in_order(spark, folder):
    """The input list as it is read, with places that keep its order."""
    return read_domains(spark, f"{folder}/domains.parquet").select("domain", "ord")


def _round_trip(spark, folder, kind: str):
    results = table(spark, folder, "extraction_results").select(*(c.split()[0] for c in LOGO_RESULT.split(", ")))
    at = f"{Scratch(spark, 'trip').root}/results"
    write_results(results, at)
    return read_results(spark, f"{at}/json", lines=True) if kind == "json" else spark.read.schema(LOGO_RESULT).option("header", True).csv(f"{at}/csv")


def results_as_json(spark, folder):
    """Written as JSON and read again."""
    return _round_trip(spark, folder, "json")


def results_as_csv(spark, folder):
    """K2: written as CSV and read again; CSV does not tell an empty text from a missing one, so both come back as null."""
    return _round_trip(spark, folder, "csv")


def files_written(spark, folder):
    """Contents written and read again, by digest."""
    at = f"{Scratch(spark, 'files').root}/files"
    write_files(table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("name"), F.encode("text", "utf-8").alias("content")), at)
    return spark.read.parquet(at).select("name", F.md5("content").alias("digest"), F.octet_length("content").alias("bytes"))


# boxes (left, right, top, bottom, colour in the order of the image source) on white
DRAWINGS = {"drawn": [(10, 30, 8, 50, (200, 30, 20)), (34, 52, 12, 26, (10, 120, 40)), (22, 48, 38, 44, (60, 0, 160))], "other": [(14, 24, 20, 30, (0, 0, 200)), (30, 54, 34, 54, (90, 60, 0)), (40, 46, 10, 24, (0, 140, 140))]}


def _picture(kind: str) -> tuple[bytes, int, int, int]:
    """Bytes of 64 x 64 points, or of 6 x 6: a drawing, the first one in more light, an even one, or one that is too small."""
    side = 6 if kind == "tiny" else 64

    def dot(y: int, x: int) -> tuple[int, int, int]:
        if kind == "even":
            return 90, 90, 90 + (x + y) % 12
        color = next((c for a, b, t, u, c in DRAWINGS["other" if kind == "other" else "drawn"] if a <= x < b and t <= y < u), (255, 255, 255))
        return tuple(min(255, v + 8) for v in color) if kind == "brighter" else color

    return b"".join(struct.pack("3B", *dot(y, x)) for y in range(side) for x in range(side)), side, side, 3


def image_hashes(spark, folder):
    """Hashes from pixels. Small and even images have none; light hardly changes a hash, another drawing does."""
    kinds = ("drawn", "brighter", "other", "even", "tiny")
    hashed = Scratch(spark, "hashes").cut(hash_images(spark.createDataFrame([(k, *_picture(k)) for k in kinds], "path string, data binary, height int, width int, channels int")))
    # one row
    base = hashed.where("path = 'drawn'").select(F.col("p").alias("bp"), F.col("d").alias("bd"), F.col("a").alias("ba"))
    near = lambda c: (F.bit_count(F.col(c).bitwiseXOR(F.col(f"b{c}"))) <= 10).alias(f"near_{c}")
    return hashed.join(F.broadcast(base)).select("path", F.col("p").isNotNull().alias("hashed"), near("p"), near("d"), near("a"))


QUERIES = {f.__name__: f for f in (
    svg_fixes, svg_sizes, data_uris, download_rules, page_strategies, image_attributes, page_regions, rendered_regions, hint_rules, captcha_filter, home_links, rendered_parts, saved_results, stored_contents, wordpress_media, manifest_finds, page_choice,
    requests, domains_in_order, results_as_json, results_as_csv, files_written, image_hashes)}

_FILES = listed("url, status, kind, n, w, h", FILES)
_TYPE = lambda pairs: " ".join(f"WHEN contains({{k}}, '{a}') THEN '{b}'" for a, b in pairs)
_BY_URL = "CASE WHEN ends_with(url, '.ico') THEN '.ico' WHEN ends_with(url, '.png') THEN '.png' WHEN ends_with(url, '.svg') OR contains(url, 'format=svg') THEN '.svg' END"
_HTTP = [("svg", ".svg"), ("png", ".png"), ("jpeg", ".jpg"), ("jpg", ".jpg"), ("gif", ".gif"), ("webp", ".webp"), ("ico", ".ico")]
SQL = {
    "svg_fixes": listed("n, alone, ready, inline", [(c[0], *c[2:]) for c in SVG_CASES]),
    "svg_sizes": listed("s, small", BOXES),
    "data_uris": f"SELECT s, {_B64.format('s')} AS uri, s AS back, octet_length(encode(s)) >= 400 AS valid FROM ({listed('s', [(m,) for m in MARKUPS])})",
    "download_rules": f"""SELECT *, coalesce(status = 200 AND n >= 200 AND NOT regexp_matches(coalesce(lower(kind), ''), 'text/html|text/plain') AND (n <= 250000 OR contains(coalesce(lower(kind), ''), 'svg'))
          AND (n >= 500 OR ends_with(url, '.ico')) AND (contains(coalesce(lower(kind), ''), 'svg') OR ends_with(url, '.svg') OR contains(url, 'format=svg') OR NOT coalesce(w > 800 AND h > 400, false)), false) AS http,
        coalesce(status = 200 AND n >= 200 AND n <= 250000 AND NOT contains(coalesce(kind, ''), 'text/html'), false) AS curl,
        CASE {_TYPE(_HTTP).format(k="coalesce(lower(kind), '')")} ELSE {_BY_URL} END AS ext_http, CASE {_TYPE([x for x in _HTTP if x[0] not in ('jpg', 'ico')]).format(k="coalesce(kind, '')")} ELSE {_BY_URL} END AS ext_curl,
        CASE {_TYPE([('png', '.png'), ('ico', '.ico'), ('svg', '.svg'), ('jpeg', '.jpg'), ('jpg', '.jpg')]).format(k="coalesce(lower(kind), '')")} ELSE '.png' END AS ext_icon,
        CASE {_TYPE([x for x in _HTTP if x[0] != 'png']).format(k="coalesce(lower(kind), '')")} ELSE '.png' END AS ext_browser FROM ({_FILES})""",
    # the link's own class makes it a logo container as well
    "page_strategies": listed("domain, strategy, url, score", PAGE_FINDS) + f" UNION ALL SELECT 'p.test', 'svg_fallback', {_B64.format(_literal(f'<svg viewBox=\"0 0 90 90\">{LONG}</svg>'))}, unnest([95, 85]) UNION ALL SELECT 'p.test', 'svg_fallback', {_B64.format(_literal(f'<svg>{LONG}{LONG}</svg>'))}, 85",
    "image_attributes": listed("n, src, first", [(k, s, "/e.png" if "srcset" in a else None) for k, (a, s) in enumerate(ATTRS)]),
    "page_regions": listed("n, header, nav, footer, widget", [(r[0], *r[2:]) for r in REGIONS]),
    "rendered_regions": listed("n, header, nav, footer, widget", [*((r[0], *r[2:]) for r in REGIONS), (16, True, False, False, True), (17, False, False, False, False)]),
    "hint_rules": listed("n, icon, icon_rendered, dealer, dealer_rendered, framework", [(k, h[2], h[2] and h[0] != "loading", h[3], h[3] and "filiale" not in h[1], h[5]) for k, h in enumerate(HINTS)]),
    "captcha_filter": listed("n, challenge", [(k, t[2]) for k, t in enumerate(TITLES)]),
    "home_links": f"SELECT n, home, regexp_replace(lower(href), '[^a-z0-9]', '', 'g') AS fold FROM ({listed('n, href, home', [(k, *x) for k, x in enumerate(LINKS)])})",
    "rendered_parts": f"""SELECT 'p' AS page, * FROM (VALUES (1, '/c.svg', 110, 'playwright_css_bg'), (2, '/b.png', 100, 'playwright_css_bg'), (3, {_B64.format(_literal(_RED))}, 95, 'playwright_inline_svg'),
        (4, '/filiale.png', 90, 'playwright_jsonld'), (5, 'https://p.test/i.png', 85, 'playwright_inline_svg')) t(rank, url, score, strategy)""",
    "saved_results": listed("domain, logo_url, source_strategy, downloaded_path, error, _best_score", SAVED),
    "stored_contents": listed("domain, path, text", [("0.test", "0.test.svg", _ALONE), ("1.test", "1.test.svg", _RAW), ("2.test", "2.test.png", _RAW), ("3.test", "3.test.svg", _ALONE)]),
    "wordpress_media": listed("domain, strategy, url", [("a", "wp_json_logo", "https://a/l.png"), ("a", "wp_json_icon", "https://a/i.png")]),
    "manifest_finds": listed("page, url, score", [("p", "https://a.test/m/i.png", 54), ("p", "https://a.test/n.png", 35)]),
    "page_choice": listed("domain, base_url, http_status, chars", [("a", "r", 403, 2002), ("b", "w", 200, 3), ("c", None, 404, None), ("d", None, 500, None)]),
    "requests": """WITH d AS (SELECT DISTINCT domain FROM domains WHERE domain IS NOT NULL), h AS (SELECT domain, 0 AS variant, domain AS host FROM d UNION ALL SELECT domain, 1, 'www.' || domain FROM d WHERE NOT starts_with(domain, 'www.'))
        SELECT domain, a.attempt, variant, s.scheme, s.way || '://' || host AS url, true AS known FROM h, (VALUES (0), (1), (2)) a(attempt), (VALUES (0, 'https'), (1, 'http')) s(scheme, way)""",
    "domains_in_order": "SELECT domain, file_row_number AS ord FROM (SELECT domain, row_number() OVER () - 1 AS file_row_number FROM domains)",
    "results_as_json": f"SELECT {', '.join(c.split()[0] for c in LOGO_RESULT.split(', '))} FROM extraction_results",
    "results_as_csv": "SELECT " + ", ".join(f"nullif({c.split()[0]}, '') AS {c.split()[0]}" if c.endswith("string") else c for c in (x.replace(" int", "") for x in LOGO_RESULT.split(", "))) + " FROM extraction_results",
    "files_written": "SELECT CAST(doc_id AS VARCHAR) AS name, md5(text) AS digest, octet_length(encode(text)) AS bytes FROM documents",
    "image_hashes": listed("path, hashed, near_p, near_d, near_a", [("drawn", True, True, True, True), ("brighter", True, True, True, True), ("other", True, False, False, False), ("even", False, None, None, None), ("tiny", False, None, None, None)]),
}
