from pyspark.sql import functions as F

from crestline.operators.candidates import best, best_per_address, ranked, source_candidates
from crestline.operators.dom import parse_elements
from crestline.operators.downloads import override, retry_class, valid_curl, valid_download
from crestline.operators.extraction import extract, extract_candidates
from crestline.operators.rendered import rendered_backgrounds, rendered_json_ld, rendered_shapes, rendered_top
from crestline.operators.strategies import manifest_icons
from crestline.sources.tables import ATTEMPTS, first_pages

BIG = "<path d='" + "m1 1 " * 60 + "'/>"
PAGE = f"""<html><head><title>Shop</title>
<LINK REL="shortcut icon" HREF="/fav.png" sizes="180x180"><link rel="apple-touch-icon" href="/touch.png"><link rel="icon" href="i.svg"><link rel="stylesheet" href="/a.css">
<meta property="og:image" content="/og-logo.png"><meta name="twitter:image" content="https://x.test/facebook.png"><meta name="description" content="/no.png">
<script type="application/ld+json">{{"@type": "Organization", "logo": {{"url": "/ld.png"}}, "image": "/img-brand.png"}}</script>
<script type="application/ld+json">[{{"logo": "/dealer-logo.png"}}, 3, {{"image": "/plain.png"}}]</script><script type="application/ld+json">broken {{</script></head>
<body><p>open <div class="site-header"><a href="/" class="Brand" aria-label="Home"><svg viewBox="0 0 90 90">{BIG}</svg></a>
<a href="https://a.example/"><svg></svg><img src="/beside.png"></a>
<div id="logo"><a href="/"><img src="data:image/gif;base64,R0" data-src="/main-logo.svg" alt="Logo"></a></div></div>
<nav class="main"><div class="logo-box"><svg viewBox="0 0 90 90">{BIG}{BIG}</svg><svg class="icon">{BIG}</svg></div><div style="background: url('/bg-logo.png')"></div></nav>
<img src="/outside-logo.png"><div style="background: url(/other-logo.png)"></div><ul><li><a href=/x>1<li><a href=/y>2</ul></body>"""


def test_parser_structure():
    rows = parse_elements(PAGE)
    imgs = [r for r in rows if r["tag"] == "img"]
    assert [r["img_no"] for r in imgs] == [0, 1, 2]
    assert [a["tag"] for a in imgs[1]["ancestors"]][:3] == ["a", "div", "div"]
    svg = next(r for r in rows if r["tag"] == "svg")
    assert svg["text"].startswith("<svg") and svg["text"].endswith("</svg>")
    links = [r for r in rows if r["tag"] == "a" and r["attrs"].get("href") in ("/x", "/y")]
    assert len(links) == 2 and [a["tag"] for a in links[1]["ancestors"]][:2] == ["li", "ul"]
    assert parse_elements("") == [] and parse_elements("<a <b") is not None


def test_all_strategies(spark):
    pages = spark.createDataFrame([("a.example", "https://a.example/d/x", PAGE), ("c.test", "https://c.test/", "<title>Just a moment...</title><link rel=icon href=/i.png>"), ("n.test", "https://n.test/", None)], "domain string, base_url string, html string")
    got = {(r.strategy, r.url if not r.url.startswith("data:") else "data", r.score) for r in extract_candidates(pages).collect()}
    want = {
        ("link_tag", "https://a.example/fav.png", 58), ("link_tag", "https://a.example/touch.png", 60), ("link_tag", "https://a.example/d/i.svg", 65),
        ("meta_tag", "https://a.example/og-logo.png", 65), ("meta_tag", "https://x.test/facebook.png", -20),
        ("json_ld", "https://a.example/ld.png", 90), ("json_ld", "https://a.example/img-brand.png", 70), ("json_ld", "https://a.example/dealer-logo.png", 50),
        ("svg_fallback", "data", 95), ("svg_fallback", "https://a.example/beside.png", 75), ("svg_fallback", "data", 85), ("css_background", "https://a.example/bg-logo.png", 55)}
    assert want <= got
    imgs = {u: s for k, u, s in got if k == "img_tag"}
    # L1 40, L4 20, L6 50 for the parent's id? the parent is the anchor, the box with id logo the grandparent: L7 40; L9 30, L11 30, L13 20, L25 40
    assert imgs["https://a.example/main-logo.svg"] == 40 + 20 + 40 + 30 + 30 + 20 + 40
    assert not any("outside" in u or "other" in u for _, u, _ in got)
    assert {k for k, _, _ in got} == {"link_tag", "meta_tag", "json_ld", "svg_fallback", "css_background", "img_tag"}


def test_dedup_rank_and_ties(spark):
    rows = [("d", "u1", 10, "a", 1), ("d", "u2", 30, "b", 2), ("d", "u1", 30, "c", 3), ("d", "u1", 30, "e", 4), ("e", "v", -5, "m", 1)] + [("f", f"w{i}", 5, "a", i) for i in range(9)]
    df = spark.createDataFrame(rows, "domain string, url string, score int, strategy string, pos long")
    dedup = {(r.domain, r.url): (r.score, r.strategy, r.first_pos) for r in best_per_address(df).collect()}
    assert dedup["d", "u1"] == (30, "c", 1) and dedup["e", "v"] == (-5, "m", 1)
    assert {r.domain: r.url for r in best(df).collect()} == {"d": "u1", "e": "v", "f": "w0"}
    assert ranked(df).where("domain = 'f'").count() == 7
    assert best(df.limit(0)).count() == 0


def test_source_gating(spark):
    probes = spark.createDataFrame([("a", "duckduckgo_icon", "u", 900), ("b", "duckduckgo_icon", "u", 900), ("a", "wp_json_logo", "u", 0), ("c", "wp_json_logo", "u", 0), ("c", "duckduckgo_icon", "u", 900), ("d", "clearbit", "u", 200), ("d", "wp_json_icon", "/rel", 0)], "domain string, strategy string, url string, bytes int")
    opened = spark.createDataFrame([("a",), ("b",)], "domain string")
    found = spark.createDataFrame([("b",)], "domain string")
    assert {(r.domain, r.strategy, r.score) for r in source_candidates(probes, opened, found).collect()} == {("a", "duckduckgo_icon", 20), ("c", "wp_json_logo", 90)}


def test_manifest(spark):
    df = spark.createDataFrame([("p", "https://a.test/m/manifest.json", '{"icons": [{"src": "i.png", "sizes": "192x192"}, {"src": "/vue-logo.png"}, {"src": "/n.png", "sizes": "any"}]}'), ("q", "https://a.test/m", "broken")], "page string, manifest_url string, body string")
    assert {(r.url, r.score) for r in manifest_icons(df).collect()} == {("https://a.test/m/i.png", 54), ("https://a.test/n.png", 35)}


def test_download_rules(spark):
    img = lambda n: b"x" * n
    cases = [("https://a/l.ico", "image/x-icon", img(199), 0, 0, False), ("https://a/l.ico", "image/x-icon", img(200), 0, 0, True), ("https://a/l.png", "image/png", img(499), 0, 0, False), ("https://a/l.png", "image/png", img(500), 0, 0, True),
             ("https://a/l.png", "image/png", img(900), 801, 401, False), ("https://a/l.png", "image/png", img(900), 801, 400, True), ("https://a/l.png", "text/html", img(900), 0, 0, False), ("https://a/l.png", "image/png", img(250_001), 0, 0, False),
             ("https://a/l.svg", "image/svg+xml", img(250_001), 0, 0, True), ("https://a/l.svg", "image/svg+xml", b'<svg viewBox="0 0 9 9">' + img(900), 0, 0, False), ("https://a/l.png", None, None, None, None, False)]
    df = spark.createDataFrame([(u, 200, t, c, w, h, e) for u, t, c, w, h, e in cases], "u string, s int, t string, c binary, w int, h int, e boolean")
    assert all(r.x == r.e for r in df.select("e", valid_download(*(F.col(k) for k in "ustcwh")).alias("x")).collect())
    assert df.where(valid_curl(F.col("s"), F.col("t"), F.col("c"))).count() == 6


def test_retry_and_override(spark):
    cases = [("u", "link_tag", "p.png", None, 1999, "weak"), ("u", "link_tag", "p.png", None, 2000, None), ("u", "img_tag", "p.ico", None, 9000, "weak"), ("u", "meta_tag", "p.png", None, 9000, "weak"), ("u", "img_tag", None, None, None, None),
             ("", "img_tag", None, None, None, "failed"), ("u", "img_tag", "p.png", "x", 9, "failed"), ("u", "meta_tag", None, None, None, None)]
    df = spark.createDataFrame(cases, "u string, s string, p string, e string, b int, x string")
    assert all(r.x == r.g for r in df.select("x", retry_class(*(F.col(k) for k in "uspeb")).alias("g")).collect())
    first = spark.createDataFrame([("a", "f1", 1), ("b", "f2", 2)], "domain string, downloaded_path string, n int")
    again = spark.createDataFrame([("a", None, 9)], "domain string, downloaded_path string, n int")
    assert {tuple(r) for r in override(first, again).collect()} == {("a", None, 9), ("b", "f2", 2)}
    assert {tuple(r) for r in override(first, again, keep_best=True).collect()} == {("a", "f1", 1), ("b", "f2", 2)}


def test_pipeline_rows(spark):
    pages = spark.createDataFrame([("a.test", "https://a.test/", '<header><a href="/"><img class="logo" src="/logo.png"></a></header><link rel=icon href=/i.png>'), ("b.test", "https://b.test/", "<p>nothing")], "domain string, base_url string, html string")
    files = spark.createDataFrame([("a.test", "https://a.test/logo.png", 404, "image/png", bytes(900), 1, 1, "http"), ("a.test", "https://a.test/i.png", 200, "image/webp", bytes(900), 1, 1, "http")], "domain string, url string, http_status int, content_type string, content binary, width int, height int, via string")
    domains = spark.createDataFrame([("a.test",), ("b.test",), ("c.test",)], "domain string")
    favs = spark.createDataFrame([("c.test", "c.test.png")], "domain string, path string")
    rows = {r.domain: r for r in extract(domains, pages, files, favicons=favs).collect()}
    assert (rows["a.test"].logo_url, rows["a.test"].downloaded_path, rows["a.test"].source_strategy, rows["a.test"].error) == ("https://a.test/i.png", "a.test.webp", "link_tag", None)
    assert rows["a.test"]._best_score > 100  # of the winner, not of the spare
    assert rows["b.test"].error == "no_logo_found" and rows["c.test"].source_strategy == "google_favicon_fallback"


def test_first_pages(spark):
    long = "<" + "x" * 2001
    rows = [("a", 0, 0, 0, 500, None, None), ("a", 0, 0, 1, 403, long, "r"), ("a", 1, 0, 0, 200, "late", "l"), ("b", 0, 0, 0, 200, "", "e"), ("b", 0, 0, 1, 200, "skipped", "s"), ("b", 0, 1, 0, 200, "www", "w"), ("c", 0, 0, 0, 404, "short", "x")]
    got = {r.domain: r for r in first_pages(spark.createDataFrame(rows, ATTEMPTS)).collect()}
    assert got["a"].base_url == "r" and got["b"].html == "www" and got["c"].html is None and got["c"].http_status == 404


def test_rendered_parts(spark):
    svg = '<svg viewBox="0 0 90 90" fill="currentColor">' + "x" * 200 + "</svg>"
    shapes = spark.createDataFrame([("p", 1, svg, "", "", True, False, True, None, None, "rgb(255, 0, 16)", "https://p.test"), ("p", 2, svg, "icon", "", True, False, True, None, None, "", ""), ("p", 3, svg, "", "", False, True, False, "/", "https://p.test/i.png", "", "https://p.test"), ("p", 4, '<svg viewBox="0,0,9,9">' + "x" * 300, "", "", True, True, True, None, None, "", "")],
                                   "page string, idx int, markup string, classes string, aria_hidden string, in_header boolean, in_nav boolean, logo_around boolean, link_href string, link_img string, color string, page_origin string")
    got = {r.idx: r for r in rendered_shapes(shapes).collect()}
    import base64

    assert set(got) == {1, 3} and 'fill="#ff0010"' in base64.b64decode(got[1].url.split(",")[1]).decode() and got[3].score == 85 and got[3].url.endswith("i.png")
    boxes = spark.createDataFrame([("p", 1, "DIV", "my-Logo", 'url("/b.png")', True), ("p", 2, "DIV", "x", 'url("/b.png")', True), ("p", 3, "DIV", "brand logo", "url(/c.svg)", True), ("p", 4, "FOOTER", "logo", "url(/c.svg)", True)], "page string, idx int, tag string, classes string, background string, in_header_or_nav boolean")
    back = rendered_backgrounds(boxes)
    assert {(r.idx, r.score) for r in back.collect()} == {(1, 100), (3, 110)}
    ld = rendered_json_ld(spark.createDataFrame([("p", 1, '{"logo": "/filiale.png"}'), ("p", 2, '[{"logo": {"contentUrl": "/franchise.png"}}]'), ("p", 3, "{")], "page string, idx int, text string"))
    assert {(r.url, r.score) for r in ld.collect()} == {("/filiale.png", 90), ("/franchise.png", 50)}
    top = rendered_top([back, ld, rendered_shapes(shapes)])
    assert [r.score for r in top.orderBy("rank").collect()] == [110, 100, 95, 90, 85]
