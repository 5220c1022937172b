from pyspark.sql import functions as F

from crestline.functions import urls as U
from crestline.functions.svg import data_uri_bytes, data_uri_valid, fix_current_color, invert_white, render_ready, sanitize_svg, svg_data_uri, too_small


def one(spark, expr, **cols):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in cols.items()))
    return df.select(expr.alias("x")).first().x


def test_normalize(spark):
    base = "https://a.example/x/y.html"
    cases = {
        "/l.png": "https://a.example/l.png", "l.png": "https://a.example/x/l.png", "../l.png": "https://a.example/l.png", "//c.test/l.png": "https://c.test/l.png", "http://b.test/q": "http://b.test/q",
        "data:image/png;base64,AA": None, "data:image/svg+xml,<svg>": "data:image/svg+xml,<svg>", "  ": None, "": None, " /l.png\n": "https://a.example/l.png", "/a/../l.png": "https://a.example/l.png", "?q=1": "https://a.example/x/y.html?q=1"}
    df = spark.createDataFrame([(k, base) for k in cases] + [(None, base)], "u string, b string")
    got = {r.u: r.n for r in df.select("u", U.normalize_url(F.col("u"), F.col("b")).alias("n")).collect()}
    assert got == {**cases, None: None}


def test_extension_and_filename(spark):
    df = spark.createDataFrame([("https://a.test/L.SVG?x=1", ".svg"), ("https://a.test/l?format=svg", ".svg"), ("https://a.test/l.jpeg", ".jpeg"), ("https://a.test/l", ".png"), (None, ".png")], "u string, e string")
    assert all(r.x == r.e for r in df.select("e", U.url_extension(F.col("u")).alias("x")).collect())


def test_validity(spark):
    good = ["https://a.test/logo.png", "https://a.test/cart/logo.png", "https://a.test/flag-logo.png"]
    bad = ["", None, "https://a.test/cart.png", "https://a.test/flag.png", "https://x.onetrust.com/l.png", "https://a.test/flags/de.png", "https://a.test/b?p=spacer"]
    df = spark.createDataFrame([(u,) for u in good + bad], "u string")
    assert [r.v for r in df.select(U.is_valid_image(F.col("u")).alias("v")).collect()] == [True] * len(good) + [False] * len(bad)


def test_icon_bonus(spark):
    df = spark.createDataFrame([("180x180", 18), ("512x512", 30), ("any", 0), ("", 0), (None, 0), ("16x16 32x32", 1)], "s string, n int")
    assert all(r.x == r.n for r in df.select("n", U.icon_size_bonus(F.col("s")).alias("x")).collect())


def test_sanitize_and_agent(spark):
    assert one(spark, U.sanitize_filename(F.col("d")), d="a b/ü.de") == "a_b_ü.de"
    assert one(spark, U.user_agent_no(F.col("d")), d="a.test") in (0, 1, 2)


def test_image_source(spark):
    lazy = {"src": "data:image/gif;base64,R0", "data-lazy-src": "/l.png"}
    real = {"src": "data:image/svg+xml,%3Csvg" + "x" * 300, "data-src": "/l.png"}
    df = spark.createDataFrame([(lazy, "/l.png"), (real, real["src"]), ({"srcset": " /a.png 1x, /b.png 2x"}, "/a.png"), ({"data-original": "/o.png"}, "/o.png"), ({"src": "/s.png", "data-src": "/d.png"}, "/s.png"), ({}, None)], "a map<string,string>, e string")
    assert all(r.x == r.e for r in df.select("e", U.image_source(F.col("a")).alias("x")).collect())


def test_home_links(spark):
    df = spark.createDataFrame([("/", True), ("#", True), ("", True), ("./", True), ("https://o.test/", True), ("https://o.test", True), ("https://o.test/x", False), ("/x", False), ("//", True)], "h string, e boolean")
    assert all(r.x == r.e for r in df.select("e", U.is_home_link(F.col("h")).alias("x")).collect())


def test_svg_size(spark):
    cases = [('<svg viewBox="0 0 10 10">', True), ('<svg viewBox="0 0 10 100">', False), ('<svg viewBox="0,0,10,10">', False), ('<svg width="10" height="19.5">', True), ('<SVG VIEWBOX=\'0 0 5 5\'>', True), ("", False), (None, False)]
    df = spark.createDataFrame(cases, "s string, e boolean")
    assert all(r.x == r.e for r in df.select("e", too_small(F.col("s")).alias("x")).collect())


def test_svg_fixes(spark):
    white = '<svg fill="#fff"><path fill="white"/></svg>'
    assert one(spark, invert_white(F.col("s")), s=white) == '<svg fill="#000000"><path fill="#000000"/></svg>'
    assert one(spark, invert_white(F.col("s")), s='<svg fill="#fff"><p fill="red"/></svg>') == '<svg fill="#fff"><p fill="red"/></svg>'
    assert one(spark, fix_current_color(F.col("s")), s='<p fill="currentColor" stroke="currentcolor"/>') == '<p fill="#000000" stroke="#000000"/>'
    assert one(spark, fix_current_color(F.col("s")), s='<p fill="currentColor"/><q fill="red"/>') == '<p fill="currentColor"/><q fill="red"/>'
    out = one(spark, sanitize_svg(F.col("s")), s='<svg viewbox="0 0 9 9" style="display: none"><svg ></svg>')
    assert out == '<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 9 9" ><svg ></svg>'
    assert one(spark, render_ready(F.col("s")), s='<svg viewbox="0 0 9 9" style="display:block;x"/>') == '<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 9 9"/>'


def test_data_uris(spark):
    svg = '<svg viewBox="0 0 90 90">' + "x+%" * 150 + "</svg>"
    uri = one(spark, svg_data_uri(F.col("s")), s=svg)
    assert bytes(one(spark, data_uri_bytes(F.col("u")), u=uri)).decode() == svg
    assert one(spark, data_uri_valid(F.col("u")), u=uri) is True
    from urllib.parse import quote

    plain = "data:image/svg+xml," + quote(svg, safe="+")
    assert bytes(one(spark, data_uri_bytes(F.col("u")), u=plain)).decode() == svg
    df = spark.createDataFrame([("data:image/svg+xml;base64,AAAA", False), ("data:image/svg+xml", False), (None, False), ("data:image/svg+xml;base64,%%%", False)], "u string, e boolean")
    assert all(r.x == r.e for r in df.select("e", data_uri_valid(F.col("u")).alias("x")).collect())


def test_merged_like_the_standard_library(spark):
    """References of all kinds against bases of all kinds."""
    import random
    from urllib.parse import urljoin

    r = random.Random(3)
    bases = ["https://a.example/", "https://a.example", "https://a.example/x/y/z.html?q=1#f", "http://b.test/d/", "http://b.test/d;p/e;q?x", "", "https://a.example//x//y", "https://a.example/x/../y/./z", "mailto:a@b", "https://[::1]/x"]
    steps = ["", "a", "b.png", "..", ".", "c d", "x;y", "é", "...", "%2e"]
    refs = ["", "?q", "#f", "?", "#", ";p", "/", "//h/x", "mailto:x", "javascript:void(0)", "https:foo", "HTTPS://X.test/p", "a:b", "../..", "./", "../", "/../a", "/./a//b", "..;p", "x;y/z;w?q#f"]
    refs += [("/" if r.random() < 0.3 else "") + "/".join([r.choice(steps[1:]), *(r.choice(steps) for _ in range(r.randrange(5)))]) + r.choice(["", "?k=/../v", "#x/y", "?"]) for _ in range(150)]
    df = spark.createDataFrame([(u, b) for b in bases for u in refs], "u string, b string")
    got = {(x.u, x.b): x.m for x in df.select("u", "b", U.merge_url(F.col("u"), F.col("b")).alias("m")).collect()}
    assert {k: v for k, v in got.items()} == {(u, b): urljoin(b, u) for u, b in got}
    assert one(spark, U.merge_url(F.col("u"), F.lit("https://a.example/")), u=None) is None


def test_long_text_without_attributes(spark):
    """Read once, not once from every character."""
    assert one(spark, too_small(F.repeat(F.lit("x"), 500_000))) is False
    assert len(one(spark, sanitize_svg(F.concat(F.lit("<svg "), F.repeat(F.lit("a="), 200_000))))) > 400_000
