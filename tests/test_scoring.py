"""The score against a plain restatement of its rules, on generated contexts and on the cases of the fixtures."""

import random
import re
from urllib.parse import urlsplit

from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.regions import is_site_header, is_site_nav
from crestline.functions.scoring import CONTEXT, RENDERED, image_rules, image_score, rendered_score

NAMES = [c.split()[0] for c in CONTEXT.replace("\n", " ").split(", ")]
BLANK = {"url": "", "alt": "", "class": "", "id": "", "parent_class": "", "parent_id": "", "grandparent_class": "", "grandparent_id": "", "grandparent_tag": "", "is_in_header": False, "is_in_footer": False, "is_in_nav": False, "dom_position": 99, "parent_href": "x", "domain": "a.test"}


def expected(c):
    """Rules by number, written from their description."""
    u, path, s = c["url"].lower(), urlsplit(c["url"]).path.lower(), {}
    alt, cls, i, pc, pi, gc, gi = (c[k].lower() for k in ("alt", "class", "id", "parent_class", "parent_id", "grandparent_class", "grandparent_id"))
    ctx = " ".join([alt, cls, i, pc, pi, gc, gi, path])
    hit = lambda text, words: any(w in text for w in words)
    logo = lambda *t: any("logo" in x for x in t)
    fold = lambda x: re.sub("[^a-z0-9]", "", x)
    s[1] = 40 * ("logo" in u)
    foreign = alt.strip() not in ("", "logo", "home") and len(alt.strip()) < 30 and fold(alt) and fold(c["domain"].lower()) and fold(alt) not in fold(c["domain"].lower())
    s[2] = -80 * bool(foreign and "logo" in u)
    s[3] = -60 * hit(c["parent_href"].lower(), V.CAREER_LINKS)
    s[4] = 20 if u.endswith(".svg") or "/svg" in u else 10 if u.endswith(".png") else 5 if u.endswith((".jpg", ".jpeg")) else 0
    near, far = hit(cls, V.NAV_LOGO) or hit(i, V.NAV_LOGO) or hit(pc, V.NAV_LOGO) or hit(pi, V.NAV_LOGO), hit(gc, V.NAV_LOGO) or hit(gi, V.NAV_LOGO)
    s[5] = 100 if near else 80 if far else 0
    s[6] = 80 if "logo" in (pc, pi) else (20 if "dealer" in pc or "dealer" in pi else 50) if logo(pc, pi) else 0
    s[7] = (15 if "dealer" in gc or "dealer" in gi else 40) if logo(gc, gi) else 0
    s[8] = (70 if "nav" in cls or "nav" in i else 15 if "dealer" in cls or "dealer" in i else 50) if logo(cls, i) else 0
    s[9] = 30 * ("logo" in alt)
    s[10], named = 0, False
    for t in (cls, i, pc, pi, alt):
        s[10] += 25 * ("brand" in t) + 60 * hit(t, ["site-logo", "site_logo"]) + 50 * ("navbar-brand" in t) + 50 * ("custom-logo" in t)
        s[10] += (10 if "dealer" in t else 55) * hit(t, ["header-logo", "header_logo"])
        named |= hit(t, ["brand", "site-logo", "site_logo", "header-logo", "header_logo", "custom-logo"])
    s[11] = (30 + 40 * logo(pc, pi, gc)) * c["is_in_header"]
    s[12] = 20 * c["is_in_nav"] + 25 * (c["grandparent_tag"] in ("header", "nav"))
    s[13] = 20 if c["dom_position"] <= 3 else 10 if c["dom_position"] <= 10 else 0
    s[14] = -20 * c["is_in_footer"]
    s[15], s[16] = -20 * hit(ctx, V.DEALER_WORDS), -25 * hit(ctx, V.PARTNER_WORDS)
    signal = bool(s[1] or near or far or s[6] or s[7] or s[8] or s[9] or named)
    s[17] = -60 * (not signal and hit(ctx, V.UI_WORDS))
    s[18] = -20 * hit(path, V.OTHER_LOGO_PATHS)
    s[19], s[20] = -15 * ("capital" in u and "logo" in u), -10 * ("icon" in u and "logo" not in u)
    s[21], s[22] = -40 * hit(u, ["social", "facebook", "twitter"]), -60 * hit(u, V.PLATFORMS)
    s[23] = -60 * ("flag" in u) - 15 * ("favicon" in u)
    s[24] = -25 * ("footer" in u.rsplit("/", 1)[-1])
    h = c["parent_href"]
    home = h in ("/", "./") or (h not in ("", "#") and urlsplit(h).scheme in ("http", "https") and urlsplit(h).path.rstrip("/") == "")
    s[25], s[26] = 40 * home, -40 * (not signal and not home)
    s[27] = -25 * (hit(path, V.CONTENT_DIRS) and "logo" not in path)
    return s


def contexts(n=400):
    r = random.Random(5)
    words = [*V.NAV_LOGO, *V.DEALER_WORDS, *V.PARTNER_WORDS, *V.UI_WORDS, "logo", "brand", "navbar-brand", "custom-logo", "x", "", "", "dealer header-logo", "nav", "Logo", "BMW"]
    paths = ["/logo.svg", "/media/a.png", "/logos/b.jpg", "/partner/c.jpeg", "/svg/x", "/favicon.ico", "/flag.png", "/a-footer.png", "/capital-logo.png", "/social/twitter.png", "/paypal-logo.png", "/icon.png", "/uploads/Logo.PNG"]
    hrefs = ["/", "./", "#", "", "/x", "https://o.test/", "https://o.test/a", "/career-x", "https://o.test"]
    for _ in range(n):
        w = lambda: r.choice(words)
        yield {**BLANK, "url": "https://" + r.choice(["a.test", "autohaus-x.test"]) + r.choice(paths) + r.choice(["", "", "?s=logo"]), "alt": w(), "class": w(), "id": w(), "parent_class": w(), "parent_id": w(),
               "grandparent_class": w(), "grandparent_id": w(), "grandparent_tag": r.choice(["header", "nav", "div", ""]), "is_in_header": r.random() < 0.5, "is_in_footer": r.random() < 0.3,
               "is_in_nav": r.random() < 0.5, "dom_position": r.randrange(14), "parent_href": r.choice(hrefs), "domain": r.choice(["a.test", "bmw.test", "adecco.test"])}


def test_every_rule_on_generated_contexts(spark):
    data = list(contexts())
    df = spark.createDataFrame([tuple(c[n] for n in NAMES) for c in data], CONTEXT)
    rules = image_rules({n: F.col(n) for n in NAMES})
    got = df.select(*(v.alias(k) for k, v in rules.items()), image_score({n: F.col(n) for n in NAMES}).alias("total")).collect()
    for c, row in zip(data, got):
        want = expected(c)
        assert {k: row[f"L{k}"] for k in want} == want, c
        assert row.total == sum(want.values())


def score(spark, **c):
    row = {**BLANK, **c}
    df = spark.createDataFrame([tuple(row[n] for n in NAMES)], CONTEXT)
    return df.select(*(v.alias(k) for k, v in image_rules({n: F.col(n) for n in NAMES}).items())).first()


def test_named_cases(spark):
    assert score(spark, alt="BMW", domain="adecco.de", url="https://adecco.de/BMW-Logo2.png").L2 == -80
    assert score(spark, alt="BMW", domain="bmw.de", url="https://adecco.de/BMW-Logo2.png").L2 == 0
    ui = score(spark, **{"class": "cart", "parent_href": "/"})
    assert (ui.L17, ui.L25, ui.L26) == (-60, 40, 0)
    assert [score(spark, dom_position=p).L13 for p in (3, 4, 10, 11)] == [20, 10, 10, 0]
    assert [score(spark, parent_href=h).L25 for h in ("/", "#", "", "https://other.com/")] == [40, 0, 0, 40]


def test_nulls_score_as_blank(spark):
    df = spark.createDataFrame([tuple(None for _ in NAMES)], CONTEXT)
    assert df.select(image_score({n: F.col(n) for n in NAMES}).alias("s")).first().s == -40


def test_regions(spark):
    cases = [("div", ["card-header"], "", "", False, False), ("div", ["foo-header"], "", "", True, False), ("div", ["section__header"], "", "", True, False), ("body", ["site-header"], "", "", False, False),
             ("header", [], "", "", True, False), ("div", [], "masthead", "", True, False), ("div", [], "", "BANNER", True, False), ("nav", [], "", "", False, True), ("div", ["Main-Nav"], "", "", False, True),
             ("div", None, None, None, False, False), ("div", ["page_header"], "", "", True, False), ("div", ["card_header"], "", "", False, False)]
    df = spark.createDataFrame([((t, c, i, r), h, n) for t, c, i, r, h, n in cases], "e struct<tag:string,classes:array<string>,id:string,role:string>, h boolean, n boolean")
    for row in df.select("e", "h", "n", is_site_header(F.col("e")).alias("gh"), is_site_nav(F.col("e")).alias("gn")).collect():
        assert (row.h, row.n) == (row.gh, row.gn), row.e


def test_rendered(spark):
    names = [c.split()[0] for c in RENDERED.replace("\n", " ").split(", ")]
    base = {"src": "https://a.test/logo.svg", "alt": "", "class": "", "id": "", "parent_class": "", "parent_id": "", "grandparent_class": "", "grandparent_id": "", "in_header": True, "in_nav": False, "in_footer": False,
            "in_logo_widget": False, "top_px": 10.0, "natural_w": 100, "natural_h": 40, "visible": True, "idx": 0, "link_href": "/", "page_origin": "https://www.a.test"}
    cases = [({}, 50 + 30 + 25 + 40 + 15 + 10 + 5), ({"in_header": False}, None), ({"src": "https://other.test/x.png", "link_href": None, "in_header": False, "in_nav": True, "top_px": 500.0}, None), ({"class": "cart", "src": "https://a.test/x.svg"}, None),
             ({"in_header": False, "in_logo_widget": True}, 50 + 25 + 40 + 15 + 10 + 5 + 30), ({"visible": False}, 50 + 30 + 25 + 40 + 15 + 10 - 50), ({"src": "data:image/png;base64,AA"}, None), ({"src": None}, None)]
    df = spark.createDataFrame([tuple({**base, **c}[n] for n in names) for c, _ in cases], RENDERED)
    got = [r.s for r in df.select(rendered_score({n: F.col(n) for n in names}).alias("s")).collect()]
    assert got == [e for _, e in cases]
