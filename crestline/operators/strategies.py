"""Extraction strategies (X1-X8): elements of pages to rows (page, idx, url, score). ``idx`` keeps the order within a strategy.

``elements`` comes from ``page_elements``; ``bases`` holds (page, base_url, domain), one row per page. No strategy fails on odd input:
what can't be read gives no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.regions import in_footer, in_header, in_logo_widget, in_nav, is_captcha_page, is_dealer_address, is_framework_icon, is_ui_icon
from crestline.functions.scoring import image_score
from crestline.functions.svg import fix_current_color, svg_data_uri, too_small
from crestline.functions.text import computed, has, has_any, low, points, text_or_empty
from crestline.functions.urls import icon_size_bonus, image_source, is_home_link, is_likely_logo, is_valid_image, normalize_url, strip

OUT = ["page", "idx", "url", "score"]


def _with_base(rows: DataFrame, bases: DataFrame) -> DataFrame:
    return rows.join(bases.select("page", "base_url", "domain"), "page")


def open_pages(pages: DataFrame, elements: DataFrame) -> DataFrame:
    """Pages that are no challenge pages (F10): the first title and the start of the page decide."""
    titles = elements.where("tag = 'title'").groupBy("page").agg(F.min_by("text", "node_id").alias("title"))
    joined = pages.join(titles, pages["domain"] == titles["page"], "left")
    return joined.where(F.col("html").isNotNull() & ~is_captcha_page(F.trim("title"), F.col("html"))).select(*pages.columns)


def link_tags(elements: DataFrame, bases: DataFrame) -> DataFrame:
    """X1."""
    rel = F.lower(F.array_join(F.split(strip(text_or_empty(F.col("attrs")["rel"])), r"\s+"), " "))
    rows = _with_base(elements.where((F.col("tag") == "link") & (text_or_empty(F.col("attrs")["href"]) != "")), bases)
    rows = computed(rows, url=normalize_url(F.col("attrs")["href"], F.col("base_url"))).where(is_valid_image(F.col("url")))
    icon = has(rel, "icon")
    score = (
        F.when(has(rel, "apple-touch-icon"), 60).when(icon & F.lower("url").endswith(".svg"), 65)
        .when(icon, 40 + icon_size_bonus(F.col("attrs")["sizes"])).when(has(rel, "image_src"), 35))
    return rows.select("page", F.col("node_id").alias("idx"), "url", score.alias("score")).where("score is not null")


def meta_tags(elements: DataFrame, bases: DataFrame) -> DataFrame:
    """X2."""
    a = F.col("attrs")
    prop = F.lower(F.coalesce(F.nullif(a["property"], F.lit("")), text_or_empty(a["name"])))
    base = reduce(lambda w, kv: w.when(prop == kv[0], kv[1]), V.META_SCORES.items(), F)
    rows = elements.where((F.col("tag") == "meta") & (text_or_empty(a["content"]) != "")).withColumn("base", base).where("base is not null")
    rows = computed(_with_base(rows, bases), url=normalize_url(a["content"], F.col("base_url"))).where(is_valid_image(F.col("url")))
    score = F.col("base") + points(is_likely_logo(F.col("url")), 20) + points(has_any(F.lower("url"), V.META_BRANDS), -60)
    return rows.select("page", F.col("node_id").alias("idx"), "url", score.alias("score"))


def image_contexts(elements: DataFrame, bases: DataFrame) -> DataFrame:
    """Images of headers, navigation and logo widgets with the context that the score reads; ``anchor`` is the address of the nearest anchor."""
    anc = F.col("ancestors")

    def at(i: int, f: str) -> Column:
        value = F.try_element_at(anc, F.lit(i))[f]
        return text_or_empty(F.array_join(value, " ") if f == "classes" else value)

    rows = computed(elements.where("tag = 'img'"), src=image_source(F.col("attrs")), hdr=in_header(anc), nav=in_nav(anc), widget=in_logo_widget(anc)).where("src is not null and (hdr or nav or widget)")
    rows = computed(_with_base(rows, bases), url=normalize_url(F.col("src"), F.col("base_url"))).where(is_valid_image(F.col("url")))
    return rows.select(
        "page", F.col("node_id").alias("idx"), "url", text_or_empty(F.col("attrs")["alt"]).alias("alt"), F.array_join("classes", " ").alias("class"), "id",
        at(1, "classes").alias("parent_class"), at(1, "id").alias("parent_id"), at(2, "classes").alias("grandparent_class"), at(2, "id").alias("grandparent_id"),
        at(2, "tag").alias("grandparent_tag"), (F.col("hdr") | F.col("widget")).alias("is_in_header"), in_footer(anc).alias("is_in_footer"), F.col("nav").alias("is_in_nav"),
        F.col("img_no").alias("dom_position"), F.col("anchor").alias("parent_href"), "domain")


def img_tags(elements: DataFrame, bases: DataFrame) -> DataFrame:
    """Images with a positive score. The address of the nearest anchor comes by an equi-join on its number."""
    anchors = elements.where("tag = 'a'").select("page", F.col("node_id").alias("a_id"), strip(text_or_empty(F.col("attrs")["href"])).alias("anchor"))
    images = elements.where("tag = 'img'").withColumn("a_id", F.filter("ancestors", lambda x: x["tag"] == "a"))
    images = images.withColumn("a_id", F.try_element_at("a_id", F.lit(1))["node_id"]).join(anchors, ["page", "a_id"], "left")
    contexts = image_contexts(images, bases)
    names = [c for c in contexts.columns if c not in ("page", "idx")]
    return computed(contexts, score=image_score({c: F.col(c) for c in names})).where("score > 0").select(*OUT)


def _drawings(rows: DataFrame, svg: Column) -> DataFrame:
    """Adds ``fixed``, the markup with black for currentColor; drawings that are no more than icons are left out."""
    return computed(rows, fixed=fix_current_color(svg)).where((F.length("fixed") > V.LEAST_SVG_CHARS) & ~too_small(F.col("fixed")))


def svg_inline(elements: DataFrame, bases: DataFrame) -> DataFrame:
    """Vector images in links to the home page, then in logo containers."""
    a_attr = F.col("attrs")
    under = F.explode(F.filter("ancestors", lambda x: x["tag"] == "a")["node_id"])
    inside = elements.where("tag in ('svg', 'img')").select("page", "tag", "node_id", "attrs", "classes", "text", under.alias("a_id"))
    first = F.struct("node_id", "attrs", F.array_join("classes", " ").alias("cls"), "text")
    held = inside.groupBy("page", "a_id").agg(
        F.min_by(F.when(F.col("tag") == "svg", first), F.when(F.col("tag") == "svg", F.col("node_id"))).alias("svg"),
        F.min_by(F.when(F.col("tag") == "img", first), F.when(F.col("tag") == "img", F.col("node_id"))).alias("img")).where("svg is not null")
    anchors = elements.where((F.col("tag") == "a") & F.array_contains(F.map_keys("attrs"), "href")).where(in_header(F.col("ancestors")) | in_nav(F.col("ancestors")))
    anchors = anchors.select("page", F.col("node_id").alias("a_id"), F.col("attrs").alias("a_attrs"), F.lower(F.array_join("classes", " ")).alias("a_cls"), F.lower("id").alias("a_name"))
    links = _with_base(anchors.join(held, ["page", "a_id"]), bases).where(is_home_link(strip(F.col("a_attrs")["href"]), F.col("base_url")))
    with_img = computed(links.where("img is not null"), src=image_source_plain(F.col("img.attrs")))
    with_img = computed(with_img, url=normalize_url(F.col("src"), F.col("base_url"))).where(is_valid_image(F.col("url"))).select("page", F.col("a_id").cast("long").alias("idx"), "url", F.lit(75).alias("score"))
    a_ctx = F.concat_ws(" ", "a_cls", "a_name")
    plain = (low(F.col("svg.attrs")["aria-hidden"]) != "true") & ~is_ui_icon(F.col("svg.cls")) & ~(is_ui_icon(a_ctx) & ~has(a_ctx, "logo"))
    score = F.when(has_any(F.col("a_cls"), ["brand", "logo"]), 90).otherwise(80) + points(has(low(F.col("a_attrs")["aria-label"]), "home"), 5)
    drawn = _drawings(links.where(F.col("img").isNull() & plain), F.col("svg.text")).select("page", F.col("a_id").cast("long").alias("idx"), svg_data_uri(F.col("fixed")).alias("url"), score.alias("score"))

    near = F.slice("ancestors", 1, 5)
    cls = lambda x: F.lower(F.array_join(x["classes"], " "))
    logo = F.exists(near, lambda x: has_any(cls(x), ["logo", "brand"]) | has_any(F.lower(x["id"]), ["logo", "brand"]))
    hdr = F.exists(near, lambda x: (x["tag"] == "header") | cls(x).contains("header") | (F.lower(x["role"]) == "banner"))
    nav = F.exists(near, lambda x: (x["tag"] == "nav") | cls(x).contains("nav-") | F.concat(cls(x), F.lit(" ")).contains("nav ") | (F.lower(x["role"]) == "navigation"))
    foot = F.exists(near, lambda x: (x["tag"] == "footer") | cls(x).contains("footer"))
    boxes = elements.where((F.col("tag") == "svg") & (low(a_attr["aria-hidden"]) != "true") & ~is_ui_icon(F.array_join("classes", " ")))
    boxes = computed(boxes, logo=logo, hdr=hdr, nav=nav, foot=foot).where("logo and (hdr or nav) and not foot").join(bases.select("page"), "page")
    # the second approach comes after all of the first
    contained = _drawings(boxes, F.col("text")).select("page", (F.col("node_id").cast("long") + (1 << 40)).alias("idx"), svg_data_uri(F.col("fixed")).alias("url"), F.when(F.expr("hdr and nav"), 95).otherwise(85).alias("score"))
    return with_img.unionByName(drawn).unionByName(contained)


def image_source_plain(attrs: Column) -> Column:
    """Address of an image without looking at srcset."""
    return image_source(F.map_filter(attrs, lambda k, v: k != "srcset"))


def json_ld(elements: DataFrame, bases: DataFrame) -> DataFrame:
    """Logo, then image, of top-level objects. No validity test of addresses."""
    rows = _with_base(elements.where((F.col("tag") == "script") & (F.col("attrs")["type"] == "application/ld+json")), bases)
    doc = F.try_parse_json(F.col("text"))
    items = rows.select("page", "base_url", "node_id", F.posexplode(F.coalesce(F.try_variant_get(doc, "$", "array<variant>"), F.array(doc))).alias("pos", "item"))

    def address(field: str) -> Column:
        value = F.try_variant_get("item", f"$.{field}", "variant")
        kind = F.schema_of_variant(value)
        inner = F.coalesce(*(F.nullif(F.try_variant_get("item", f"$.{field}.{k}", "string"), F.lit("")) for k in ("url", "contentUrl")))
        return F.when(kind == "STRING", F.try_variant_get("item", f"$.{field}", "string")).when(kind.startswith("OBJECT"), inner)

    found = items.select("page", "base_url", "node_id", "pos", address("logo").alias("logo"), address("image").alias("image"))
    found = found.select("page", "base_url", "node_id", "pos", F.posexplode(F.array("logo", "image")).alias("which", "raw")).where("raw is not null")
    found = computed(found.where((F.col("which") == 0) | is_likely_logo(F.col("raw"))), url=normalize_url(F.col("raw"), F.col("base_url"))).where("url is not null")
    score = F.when(F.col("which") == 1, 70).when(is_dealer_address(F.col("url")), 50).otherwise(90)
    idx = F.shiftleft(F.col("node_id").cast("long"), 31) + F.col("pos").cast("long") * 2 + F.col("which")
    return found.select("page", idx.alias("idx"), "url", score.alias("score"))


def css_background(elements: DataFrame, bases: DataFrame) -> DataFrame:
    """X8."""
    anc = F.col("ancestors")
    rows = elements.where(F.col("attrs")["style"].isNotNull()).where(in_header(anc) | in_nav(anc))
    raw = F.regexp_extract(F.col("attrs")["style"], r"""(?i)url\(['"]?([^)'"]+(?:logo|brand)[^)'"]*)['"]?\)""", 1)
    rows = computed(rows, raw=raw).where("raw <> ''")
    rows = computed(_with_base(rows, bases), url=normalize_url(F.col("raw"), F.col("base_url")))
    return rows.where(is_valid_image(F.col("url"))).select("page", F.col("node_id").alias("idx"), "url", F.lit(55).alias("score"))


def manifest_icons(manifests: DataFrame) -> DataFrame:
    """(page, manifest_url, body) of fetched manifests to icons."""
    icons = F.from_json("body", "icons array<struct<src:string,sizes:string>>")["icons"]
    rows = manifests.select("page", "manifest_url", F.posexplode(icons).alias("idx", "icon")).where("icon.src <> ''")
    rows = computed(rows, url=normalize_url(F.col("icon.src"), F.col("manifest_url"))).where(F.col("url").isNotNull() & ~is_framework_icon(F.col("url")))
    bonus = F.when(has(F.col("icon.sizes"), "x"), icon_size_bonus(F.col("icon.sizes"))).otherwise(0)
    return rows.select("page", "idx", "url", (35 + bonus).alias("score"))


PAGE_STRATEGIES = {"json_ld": json_ld, "link_tag": link_tags, "meta_tag": meta_tags, "img_tag": img_tags, "svg_fallback": svg_inline, "css_background": css_background}


def page_candidates(elements: DataFrame, bases: DataFrame) -> DataFrame:
    """Union of all strategies: (page, strategy, idx, url, score)."""
    parts = [f(elements, bases).select("page", F.lit(name).alias("strategy"), F.col("idx").cast("long").alias("idx"), "url", F.col("score").cast("int").alias("score")) for name, f in PAGE_STRATEGIES.items()]
    return reduce(DataFrame.unionByName, parts)
