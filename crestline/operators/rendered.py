"""Candidates of pages that a browser has rendered (S14, B1-B6), from tables of elements with their layout.

``images`` has the columns of ``scoring.RENDERED`` and ``page``; ``shapes``: (page, idx, markup, classes, aria_hidden, in_header, in_nav,
logo_around, link_href, link_img, color, page_origin); ``boxes``: (page, idx, tag, classes, background, in_header_or_nav);
``scripts``: (page, idx, text). Regions start at the element itself there, as the browser's do: ``with_regions`` tells them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.regions import in_footer, in_header, in_nav, is_dealer_address, is_ui_icon
from crestline.functions.scoring import RENDERED, rendered_score
from crestline.functions.svg import painted, svg_data_uri
from crestline.functions.text import has, has_any, low, points, text_or_empty
from crestline.functions.urls import strip, url_path

TOP = 5


def with_regions(elements: DataFrame, path: str = "path") -> DataFrame:
    """B1: adds in_header, in_nav, in_footer and in_logo_widget of elements with a path: nodes (tag, classes, id, role), the element itself first.

    Tags are compared in any case; a widget's class is looked for anywhere in the class text. An empty or null path is in no region.
    """
    nodes = F.transform(F.coalesce(F.col(path), F.array()), lambda x: x.withField("tag", F.lower(x["tag"])))
    widget = F.exists(nodes, lambda x: has_any(F.lower(F.array_join(F.coalesce(x["classes"], F.array()), " ")), V.LOGO_WIDGETS))
    return elements.select("*", in_header(nodes).alias("in_header"), in_nav(nodes).alias("in_nav"), in_footer(nodes).alias("in_footer"), widget.alias("in_logo_widget"))


def rendered_images(images: DataFrame) -> DataFrame:
    """B2."""
    names = [c.split()[0] for c in RENDERED.replace("\n", " ").split(", ")]
    score = rendered_score({c: F.col(c) for c in names})
    return images.select("page", F.lit(0).alias("part"), "idx", F.col("src").alias("url"), score.alias("score"), F.lit("playwright_img").alias("strategy")).where("score is not null")


def _hex(color: Column) -> Column:
    part = lambda k: F.lpad(F.lower(F.hex(F.regexp_extract(color, r"rgb\((\d+),\s*(\d+),\s*(\d+)\)", k).try_cast("int"))), 2, "0")
    return F.when(color.rlike(r"rgb\(\d+,\s*\d+,\s*\d+\)"), F.concat(F.lit("#"), part(1), part(2), part(3))).when(color.startswith("#"), color).otherwise("#000000")


def rendered_shapes(shapes: DataFrame) -> DataFrame:
    """An image in the same link stands for the drawing but keeps its label."""
    href, origin = strip(text_or_empty(F.col("link_href"))), text_or_empty(F.col("page_origin"))
    home = F.col("link_href").isNotNull() & (href.isin("/", "./") | (href == origin) | (href == F.concat(origin, F.lit("/"))) | (href.startswith("http") & url_path(href).isin("/", "")))
    placed = F.col("in_header") | F.col("in_nav")
    score = F.when(F.col("logo_around") & placed, 95).when(home & placed, 85)
    svg, hexa = F.col("markup"), _hex(text_or_empty(F.col("color")))
    for prop in ("fill", "stroke"):
        svg = painted(svg, prop, hexa)
    box = F.split(F.trim(F.regexp_extract("markup", r'viewBox="([^"]*)"', 1)), r"[\s,]+")
    num = lambda c: c.try_cast("double")
    under = lambda a, b: F.coalesce((a < V.LEAST_VIEWBOX) & (b < V.LEAST_VIEWBOX), F.lit(False))
    root = F.regexp_extract("markup", r"(<svg[^>]*>)", 1)
    w, h = (num(F.regexp_extract(root, rf'\s{s}="([\d.]+)', 1)) for s in ("width", "height"))
    tiny = under(num(F.try_element_at(box, F.lit(3))), num(F.try_element_at(box, F.lit(4)))) | (under(w, h) & F.coalesce((w > 0) & (h > 0), F.lit(False)))
    drawn = F.when(~tiny & (F.length(svg) > V.LEAST_SVG_CHARS), svg_data_uri(svg))
    url = F.coalesce(F.nullif(F.col("link_img"), F.lit("")), drawn)
    kept = shapes.where(~is_ui_icon(F.col("classes"), rendered=True) & (text_or_empty(F.col("aria_hidden")) != "true"))
    return kept.select("page", F.lit(1).alias("part"), "idx", url.alias("url"), score.alias("score"), F.lit("playwright_inline_svg").alias("strategy")).where("score is not null and url is not null")


def rendered_backgrounds(boxes: DataFrame) -> DataFrame:
    """Elements with logo or brand in their class and a picture behind them."""
    cls = low(F.col("classes"))
    url = F.regexp_extract(text_or_empty(F.col("background")), r"""url\(["']?([^"')]+)["']?\)""", 1)
    named = F.col("classes").rlike("logo|Logo|brand|Brand")
    good = (url != "") & ~url.startswith("data:") & ~url.contains("gradient") & url.rlike(r"(?i)\.(svg|png|jpg|jpeg|gif|webp)")
    footer = (F.lower("tag") == "footer") | has(F.col("classes"), "footer")
    score = 80 + points(has(cls, "logo"), 20) + points(has(cls, "brand"), 10)
    return boxes.where(named & good & F.col("in_header_or_nav") & ~footer).select("page", F.lit(2).alias("part"), "idx", url.alias("url"), score.alias("score"), F.lit("playwright_css_bg").alias("strategy"))


def rendered_json_ld(scripts: DataFrame) -> DataFrame:
    """Logos only, addresses as they are."""
    doc = F.try_parse_json("text")
    items = scripts.select("page", "idx", F.explode(F.coalesce(F.try_variant_get(doc, "$", "array<variant>"), F.array(doc))).alias("item"))
    kind = F.schema_of_variant(F.try_variant_get("item", "$.logo", "variant"))
    inner = F.coalesce(*(F.nullif(F.try_variant_get("item", f"$.logo.{k}", "string"), F.lit("")) for k in ("url", "contentUrl")))
    url = F.when(kind == "STRING", F.try_variant_get("item", "$.logo", "string")).when(kind.startswith("OBJECT"), inner)
    rows = items.select("page", F.lit(3).alias("part"), "idx", url.alias("url")).where("url <> ''")
    return rows.select("*", F.when(is_dealer_address(F.col("url"), rendered=True), 50).otherwise(90).alias("score"), F.lit("playwright_jsonld").alias("strategy"))


def rendered_top(parts: list[DataFrame], keep: int = TOP) -> DataFrame:
    """The best of all parts in a stable order: (page, rank, url, score, strategy)."""
    rows = reduce(DataFrame.unionByName, parts)
    order = W.partitionBy("page").orderBy(F.desc("score"), "part", "idx")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep).select("page", "rank", "url", "score", "strategy")
