"""Scores of image candidates as sums of rules: static pages (L1-L27) and rendered pages (B2). The two sets differ and share nothing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.text import any_of, has, has_any, low, points, text_or_empty
from crestline.functions.urls import alnum_fold, strip, url_filename, url_host, url_path, url_scheme

CONTEXT = """url string, alt string, class string, id string, parent_class string, parent_id string, grandparent_class string,
grandparent_id string, grandparent_tag string, is_in_header boolean, is_in_footer boolean, is_in_nav boolean, dom_position int,
parent_href string, domain string"""


def url_rules(url: Column) -> dict[str, Column]:
    """Rules that look at the address alone."""
    u, path = low(url), F.lower(url_path(url))
    return {
        "L1": points(has(u, "logo"), 40),
        "L4": F.when(u.endswith(".svg") | has(u, "/svg"), 20).when(u.endswith(".png"), 10).when(u.endswith(".jpg") | u.endswith(".jpeg"), 5).otherwise(0),
        "L18": points(has_any(path, V.OTHER_LOGO_PATHS), -20),
        "L19": points(has(u, "capital") & has(u, "logo"), -15),
        "L20": points(has(u, "icon") & ~has(u, "logo"), -10),
        "L21": points(has_any(u, ["social", "facebook", "twitter"]), -40),
        "L22": points(has_any(u, V.PLATFORMS), -60),
        "L23": points(has(u, "flag"), -60) + points(has(u, "favicon"), -15),
        "L24": points(has(url_filename(url), "footer"), -25),
        "L27": points(has_any(path, V.CONTENT_DIRS) & ~has(path, "logo"), -25),
    }


def image_rules(c: dict[str, Column]) -> dict[str, Column]:
    """Every rule of the static score, by name; ``c`` has the columns of CONTEXT. Nulls count as empty, false and far down."""
    url = text_or_empty(c["url"])
    u, path = low(url), F.lower(url_path(url))
    alt, cls, id_, pc, pi, gc, gi = (low(c[k]) for k in ("alt", "class", "id", "parent_class", "parent_id", "grandparent_class", "grandparent_id"))
    flag = lambda k: F.coalesce(c[k], F.lit(False))
    href = text_or_empty(c["parent_href"])
    context = F.concat_ws(" ", alt, cls, id_, pc, pi, gc, gi, path)
    either = lambda a, b, t: has(a, t) | has(b, t)
    rules = url_rules(url)

    brand = strip(alt)
    brand_fold, domain_fold = alnum_fold(brand), alnum_fold(low(c["domain"]))
    foreign = ~brand.isin("logo", "home", "") & (F.length(brand) < 30) & (brand_fold != "") & (domain_fold != "") & ~domain_fold.contains(brand_fold)
    rules["L2"] = points(foreign & has(u, "logo"), -80)
    rules["L3"] = points(has_any(low(href), V.CAREER_LINKS), -60)
    near = any_of([has_any(x, V.NAV_LOGO) for x in (cls, id_, pc, pi)])
    far = has_any(gc, V.NAV_LOGO) | has_any(gi, V.NAV_LOGO)
    rules["L5"] = F.when(near, 100).when(far, 80).otherwise(0)
    parent = either(pi, pc, "logo")
    rules["L6"] = F.when((pi == "logo") | (pc == "logo"), 80).when(parent, F.when(either(pc, pi, "dealer"), 20).otherwise(50)).otherwise(0)
    grand = either(gc, gi, "logo")
    rules["L7"] = F.when(grand, F.when(either(gc, gi, "dealer"), 15).otherwise(40)).otherwise(0)
    own = either(cls, id_, "logo")
    rules["L8"] = F.when(own, F.when(either(cls, id_, "nav"), 70).when(either(cls, id_, "dealer"), 15).otherwise(50)).otherwise(0)
    rules["L9"] = points(has(alt, "logo"), 30)
    texts = (cls, id_, pc, pi, alt)
    named = F.lit(0)
    for t in texts:
        named = named + points(has(t, "brand"), 25) + points(has_any(t, ["site-logo", "site_logo"]), 60)
        named = named + F.when(has_any(t, ["header-logo", "header_logo"]), F.when(has(t, "dealer"), 10).otherwise(55)).otherwise(0)
        named = named + points(has(t, "navbar-brand"), 50) + points(has(t, "custom-logo"), 50)
    rules["L10"] = named
    rules["L11"] = F.when(flag("is_in_header"), 30 + points(has(pc, "logo") | has(pi, "logo") | has(gc, "logo"), 40)).otherwise(0)
    rules["L12"] = points(flag("is_in_nav"), 20) + points(low(c["grandparent_tag"]).isin("header", "nav"), 25)
    rules["L13"] = F.when(c["dom_position"] <= 3, 20).when(c["dom_position"] <= 10, 10).otherwise(0)
    rules["L14"] = points(flag("is_in_footer"), -20)
    rules["L15"] = points(has_any(context, V.DEALER_WORDS), -20)
    rules["L16"] = points(has_any(context, V.PARTNER_WORDS), -25)
    # the signal as it stands before and after the link to the home page is looked at
    signal = has(u, "logo") | near | far | parent | grand | own | has(alt, "logo") | any_of([has_any(t, ["brand", "site-logo", "site_logo", "header-logo", "header_logo", "navbar-brand", "custom-logo"]) for t in texts])
    rules["L17"] = points(~signal & has_any(context, V.UI_WORDS), -60)
    bare = url_scheme(href).isin("http", "https") & (F.regexp_replace(url_path(href), "/+$", "") == "")
    home = href.isin("/", "./") | (~href.isin("", "#") & bare)
    rules["L25"] = points(home, 40)
    rules["L26"] = points(~(signal | home), -40)
    return rules


def image_score(c: dict[str, Column]) -> Column:
    total = F.lit(0)
    for rule in image_rules(c).values():
        total = total + rule
    return total.cast("int")


RENDERED = """src string, alt string, class string, id string, parent_class string, parent_id string, grandparent_class string, grandparent_id string,
in_header boolean, in_nav boolean, in_footer boolean, in_logo_widget boolean, top_px double, natural_w int, natural_h int, visible boolean,
idx int, link_href string, page_origin string"""


def rendered_score(c: dict[str, Column]) -> Column:
    """Score of an image of a rendered page, or null where it is no candidate. ``c`` has the columns of RENDERED."""
    src = text_or_empty(c["src"])
    s = F.lower(src)
    alt, cls, id_, pc, pi, gc, gi = (low(c[k]) for k in ("alt", "class", "id", "parent_class", "parent_id", "grandparent_class", "grandparent_id"))
    flag = lambda k: F.coalesce(c[k], F.lit(False))
    inline = src.startswith("data:image/svg+xml") & (F.length(src) > 200)
    name = F.substring_index(s, "/", -1)
    own = F.concat_ws(" ", cls, id_, pc, alt)
    rejected = (src == "") | (src.startswith("data:") & ~inline) | has_any(s, V.RENDERED_REJECT) | (has(name, "flag") & ~has(name, "logo")) | (has_any(own, V.RENDERED_UI) & ~has(own, "logo"))
    ctx = F.concat_ws(" ", s, alt, cls, id_, pc, pi, gc, gi)
    top = F.coalesce(c["top_px"] < 200, F.lit(False))
    origin, href = text_or_empty(c["page_origin"]), strip(text_or_empty(c["link_href"]))
    home = c["link_href"].isNotNull() & (href.isin("/", "./") | (href == origin) | (href == F.concat(origin, F.lit("/"))))
    shown = F.coalesce(c["visible"], F.lit(True))
    w, h = F.coalesce(c["natural_w"], F.lit(0)), F.coalesce(c["natural_h"], F.lit(0))
    score = (
        points(has(ctx, "logo"), 50) + points(has(ctx, "brand"), 30)
        + points(has_any(ctx, ["nav_logo", "nav-logo", "navigation-logo", "navigation_logo"]), 80)
        + points(has_any(ctx, ["home-logolink", "home-logo", "home_logo"]), 80)
        + points(has_any(ctx, ["site-logo", "site_logo"]), 70) + points(has_any(ctx, ["header-logo", "header_logo"]), 60)
        + points(has(cls, "logo") | has(id_, "logo"), 40) + points((pc == "logo") | (pi == "logo"), 60)
        + points(flag("in_header"), 30) + points(flag("in_nav"), 20) + points(top, 25) + points(flag("in_footer"), -30) + points(home, 40)
        + points(has(ctx, "dealer"), -20) + points(has_any(ctx, ["partner", "sponsor"]), -25) + points(has(ctx, "flag"), -60)
        + points(src.endswith(".svg"), 15) + points(c["idx"] < 5, 10) + points(~shown, -50) + points(top & shown & (w > 30) & (h > 10), 5)
    )
    score = score + points((w > 600) & (h > 300) & (score < 50), -30)
    host, page = url_host(src), F.replace(url_host(origin), F.lit("www."), F.lit(""))
    # the address must parse for the host to be compared; hosts that contain each other are one
    abroad = (host != "") & ~host.contains(page) & ~page.contains(F.replace(host, F.lit("www."), F.lit("")))
    placed = flag("in_header") | flag("in_nav") | flag("in_logo_widget")
    final = score + points(flag("in_logo_widget") & ~flag("in_header"), 30)
    return F.when(~rejected & ~(abroad & (score < 50)) & placed & (final > 10), final.cast("int"))
