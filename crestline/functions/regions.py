"""Where on a page an element stands (F4-F6, F10-F13), on structs tag, classes, id, role and arrays of them, nearest first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.text import has_any, low, text_or_empty


def _tokens(node: Column) -> Column:
    """Class tokens in lower case (a class attribute may hold upper case or stray blanks)."""
    return F.filter(F.transform(F.coalesce(node["classes"], F.array()), lambda c: F.lower(c)), lambda c: c != "")


def is_site_header(node: Column) -> Column:
    """Header of the page, not of a section or card. A token with any hyphen is cut at its last hyphen, else at its last underscore."""
    def header_token(t: Column) -> Column:
        ends = t.endswith("-header") | t.endswith("_header")
        prefix = F.when(t.contains("-"), F.regexp_replace(t, "-[^-]*$", "")).otherwise(F.regexp_replace(t, "_[^_]*$", ""))
        return t.isin(*V.HEADER_CLASSES) | (ends & ~prefix.isin(*V.NOT_HEADER_PREFIXES))

    tag = text_or_empty(node["tag"])
    named = (tag == "header") | (low(node["role"]) == "banner") | F.exists(_tokens(node), header_token) | low(node["id"]).isin(*V.HEADER_IDS)
    return ~tag.isin("body", "html", "[document]") & named


def is_site_nav(node: Column) -> Column:
    return (text_or_empty(node["tag"]) == "nav") | (low(node["role"]) == "navigation") | F.exists(_tokens(node), lambda t: t.isin(*V.NAV_CLASSES)) | low(node["id"]).isin(*V.NAV_IDS)


def is_footer(node: Column) -> Column:
    return (text_or_empty(node["tag"]) == "footer") | F.concat_ws(" ", _tokens(node)).contains("footer")


def in_header(ancestors: Column) -> Column:
    return F.exists(ancestors, is_site_header)


def in_nav(ancestors: Column) -> Column:
    return F.exists(ancestors, is_site_nav)


def in_footer(ancestors: Column) -> Column:
    return F.exists(ancestors, is_footer)


def in_logo_widget(ancestors: Column) -> Column:
    return F.exists(ancestors, lambda a: F.arrays_overlap(_tokens(a), F.array(*map(F.lit, V.LOGO_WIDGETS))))


def is_captcha_page(title: Column, html: Column) -> Column:
    """Challenge pages, by title or by the start of the page."""
    return has_any(F.lower(title), V.CAPTCHA_TITLES) | has_any(F.lower(F.substring(html, 1, V.CAPTCHA_CHARS)), V.CAPTCHA_BODY)


def is_ui_icon(classes: Column, rendered: bool = False) -> Column:
    return has_any(low(classes), V.ICON_HINTS_RENDERED if rendered else V.ICON_HINTS)


def is_framework_icon(url: Column) -> Column:
    return has_any(low(url), V.FRAMEWORK_ICONS)


def is_dealer_address(url: Column, rendered: bool = False) -> Column:
    return has_any(low(url), V.DEALER_ADDRESS_RENDERED if rendered else V.DEALER_ADDRESS)
