"""Vector images as text (P7-P12, F9, F16): markup is read as attributes with what stands between them, and decided on attribute by attribute."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.text import any_of, bound, text_or_empty
from crestline.functions.urls import percent_decode

# starts where a name starts and never goes back: a long text without attributes is read once
ATTRIBUTE = r"""(?<![\w:.-])([\w:.-]++)(\s*+=\s*+)("[^"]*+"|'[^']*+')"""
DISPLAY = r"display\s*:\s*(none|block)"
NAMESPACE = "http://www.w3.org/2000/svg"


def _attributes(markup: Column) -> Column:
    return F.regexp_extract_all(text_or_empty(markup), F.lit(ATTRIBUTE), F.lit(0))


def _name(attribute: Column) -> Column:
    return F.regexp_extract(attribute, ATTRIBUTE, 1)


def _value(attribute: Column) -> Column:
    return F.regexp_extract(attribute, r"""=\s*["']([\s\S]*)["']$""", 1)


def _is(attribute: Column, name: str) -> Column:
    """Of this name, maybe with a prefix before a sign (data-fill, svg:width)."""
    return _name(attribute).rlike(rf"(^|\W){name}$")


def _rewritten(markup: Column, *rules: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """The markup with every attribute rewritten: a rule tells from the text before an attribute and the attribute what both become."""

    def piece(before: Column, attribute: Column) -> Column:
        for rule in rules:
            before, attribute = rule(before, attribute)
        return F.concat(before, attribute)

    whole = lambda m: F.array_join(F.zip_with(F.split(m, ATTRIBUTE, -1), _attributes(m), lambda b, a: F.when(a.isNull(), b).otherwise(piece(b, F.coalesce(a, F.lit(""))))), "")
    return bound(markup, whole)


def _number(text: Column) -> Column:
    return F.regexp_extract(text, r"^\s*([\d.]+)", 1).try_cast("double")


def too_small(svg: Column) -> Column:
    """Both sides of the view box, or of the root's width and height, are under 20. Comma-separated boxes, or ones with a sign, are not read."""
    return bound(text_or_empty(svg), _too_small)


def _too_small(svg: Column) -> Column:
    def both(width: Column, height: Column) -> Column:
        return F.coalesce((_number(width) < V.LEAST_VIEWBOX) & (_number(height) < V.LEAST_VIEWBOX), F.lit(False))

    plain = F.filter(_attributes(svg), lambda a: F.lower(_name(a)).endswith("viewbox") & _value(a).rlike(r"^\s*[\d.]+\s+[\d.]+\s+[\d.]+\s+[\d.]+"))
    box = F.split(F.trim(F.regexp_replace(_value(F.try_element_at(plain, F.lit(1))), r"\s+", " ")), " ")
    root = _attributes(F.regexp_extract(svg, r"(?i)(<svg[^>]*>)", 1))
    side = lambda held, name: _value(F.try_element_at(F.filter(held, lambda a: _is(F.lower(a), name) & _value(a).rlike(r"^[\d.]")), F.lit(1)))
    return bound(box, lambda b: both(F.try_element_at(b, F.lit(3)), F.try_element_at(b, F.lit(4)))) | bound(root, lambda r: both(side(r, "width"), side(r, "height")))


def _current(value: Column) -> Column:
    return F.lower(value) == "currentcolor"


def painted(markup: Column, prop: str, color: Column) -> Column:
    """The property's currentColor, as an attribute and in style rules, replaced by a colour."""
    quoted = F.concat(F.lit(f'{prop}="'), color, F.lit('"'))
    attribute = lambda b, a: (b, F.when(F.lower(_name(a)).endswith(prop) & _current(_value(a)), F.concat(F.regexp_replace(_name(a), f"(?i){prop}$", ""), quoted)).otherwise(a))
    return F.regexp_replace(_rewritten(markup, attribute), F.lit(rf"(?i){prop}\s*:\s*currentcolor"), F.concat(F.lit(f"{prop}:"), color))


def _filled_otherwise(markup: Column, spellings: list[str] | None) -> Column:
    """Whether some fill is neither current colour nor none; ``spellings`` are those of current colour, None: any case."""
    def other(a: Column) -> Column:
        value = _value(a) if spellings else F.lower(_value(a))
        name = _name(a) if spellings else F.lower(_name(a))
        return name.endswith("fill") & (value != "") & ~any_of([value.startswith(x) for x in [*(spellings or ["currentcolor"]), "none"]])

    return F.exists(_attributes(markup), other)


def _blackened(markup: Column, spellings: list[str] | None) -> Column:
    """Current colour to black: strokes always, fills only where there is no other fill."""
    black = F.lit(V.BLACK)
    filled = bound(markup, lambda m: F.when(_filled_otherwise(m, spellings), m).otherwise(painted(m, "fill", black)))
    return painted(filled, "stroke", black)


def fix_current_color(svg: Column) -> Column:
    """Inline form: case never matters."""
    return _blackened(svg, None)


def invert_white(svg: Column) -> Column:
    """Fills that are all white become black, in the spellings that are known."""
    return bound(svg, _inverted)


def _inverted(svg: Column) -> Column:
    fills = F.filter(_attributes(svg), lambda a: _name(a).endswith("fill"))
    values = F.filter(F.transform(fills, lambda a: F.lower(F.trim(_value(a)))), lambda v: ~v.isin("none", ""))
    white = (F.size(values) > 0) & F.forall(values, lambda v: v.isin(*V.WHITE_FILLS))

    def black(before: Column, a: Column) -> tuple[Column, Column]:
        known = _name(a).endswith("fill") & (F.regexp_extract(a, ATTRIBUTE, 2) == "=") & _value(a).isin(*V.WHITE_SPELLINGS)
        quote = F.substring(a, -1, 1)
        return before, F.when(known, F.concat(_name(a), F.lit("="), quote, F.lit(V.BLACK), quote)).otherwise(a)

    return F.when(white, _rewritten(svg, black)).otherwise(svg)


def _named(markup: Column) -> Column:
    """With a name space on the first root, if there is none anywhere."""
    def named(m: Column) -> Column:
        at = F.locate("<svg ", m)
        added = F.concat(F.substring(m, F.lit(1), at + 4), F.lit(f'xmlns="{NAMESPACE}" '), F.substring(m, at + 5, F.length(m)))
        return F.when((at > 0) & ~F.contains(m, F.lit("xmlns")), added).otherwise(m)

    return bound(markup, named)


def _box_spelling(spaced: bool) -> Callable[[Column, Column], tuple[Column, Column]]:
    """viewbox to viewBox, also with spaces before the equals sign if they are allowed, which are dropped."""
    def rule(before: Column, a: Column) -> tuple[Column, Column]:
        sign = F.regexp_extract(a, ATTRIBUTE, 2)
        wrong = _name(a).rlike(r"(^|\W)viewbox$") if spaced else _name(a).endswith("viewbox") & sign.startswith("=")
        right = F.concat(F.regexp_replace(_name(a), "viewbox$", "viewBox"), F.regexp_replace(sign, r"^\s+", ""), F.regexp_extract(a, ATTRIBUTE, 3))
        return before, F.when(wrong, right).otherwise(a)

    return rule


def _shown(whole: bool) -> Callable[[Column, Column], tuple[Column, Column]]:
    """Style attributes in double quotes that set display to none or block are dropped: anywhere in the style, or only where it starts
    with that, is written without spaces and follows one, which is dropped as well."""
    def rule(before: Column, a: Column) -> tuple[Column, Column]:
        style = _name(a).endswith("style") & a.endswith('"')
        if whole:
            gone = style & _value(a).rlike(DISPLAY)
            return before, F.when(gone, F.regexp_replace(_name(a), "style$", "")).otherwise(a)
        gone = style & (_name(a) == "style") & (F.regexp_extract(a, ATTRIBUTE, 2) == "=") & _value(a).rlike(r"^display:\s*(none|block)") & before.rlike(r"\s$")
        return F.when(gone, F.regexp_replace(before, r"\s+$", "")).otherwise(before), F.when(gone, F.lit("")).otherwise(a)

    return rule


def sanitize_svg(svg: Column) -> Column:
    """Stands alone: view box spelling, name space, current colour, hidden styles, white fills. Null stays null."""
    named = _named(_rewritten(svg, _box_spelling(spaced=True)))
    return invert_white(_rewritten(_blackened(named, ["currentcolor", "currentColor"]), _shown(whole=True)))


def render_ready(svg: Column) -> Column:
    """What a renderer gets: as above, but current colour stays and only styles that start with display go."""
    named = _named(_rewritten(svg, _box_spelling(spaced=False)))
    return invert_white(_rewritten(named, _shown(whole=False)))


def svg_data_uri(svg: Column) -> Column:
    # Spark breaks base64 into lines
    return F.concat(F.lit("data:image/svg+xml;base64,"), F.regexp_replace(F.base64(F.encode(svg, "utf-8")), r"\s", ""))


def data_uri_bytes(uri: Column) -> Column:
    """Bytes of an inline vector image; null if it can't be read."""
    payload = F.regexp_extract(uri, r"(?s)^[^,]*,(.*)$", 1)
    return F.when(uri.contains(";base64,"), F.try_to_binary(payload, F.lit("base64"))).when(uri.contains(","), F.encode(percent_decode(payload), "utf-8"))


def data_uri_valid(uri: Column) -> Column:
    """Inline vector images of at least 400 bytes that are not tiny."""
    raw = data_uri_bytes(uri)
    return F.coalesce((F.octet_length(raw) >= V.LEAST_DATA_URI_BYTES) & ~too_small(F.try_validate_utf8(raw.cast("string"))), F.lit(False))
