"""Addresses: parts, resolution, validity (P1-P6, P12, P14-P17, F2, F3). Null or empty in gives null or false out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.text import blank_to_null, bound, has, has_any, low, text_or_empty

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)"


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(text_or_empty(url), _PARTS, 1))


def url_path(url: Column) -> Column:
    """Path without query and fragment."""
    return F.regexp_extract(text_or_empty(url), _PARTS, 3)


def url_host(url: Column) -> Column:
    """Host in lower case without user, port; empty if there is none."""
    return F.lower(F.regexp_extract(F.regexp_extract(text_or_empty(url), _PARTS, 2), r"^(?:[^@]*@)?([^:]*)", 1))


def url_filename(url: Column) -> Column:
    """What follows the last slash of the whole address, query included, in lower case."""
    return F.substring_index(low(url), "/", -1)


def url_extension(url: Column) -> Column:
    """Extension of the path from the known ones, else as the query's format says, else .png."""
    path, whole = F.lower(url_path(url)), low(url)
    out = F
    for e in V.EXTENSIONS:
        out = out.when(path.endswith(e), e)
    return out.when(has(whole, "format=png"), ".png").when(has(whole, "format=svg"), ".svg").otherwise(".png")


def is_likely_logo(url: Column) -> Column:
    return has_any(F.lower(url), V.LIKELY_LOGO)


def is_valid_image(url: Column) -> Column:
    """False for null, empty, and addresses of trackers, interface icons, flags and third parties."""
    whole, name = low(url), url_filename(url)
    flag = has(name, "flag") & ~has(name, "logo")
    return (whole != "") & ~has_any(name, V.REJECT_FILENAME) & ~has_any(whole, V.REJECT_ADDRESS) & ~flag & ~has_any(whole, V.THIRD_PARTY)


_STRIP = r"^[\s\x1c-\x1f\x85\xa0]+|[\s\x1c-\x1f\x85\xa0]+$"


def strip(c: Column) -> Column:
    """Without white space at the ends (trim() takes blanks only)."""
    return F.regexp_replace(c, _STRIP, "")


_WHOLE = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//([^/?#]*))?([^?#]*?)(;[^/?#;]*(?:;[^/?#]*)?)?(\?[^#]*)?(#.*)?$"


def _parts(text: Column) -> Column:
    """Scheme, host with its slashes, host, path, parameters, query and fragment of an address, as browsers clean it."""
    clean = F.regexp_replace(F.regexp_replace(text, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    names = ["scheme", "slashes", "host", "path", "params", "query", "fragment"]
    return bound(clean, lambda c: F.struct(*((F.lower(F.regexp_extract(c, _WHOLE, k)) if k == 1 else F.regexp_extract(c, _WHOLE, k)).alias(n) for k, n in enumerate(names, 1))))


def _none() -> Column:
    return F.array().cast("array<string>")


def _steps(path: Column, base: Column) -> Column:
    """A path on top of its base's folder (RFC 3986): empty steps inside are dropped unless the path is rooted, dots are resolved."""
    # the last step of the base is no folder; an empty one stays, so that what follows is rooted
    folder = bound(F.split(base, "/", -1), lambda b: F.when(F.element_at(b, -1) != "", F.slice(b, F.lit(1), F.size(b) - 1)).otherwise(b))
    inner = lambda x: F.filter(x, lambda step, k: (step != "") | (k == 0) | (k == F.size(x) - 1))
    every = F.when(path.startswith("/"), F.split(path, "/", -1)).otherwise(bound(F.concat(folder, F.split(path, "/", -1)), inner))
    back = lambda held: F.slice(held, F.lit(1), F.greatest(F.size(held) - 1, F.lit(0)))
    walk = lambda steps: F.aggregate(steps, _none(), lambda held, x: F.when(x == "..", back(held)).when(x == ".", held).otherwise(F.concat(held, F.array(x))))
    end = lambda steps: F.when(F.element_at(steps, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(_none())
    return bound(bound(every, lambda steps: F.array_join(F.concat(walk(steps), end(steps)), "/")), lambda out: F.when(out == "", "/").otherwise(out))


def _merged(ref: Column, root: Column, url: Column) -> Column:
    alone, bare = ref["host"] != "", (ref["path"] == "") & (ref["params"] == "")
    same = bare & ~alone
    full = lambda c: F.when(F.length(c) > 1, c).otherwise("")
    path = F.when(alone, ref["path"]).when(bare, root["path"]).otherwise(_steps(ref["path"], root["path"]))
    host = F.when(alone, ref["host"]).otherwise(root["host"])
    tail = F.concat(
        F.when(same, full(root["params"])).otherwise(full(ref["params"])),
        F.when(same & (full(ref["query"]) == ""), full(root["query"])).otherwise(full(ref["query"])), full(ref["fragment"]))

    def whole(v: Column) -> Column:
        slash = F.when((v["host"] != "") & (v["path"] != "") & ~v["path"].startswith("/"), "/").otherwise("")
        return F.concat(F.when(v["host"] != "", F.concat(F.lit("//"), v["host"])).otherwise(""), slash, v["path"])

    merged = F.concat(F.when(root["scheme"] != "", F.concat(root["scheme"], F.lit(":"))).otherwise(""), bound(F.struct(host.alias("host"), path.alias("path")), whole), tail)
    foreign = ((ref["scheme"] != "") & (ref["scheme"] != root["scheme"])) | ~root["scheme"].isin(*V.MERGED_SCHEMES)
    odd = lambda h: F.contains(h, F.lit("[")) != F.contains(h, F.lit("]"))
    return F.when(odd(ref["host"]), F.lit(None)).when(foreign, url).when(~odd(host), merged)


def merge_url(url: Column, base: Column) -> Column:
    """A reference resolved against its base, all in Spark expressions. Without a base the reference stays, without a reference the base;
    references of another scheme stay as they are. Null for hosts in broken brackets, and for a null reference."""
    both = F.struct(_parts(url).alias("ref"), _parts(base).alias("root"))
    return F.when(url.isNull(), F.lit(None)).when(text_or_empty(base) == "", url).when(url == "", base).otherwise(bound(both, lambda v: _merged(v["ref"], v["root"], url)))


def normalize_url(url: Column, base: Column) -> Column:
    """Absolute address; inline vector images stay, other data addresses and blanks are null."""
    return bound(strip(url), lambda u: _absolute(u, base))


def _absolute(u: Column, base: Column) -> Column:
    absolute = F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).otherwise(u)
    return (
        F.when(u.isNull() | (u == ""), F.lit(None).cast("string"))
        .when(u.startswith("data:image/svg+xml"), u)
        .when(u.startswith("data:"), F.lit(None).cast("string"))
        .when(absolute.rlike("^https?://"), absolute)
        .otherwise(merge_url(absolute, base))
    )


def sanitize_filename(name: Column) -> Column:
    """Letters, digits, underscores, hyphens and dots of any script stay; all else becomes an underscore."""
    return F.regexp_replace(name, r"(?U)[^\w\-.]", "_")


def user_agent_no(domain: Column) -> Column:
    """Number of the agent that fetches a domain; the same in every process."""
    return F.pmod(F.xxhash64(domain), F.lit(V.USER_AGENTS)).cast("int")


def image_source(attrs: Column) -> Column:
    """Address of an image element: lazy-loading attributes replace placeholders, the first of srcset comes last."""
    src = text_or_empty(attrs["src"])
    lazy = F.coalesce(*(blank_to_null(attrs[a]) for a in V.LAZY_ATTRIBUTES))
    inline = src.startswith("data:image/svg+xml") & (F.length(src) > 200)
    placeholder = F.lit(False)
    for p in V.LAZY_PREFIXES:
        placeholder = placeholder | src.startswith(p)
    own = F.when(placeholder & ~inline, F.coalesce(lazy, src)).when(src == "", lazy).otherwise(src)
    return F.coalesce(blank_to_null(own), srcset_first(attrs["srcset"]))


def srcset_first(srcset: Column) -> Column:
    return blank_to_null(F.regexp_extract(text_or_empty(srcset), r"^\s*([^\s,]+)", 1))


def icon_size_bonus(sizes: Column) -> Column:
    """A tenth of the width, up to 30; 0 if there is no whole number before the x."""
    w = F.try_to_number(F.nullif(F.trim(F.split(text_or_empty(sizes), "x")[0]), F.lit("")), F.lit("S999999999")).cast("long")
    return F.when(w.isNull(), 0).otherwise(F.least(F.floor(w / 10), F.lit(30)).cast("int"))


def alnum_fold(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def percent_decode(c: Column) -> Column:
    """Percent escapes only: a plus sign stays."""
    return F.try_url_decode(F.regexp_replace(c, r"\+", "%2B"))


def content_extension(content_type: Column, url: Column, way: str = "http") -> Column:
    """Extension by content type, in order, else by address. ``way``: how the file came: http, curl, browser or icon."""
    kind = text_or_empty(content_type) if way == "curl" else low(content_type)
    out = F
    for hint, ext in V.CONTENT_TYPES_OF[way].items():
        out = out.when(has(kind, hint), ext)
    return out.otherwise(V.CONTENT_DEFAULT[way] if way in V.CONTENT_DEFAULT else url_extension(url))


def is_home_link(href: Column, base: Column | None = None) -> Column:
    """Root links, or absolute ones without a path; with ``base`` also those that equal it."""
    h = text_or_empty(href)
    bare = url_scheme(h).isin("http", "https") & (F.regexp_replace(url_path(h), "/+$", "") == "")
    same = h == F.regexp_replace(text_or_empty(base), "/+$", "") if base is not None else F.lit(False)
    return h.isin("/", "#", "", "./") | bare | (F.regexp_replace(h, "/+$", "") == "") | same
