"""Validity of downloaded files, choice among them, result rows, retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.svg import data_uri_bytes, data_uri_valid, sanitize_svg, too_small
from crestline.functions.text import has, has_any, low
from crestline.functions.urls import content_extension, sanitize_filename, url_extension


def valid_download(url: Column, status: Column, content_type: Column, content: Column, width: Column, height: Column) -> Column:
    """F14. Unknown width or height never rejects."""
    kind, ext, size = low(content_type), url_extension(url), F.octet_length(content)
    svg = has(kind, "svg")
    drawn = svg | (ext == ".svg")
    banner = ~drawn & F.coalesce((width > V.MOST_WIDTH) & (height > V.MOST_HEIGHT), F.lit(False))
    bad = (size < V.LEAST_BYTES) | has_any(kind, ["text/html", "text/plain"]) | ((size > V.MOST_BYTES) & ~svg) | ((ext != ".ico") & (size < V.LEAST_LOGO_BYTES))
    tiny = drawn & too_small(F.try_validate_utf8(content.cast("string")))
    return F.coalesce((status == 200) & ~bad & ~tiny & ~banner, F.lit(False))


def valid_curl(status: Column, content_type: Column, content: Column) -> Column:
    """the looser rule of the second way to fetch."""
    size = F.octet_length(content)
    return F.coalesce((status == 200) & (size >= V.LEAST_BYTES) & ~has(content_type, "text/html") & (size <= V.MOST_BYTES), F.lit(False))


def file_name(domain: Column, url: Column, content_type: Column, way: Column | None = None) -> Column:
    """K3: name of a downloaded file. ``way``: 'http', 'curl', 'icon' or 'browser', by which the extension is told (P16); null: http."""
    ways = {w: content_extension(content_type, url, w) for w in V.CONTENT_TYPES_OF}
    ext = F.when(url.startswith("data:image/svg+xml"), ".svg")
    for w, e in ways.items():
        if w != "http" and way is not None:
            ext = ext.when(way == w, e)
    return F.concat(sanitize_filename(domain), ext.otherwise(ways["http"]))


def stored_content(url: Column, content_type: Column, content: Column, way: Column) -> Column:
    """What is written of a file: vector images are made to stand alone (P7), but for those that came by curl; text that is no UTF-8 stays as it is."""
    raw = F.when(url.startswith("data:image/svg+xml"), data_uri_bytes(url)).otherwise(content)
    drawn = url.startswith("data:image/svg+xml") | ((way != "curl") & (has(low(content_type), "svg") | (url_extension(url) == ".svg")))
    return F.when(drawn, F.coalesce(F.encode(sanitize_svg(F.try_validate_utf8(raw.cast("string"))), "utf-8"), raw)).otherwise(raw)


def attempt_downloads(ranked: DataFrame, downloads: DataFrame) -> DataFrame:
    """The first of the ranked addresses of each domain whose file is valid (W3, S11): (domain, url, strategy, path, content).

    ``downloads``: (domain, url, http_status, content_type, content, width, height, via) of fetched files, via 'http' or 'curl'.
    Inline images need no fetch. Only the content of the file that is chosen is rewritten and kept.
    """
    held = downloads.select("domain", "url", *("http_status", "content_type", "content", "width", "height", "via"))
    joined = ranked.join(held, ["domain", "url"], "left")
    inline = F.col("url").startswith("data:image/svg+xml")
    http = (F.col("via") == "http") & valid_download(*(F.col(c) for c in ("url", "http_status", "content_type", "content", "width", "height")))
    curl = (F.col("via") == "curl") & F.col("url").startswith("http") & valid_curl(F.col("http_status"), F.col("content_type"), F.col("content"))
    ok = joined.where(F.when(inline, data_uri_valid(F.col("url"))).otherwise(F.coalesce(http | curl, F.lit(False))))
    way = F.coalesce("via", F.lit("http"))
    # the file fetched directly goes before the second way; of equal ones the least
    first = F.min(F.struct("rank", (way != "http").alias("second"), "url", "strategy", "content_type", "content", way.alias("via")))
    won = ok.groupBy("domain").agg(first.alias("w")).select("domain", "w.*")
    path = file_name(F.col("domain"), F.col("url"), F.col("content_type"), F.col("via"))
    kept = stored_content(F.col("url"), F.col("content_type"), F.col("content"), F.col("via"))
    return won.select("domain", "url", "strategy", path.alias("path"), kept.alias("content"))


def attempt_rendered(found: DataFrame, downloads: DataFrame) -> DataFrame:
    """(domain, url, strategy, path, content) of the best rendered candidate of each domain (domain, url, strategy), with a file or without.

    The browser's rules are looser: an inline image of more than 100 bytes, or any file of status 200 above 200 bytes.
    """
    joined = found.join(downloads.select("domain", "url", "http_status", "content_type", "content"), ["domain", "url"], "left")
    inline = F.col("url").startswith("data:image/svg+xml;base64,")
    kept = stored_content(F.col("url"), F.col("content_type"), F.col("content"), F.lit("browser"))
    good = F.when(inline, F.octet_length(kept) > V.BROWSER_LEAST_SVG).otherwise((F.col("http_status") == 200) & (F.octet_length("content") > V.LEAST_BYTES))
    path = F.when(F.coalesce(good, F.lit(False)), file_name(F.col("domain"), F.col("url"), F.col("content_type"), F.lit("browser")))
    held = joined.select("domain", "url", "strategy", path.alias("path"), F.when(path.isNotNull(), kept).alias("content"))
    # repeated downloads of one address: one with a file, the least
    return held.groupBy("domain", "url", "strategy").agg(F.min(F.struct(F.col("path").isNull().alias("none"), "path", "content")).alias("r")).select("domain", "url", "strategy", "r.path", "r.content")


def saved_files(saved: DataFrame) -> DataFrame:
    """K3: (name, content) for ``write_files``."""
    return saved.where(F.col("path").isNotNull()).select(F.col("path").alias("name"), "content")


def result_rows(domains: DataFrame, winners: DataFrame, saved: DataFrame, favicons: DataFrame) -> DataFrame:
    """LogoResult rows (F22): a spare that could be fetched replaces address, strategy and path but not the score; the last resort is a favicon.

    ``winners``: (domain, url, score, strategy); ``saved``: of ``attempt_downloads``; ``favicons``: (domain, path) of fetched last resorts.
    """
    w = winners.select("domain", F.col("url").alias("w_url"), F.col("strategy").alias("w_strategy"), F.col("score").alias("w_score"))
    s = saved.select("domain", F.col("url").alias("s_url"), F.col("strategy").alias("s_strategy"), F.col("path").alias("s_path"))
    f = favicons.select("domain", F.col("path").alias("f_path"))
    rows = domains.join(w, "domain", "left").join(s, "domain", "left").join(f, "domain", "left")
    last = F.col("s_path").isNull() & F.col("f_path").isNotNull()
    icon = F.concat(F.lit("https://www.google.com/s2/favicons?domain="), F.col("domain"), F.lit("&sz=128"))
    return rows.select(
        "domain",
        F.when(last, icon).otherwise(F.coalesce("s_url", "w_url")).alias("logo_url"),
        F.when(last, "google_favicon_fallback").otherwise(F.coalesce("s_strategy", "w_strategy")).alias("source_strategy"),
        F.coalesce("s_path", "f_path").alias("downloaded_path"),
        F.when(F.col("w_url").isNull() & F.col("f_path").isNull(), "no_logo_found").alias("error"),
        F.coalesce("w_score", F.lit(0)).alias("_best_score"))


def retry_class(url: Column, strategy: Column, path: Column, error: Column, file_bytes: Column | None = None) -> Column:
    """'failed', 'weak' or null. A file of unknown size is weak only by strategy or extension; empty strings count as missing."""
    there = lambda c: F.coalesce(c != "", F.lit(False))
    small = F.coalesce(strategy.isin(*V.WEAK_IF_SMALL) & (file_bytes < V.WEAK_BYTES), F.lit(False)) if file_bytes is not None else F.lit(False)
    weak = small | path.endswith(".ico") | F.coalesce(strategy.isin(*V.WEAK_ALWAYS), F.lit(False))
    return F.when(there(error) | ~there(url), "failed").when(there(path) & weak, "weak")


def override(results: DataFrame, retried: DataFrame, keep_best: bool = False) -> DataFrame:
    """A retried row replaces the first one entirely, even if it has no file; ``keep_best`` keeps a first row with a file then."""
    cols = [c for c in results.columns if c != "domain"]
    other = retried.select("domain", F.struct(*cols).alias("__new"))
    joined = results.join(other, "domain", "left")
    take = F.col("__new").isNotNull()
    if keep_best:
        take = take & (F.coalesce(F.col("__new.downloaded_path") != "", F.lit(False)) | ~F.coalesce(F.col("downloaded_path") != "", F.lit(False)))
    return joined.select("domain", *(F.when(take, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) for c in cols))
