"""Entry 1 as one plan: pages to LogoResult rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crestline.operators.candidates import ranked, source_candidates, with_order
from crestline.operators.dom import page_elements
from crestline.operators.downloads import attempt_downloads, result_rows
from crestline.operators.strategies import manifest_icons, open_pages, page_candidates
from crestline.plans.scratch import Scratch


def extract_candidates(pages: DataFrame, probes: DataFrame | None = None, manifests: DataFrame | None = None, compat_manifest: bool = False) -> DataFrame:
    """(domain, strategy, idx, url, score, pos) of all candidates of pages (domain, base_url, html), one row per domain.

    Pages are parsed once: the elements are a written table that all strategies read. Manifest icons are off unless asked for.
    """
    cut = Scratch(pages.sparkSession, "extract")
    elements = cut.cut(page_elements(pages))
    opened = open_pages(pages.select("domain", "base_url", "html"), elements)
    # written once: none of the strategies needs the pages themselves
    bases = cut.cut(opened.select(F.col("domain").alias("page"), "base_url", "domain"))
    found = page_candidates(elements, bases).withColumnRenamed("page", "domain")
    if compat_manifest and manifests is not None:
        icons = manifest_icons(manifests).select(F.col("page").alias("domain"), F.lit("manifest").alias("strategy"), F.col("idx").cast("long").alias("idx"), "url", F.col("score").cast("int").alias("score"))
        found = found.unionByName(icons)
    found = found.select("domain", "strategy", "idx", "url", "score")
    if probes is not None:
        found = cut.cut(found)
        found = found.unionByName(source_candidates(probes, bases.select("domain"), found))
    return with_order(found)


def extract(domains: DataFrame, pages: DataFrame, downloads: DataFrame, probes: DataFrame | None = None, favicons: DataFrame | None = None) -> DataFrame:
    """LogoResult rows of all domains; ``favicons``: (domain, path) of last resorts that could be fetched."""
    cut = Scratch(pages.sparkSession, "results")
    top = cut.cut(ranked(extract_candidates(pages, probes)))
    winners = top.where("rank = 1")
    saved = attempt_downloads(top, downloads)
    last = favicons if favicons is not None else domains.select("domain", F.lit(None).cast("string").alias("path")).limit(0)
    return result_rows(domains.select("domain"), winners, saved, last)


