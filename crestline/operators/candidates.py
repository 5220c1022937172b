"""Candidates to winners."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crestline.functions import fixed_values as V


def distinct_domains(domains: DataFrame, ord_col: str = "ord") -> DataFrame:
    """(ord, domain): every non-null domain once, by its first appearance. Values are not folded."""
    return domains.where(F.col("domain").isNotNull()).groupBy("domain").agg(F.min(ord_col).alias("ord"))


def first_domains(domains: DataFrame, n: int) -> DataFrame:
    """The first ``n`` distinct domains in input order: a top-k, not a full sort."""
    return distinct_domains(domains).orderBy("ord").limit(n)


def with_order(candidates: DataFrame) -> DataFrame:
    """Adds ``pos``: (rank of the strategy, place within it); unknown strategies come last."""
    rank = reduce(lambda w, kv: w.when(F.col("strategy") == kv[1], kv[0]), enumerate(V.STRATEGY_ORDER), F).otherwise(len(V.STRATEGY_ORDER))
    return candidates.withColumn("pos", F.struct(rank.alias("rank"), F.col("idx")))


def best_per_address(candidates: DataFrame, key: str = "domain") -> DataFrame:
    """One row per key and address: the highest score, of equal ones the first; ``first_pos`` keeps the first place of the address.

    Two combining aggregates, no window: a key with a third of all candidates is pre-aggregated by every task. ``pos`` may be
    anything that has an order.
    """
    best = F.min(F.struct((-F.col("score")).alias("less"), "pos", "score", "strategy"))
    return candidates.groupBy(key, "url").agg(best.alias("b"), F.min("pos").alias("first_pos")).select(key, "url", F.col("b.score").alias("score"), F.col("b.strategy").alias("strategy"), "first_pos")


def ranked(candidates: DataFrame, key: str = "domain", keep: int = V.SPARES + 1) -> DataFrame:
    """The best ``keep`` addresses of each key, ``rank`` from 1: by score, then by first place. The limit is pushed below the shuffle."""
    order = W.partitionBy(key).orderBy(F.desc("score"), "first_pos")
    return best_per_address(candidates, key).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def best(candidates: DataFrame, key: str = "domain") -> DataFrame:
    """The winner of each key. An aggregate instead of a sort."""
    top = F.min(F.struct((-F.col("score")).alias("less"), "first_pos", "url", "score", "strategy"))
    return best_per_address(candidates, key).groupBy(key).agg(top.alias("t")).select(key, "t.url", "t.score", "t.strategy")


def source_candidates(probes: DataFrame, pages_open: DataFrame, found: DataFrame) -> DataFrame:
    """Candidates of sources other than pages (S5-S9): ``probes`` has (domain, strategy, url, bytes) of successful requests.

    WordPress counts only for domains without a page, DuckDuckGo only for domains without any other candidate.
    """
    score = reduce(lambda w, kv: w.when(F.col("strategy") == kv[0], kv[1]), V.SOURCE_SCORES.items(), F)
    wp = F.col("strategy").startswith("wp_json")
    rows = probes.withColumn("score", score).where(F.col("score").isNotNull() & (wp | (F.col("bytes") > V.LEAST_BYTES)))
    rows = rows.where(~F.col("strategy").isin("wp_json_icon") | F.col("url").startswith("http"))
    usual = rows.where(~wp & (F.col("strategy") != "duckduckgo_icon"))
    wordpress = rows.where(wp).join(pages_open.select("domain"), "domain", "left_anti")
    so_far = reduce(DataFrame.unionByName, [usual.select("domain"), wordpress.select("domain"), found.select("domain")])
    duck = rows.where("strategy = 'duckduckgo_icon'").join(so_far, "domain", "left_anti")
    return reduce(DataFrame.unionByName, [usual, wordpress, duck]).select("domain", "strategy", F.lit(0).cast("long").alias("idx"), "url", "score")


def wordpress_candidates(roots: DataFrame, media: DataFrame) -> DataFrame:
    """(domain, strategy, url, bytes), the probes that a WordPress site gives. ``roots``: (domain, body) of its service's root,
    ``media``: (domain, media_id, body) of media entries that were fetched. The logo is the address of the entry that the root names by a
    whole number; the icon is in the root itself. Bodies that are no objects, and of one domain and entry all but one, give nothing.
    """
    doc, entry = F.try_parse_json("body"), F.try_parse_json("body")
    text = lambda c, k: F.when(F.schema_of_variant(F.try_variant_get(c, f"$.{k}", "variant")) == "STRING", F.try_variant_get(c, f"$.{k}", "string"))
    number = F.when(F.schema_of_variant(F.try_variant_get(doc, "$.site_logo", "variant")) == "BIGINT", F.try_variant_get(doc, "$.site_logo", "long"))
    sites = roots.select("domain", number.alias("media_id"), text(doc, "site_icon_url").alias("icon"))
    logos = media.select("domain", F.col("media_id").cast("long").alias("media_id"), text(entry, "source_url").alias("url")).where("url <> ''").groupBy("domain", "media_id").agg(F.min("url").alias("url"))
    found = sites.where("media_id > 0").join(logos, ["domain", "media_id"]).select("domain", F.lit("wp_json_logo").alias("strategy"), "url")
    icons = sites.where(F.col("icon").startswith("http")).select("domain", F.lit("wp_json_icon").alias("strategy"), F.col("icon").alias("url"))
    return found.unionByName(icons).distinct().withColumn("bytes", F.lit(0))
