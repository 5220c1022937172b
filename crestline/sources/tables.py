"""Readers (S1-S3, S13) with fixed schemas; what the network or a browser would deliver comes as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.text import has
from crestline.functions.urls import user_agent_no

LOGO_RESULT = "domain string, logo_url string, source_strategy string, downloaded_path string, error string, http_status int, extraction_time_ms int, _best_score int"
ATTEMPTS = "domain string, attempt int, variant int, scheme int, http_status int, html string, final_url string"


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    """(domain, ord) of a parquet folder; only ``domain`` is read. Rows of one file keep their order, files go by name."""
    rows = spark.read.parquet(path).select("domain", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    files = rows.select("f").distinct().withColumn("n", F.row_number().over(W.orderBy("f")) - 1)  # one row per file
    return rows.join(files, "f").select("domain", (F.col("n").cast("long") * F.lit(1 << 40) + F.col("i")).alias("ord"))


def read_results(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """LogoResult rows of a JSON array, or of JSON lines, which can be split among tasks."""
    return spark.read.schema(LOGO_RESULT).option("multiLine", not lines).json(path)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded raster images (path, height, width, channels, data); files that can't be decoded are dropped."""
    rows = spark.read.format("image").option("dropInvalid", True).load(path).select("image.*")
    return rows.where("width > 0").select(F.col("origin").alias("path"), "height", "width", F.col("nChannels").alias("channels"), "data")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Existing files with size and digest of their bytes."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), F.md5("content").alias("digest"))


def fetch_plan(domains: DataFrame) -> DataFrame:
    """S3: (domain, attempt, variant, scheme, url, agent): the requests for the page of each domain, in the order they are to be tried.

    Three attempts over the host, then the host with www. in front (unless it has that), each by https, then http; an agent per domain.
    """
    hosts = F.when(F.col("domain").startswith("www."), F.array("domain")).otherwise(F.array(F.col("domain"), F.concat(F.lit("www."), F.col("domain"))))
    tries = domains.where("domain is not null").select("domain", F.explode(F.sequence(F.lit(0), F.lit(V.FETCH_ATTEMPTS - 1))).alias("attempt"), hosts.alias("hosts"))
    tries = tries.select("domain", "attempt", F.posexplode("hosts").alias("variant", "host"))
    tries = tries.select("domain", "attempt", "variant", "host", F.posexplode(F.array(*map(F.lit, V.FETCH_SCHEMES))).alias("scheme", "way"))
    return tries.select("domain", "attempt", "variant", "scheme", F.concat("way", F.lit("://"), "host").alias("url"), user_agent_no(F.col("domain")).alias("agent"))


def first_pages(attempts: DataFrame) -> DataFrame:
    """S3: the page of each domain out of its attempts, tried in the order attempt, host variant, scheme.

    Status 200 is always taken; some refusals are taken if they carry a real page. A 200 without a body ends the schemes of its
    variant. Domains without any page come out with ``html`` null and their last status.
    """
    page = (F.length("html") > 0) & ((F.col("http_status") == 200) | (F.col("http_status").isin(*V.FETCH_STATUSES) & (F.length("html") > V.FETCH_LEAST_CHARS) & has(F.substring("html", 1, V.FETCH_HEAD), "<")))
    empty = (F.col("http_status") == 200) & (F.coalesce(F.length("html"), F.lit(0)) == 0)
    tries = W.partitionBy("domain", "attempt", "variant").orderBy("scheme").rowsBetween(W.unboundedPreceding, -1)
    rows = attempts.withColumn("ended", F.coalesce(F.bool_or(empty).over(tries), F.lit(False))).where("not ended").withColumn("page", F.coalesce(page, F.lit(False)))
    at = F.struct("attempt", "variant", "scheme")
    return rows.groupBy("domain").agg(
        F.min_by(F.when(F.col("page"), F.struct("html", "final_url", "http_status")), F.when(F.col("page"), at)).alias("p"), F.max_by("http_status", F.when(F.col("http_status").isNotNull(), at)).alias("last")
    ).select("domain", F.col("p.html").alias("html"), F.col("p.final_url").alias("base_url"), F.coalesce("p.http_status", "last").alias("http_status"))
