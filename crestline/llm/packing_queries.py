"""Queries of problem 7. SQL can't tokenize; the operator is tested by an exact round trip."""

from __future__ import annotations

from pyspark.sql import functions as F

from crestline.llm.langid import label_language
from crestline.llm.packing import pack_documents
from crestline.plans.session import table


def p7_sequences(spark, folder):
    """Every page with its sequence of 2,048 tokens and its offset there."""
    return pack_documents(table(spark, folder, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def p7_fill(spark, folder):
    """How many sequences are filled to which twentieth."""
    used = p7_sequences(spark, folder).groupBy("sequence").agg(F.sum("n_tokens").alias("used"))
    return used.groupBy(F.floor(F.col("used") * 20 / 2048).alias("twentieth")).agg(F.count(F.lit(1)).alias("sequences"), F.sum("used").alias("tokens"))


def p7_likeness(spark, folder):
    """Of all pairs of labelled pages in one sequence, how many are of one language, and how many would be in random order."""
    labels = table(spark, folder, "documents").select("doc_id", label_language(F.col("lang")).alias("lang")).dropna()
    pages = p7_sequences(spark, folder).where("n_tokens > 0 and part = 0").select("doc_id", "sequence").join(labels, "doc_id")
    pairs = lambda n: n * (n - 1) / 2
    counts = pages.groupBy("sequence", "lang").agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy("sequence").agg(F.sum(pairs(F.col("n"))).alias("same"), F.sum("n").alias("n")).agg(F.sum("same").alias("same"), F.sum(pairs(F.col("n"))).alias("pairs"))
    # seven languages
    whole = counts.groupBy("lang").agg(F.sum("n").alias("n")).agg((F.sum(pairs(F.col("n"))) / pairs(F.sum("n"))).alias("by_chance"))
    return per.withColumn("one", F.lit(1)).join(whole.withColumn("one", F.lit(1)), "one").select("pairs", (F.col("same") / F.col("pairs")).alias("share"), "by_chance")


QUERIES = {"p7_sequences": p7_sequences, "p7_fill": p7_fill, "p7_likeness": p7_likeness}
SQL: dict[str, str] = {}
