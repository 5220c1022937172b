"""Queries of problem 9. SQL can't express the operator; it is tested on held-out texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from crestline.llm.langid import fit_filters, label_language, language_stretches
from crestline.plans.session import table


def p9_stretches(spark, folder):
    """Every stretch of every page with its language and confidence."""
    docs = table(spark, folder, "documents")
    return language_stretches(docs, "doc_id", "text", fit_filters(docs, "doc_id", "text", "lang")).withColumnRenamed("id", "doc_id")


def p9_found(spark, folder):
    """Stretches of the pages that are mixed or whose label names no language or another than that of the text."""
    docs = table(spark, folder, "documents")
    # the label travels with the identifier: no join back
    both = docs.select(F.struct("doc_id", label_language(F.col("lang")).alias("label")).alias("id"), "text")
    got = language_stretches(both, "id", "text", fit_filters(docs, "doc_id", "text", "lang"))
    rows = got.select("id.doc_id", "id.label", "seg_no", "stretches", "lang")
    return rows.where((F.col("stretches") > 1) | (F.col("lang").isNotNull() & ~F.col("lang").eqNullSafe(F.col("label")))).select("doc_id", "seg_no", "lang")


QUERIES = {"p9_found": p9_found, "p9_stretches": p9_stretches}
SQL: dict[str, str] = {}
