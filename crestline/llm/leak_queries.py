"""Queries of problem 8. SQL can't express the operator; it is tested against brute force on planted passages."""

from __future__ import annotations

from pyspark.sql import functions as F

from crestline.llm.leaks import leaked_items, removal_spans
from crestline.plans.session import table


def _leaks(spark, folder):
    return leaked_items(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "passage")


def p8_found(spark, folder):
    """Pages with the items they give away."""
    # the stretches of a page and item come from one task, next to each other
    return _leaks(spark, folder).select(F.col("id").alias("doc_id"), F.col("item").alias("item_id")).distinct()


def p8_spans(spark, folder):
    """Spans to remove from every page."""
    return removal_spans(_leaks(spark, folder)).withColumnRenamed("id", "doc_id")


QUERIES = {"p8_found": p8_found, "p8_spans": p8_spans}
SQL: dict[str, str] = {}
