"""Queries of problem 6. SQL can't read the notations; the operator is tested against brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from crestline.llm.notation import notation_copies
from crestline.plans.session import table


def _copies(spark, folder):
    return notation_copies(table(spark, folder, "raw_results"), "record_id", "raw_text")


def p6_found(spark, folder):
    """Every copy with the first record of its group."""
    return _copies(spark, folder).where("id <> first_id").select(F.col("first_id").alias("first_record_id"), F.col("id").alias("record_id"))


def p6_records(spark, folder):
    """Every record once, by its first copy, with the number of its copies."""
    return _copies(spark, folder).where("id = first_id").select(F.col("first_id").alias("first_record_id"), "copies")


QUERIES = {"p6_found": p6_found, "p6_records": p6_records}
SQL: dict[str, str] = {}
