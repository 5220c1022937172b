"""Small text predicates as Column expressions; all stay inside generated code."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pattern_of(tokens: list[str]) -> str:
    """Java pattern that matches any of the tokens literally."""
    return "|".join(re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", t) for t in tokens)


def has_any(text: Column, tokens: list[str]) -> Column:
    """True if the text contains one of the tokens; false for null."""
    return F.coalesce(text.rlike(pattern_of(tokens)), F.lit(False))


def has(text: Column, token: str) -> Column:
    return F.coalesce(text.contains(token), F.lit(False))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def low(c: Column) -> Column:
    return F.lower(text_or_empty(c))


def any_of(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def points(cond: Column, n: int) -> Column:
    return F.when(cond, n).otherwise(0)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def bound(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once and stands once in the plan, however often ``body`` looks at it."""
    return F.get(F.transform(F.array(value), body), 0)


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns behind a generator, which filters are not pushed through: long expressions are evaluated once, not once per use."""
    row = F.array(F.struct(*(c.alias(n) for n, c in columns.items())))
    return df.drop(*columns).select("*", F.inline(row))
