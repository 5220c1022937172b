"""Records that differ only in notation: one canonical key each, copies counted."""

from __future__ import annotations

import ast
import hashlib
import json
import re
import unicodedata
from decimal import Context, Decimal, InvalidOperation

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crestline.plans.scratch import Scratch

TEXT_FIELDS = ("logo_url", "source_strategy", "downloaded_path", "error")
NUMBER_FIELDS = ("http_status", "extraction_time_ms", "_best_score")

_EXACT = Context(prec=10_000)
# fixed values: characters without a shape that Unicode counts as letters, marks or symbols
_SHAPELESS = frozenset(map(chr, (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x2800, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10))))
_PAIR = re.compile(r"""\s*,?\s*(?:"((?:[^"\\]|\\.)*)"|'((?:[^'\\]|\\.)*)'|([^\s:,'"{}]+))\s*:\s*(?:"((?:[^"\\]|\\.)*)"|'((?:[^'\\]|\\.)*)'|([^,}]*))""", re.S)


def _unescape(s: str) -> str:
    try:
        return json.loads('"' + s.replace('\\"', '"').replace('"', '\\"') + '"')
    except ValueError:
        return s


def _loose(body: str) -> dict | None:
    """Name and value pairs with any quoting or none; None if the text is nothing of the kind."""
    at, out = 1, {}
    while m := _PAIR.match(body, at):
        bare = (m[6] or "").strip()
        name = next(x for x in m.groups()[:3] if x is not None)
        quoted = m[4] if m[4] is not None else m[5]
        out[name] = _unescape(quoted) if quoted is not None else None if bare.lower() in ("null", "none", "") else bare
        at = m.end()
    return out if out and body[at:].strip(" \t\r\n,") == "}" else None


def parse_record(text: str) -> dict | None:
    """Fields by lower-case name, from a JSON object, a Python dict literal or loosely quoted pairs between the first and the last brace."""
    a, b = text.find("{"), text.rfind("}")
    if a < 0 or b < a:
        return None
    body = text[a : b + 1]
    try:
        got = json.loads(body, parse_int=str, parse_float=str, strict=False)
    except (ValueError, RecursionError):
        try:
            got = ast.literal_eval(body)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            got = _loose(body)
    return {str(k).strip().lower(): v for k, v in got.items()} if isinstance(got, dict) else None


def host_key(value) -> str:
    """A host without white space and invisible characters anywhere, case, and punctuation around it."""
    s = "".join(c for c in str(value) if c.isascii() and c > " " and c != "\x7f" or not c.isascii() and c not in _SHAPELESS and unicodedata.category(c)[0] not in "ZC")
    s = s.lower()
    a, b = 0, len(s)
    while a < b and not s[a].isalnum():
        a += 1
    while b > a and not s[b - 1].isalnum():
        b -= 1
    return s[a:b]


def _text_key(value) -> str:
    return value if isinstance(value, str) else json.dumps(value, sort_keys=True, default=str)


def _number_key(value) -> str:
    try:
        n = Decimal(str(value).strip()) if not isinstance(value, bool) else Decimal(int(value))
        if n.is_finite():
            return "n" + str(_EXACT.plus(_EXACT.normalize(n)))
    except InvalidOperation:
        pass
    return "s" + _text_key(value)


def canonical_key(text: str) -> bytes:
    """Equal for copies only. A text that is no record equals only the same text."""
    fields = parse_record(text)
    if fields is None:
        parts = ["raw", text]
    else:
        empty = lambda v: v is None or v == ""
        parts = ["" if empty(fields.get("domain")) else host_key(fields["domain"])]
        parts += ["" if empty(fields.get(f)) else "t" + _text_key(fields[f]) for f in TEXT_FIELDS]
        parts += ["" if empty(fields.get(f)) else _number_key(fields[f]) for f in NUMBER_FIELDS]
    h = hashlib.sha256()
    for p in parts:
        raw = p.encode("utf-8", "surrogatepass")
        h.update(len(raw).to_bytes(8, "big") + raw)
    return h.digest()


def _keys(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([canonical_key(t) for t in batch.column(1).to_pylist()], pa.binary())], names=["id", "key"])


MOST_ROWS, MOST_HOT = 1_000_000, 10_000  # rows of a key that one task may hold; hot keys that are broadcast at most


def notation_copies(records: DataFrame, id_col: str, text_col: str, hot_share: float = 0.001) -> DataFrame:
    """(id, first_id, copies): for every record the smallest id of its group and the size of the group.

    Rows with a null id or text are left out. Partial counts find the keys that hold more than ``hot_share`` of all
    rows or more than MOST_ROWS (at most 1 / hot_share or MOST_HOT keys, so they may be broadcast); those are salted into a
    two-level aggregation, the rest needs one shuffle. Extra columns are ignored; an empty table gives no row.
    """
    cut = Scratch(records.sparkSession, "notation")
    texts = records.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).dropna()
    rows = cut.cut(texts.mapInArrow(_keys, f"id {dict(texts.dtypes)['id']}, key binary"))
    total = rows.count()
    least = min(hot_share * total, max(MOST_ROWS, total / MOST_HOT))
    hot = cut.cut(rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > least).select("key"))
    warm = rows.join(F.broadcast(hot), "key")
    salted = warm.groupBy("key", F.pmod(F.xxhash64("id"), F.lit(64)).alias("salt")).agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    best = salted.groupBy("key").agg(F.min("first_id").alias("first_id"), F.sum("copies").alias("copies"))
    by_key = W.partitionBy("key")
    usual = rows.join(F.broadcast(hot), "key", "left_anti").select("id", F.min("id").over(by_key).alias("first_id"), F.count(F.lit(1)).over(by_key).alias("copies"))
    return usual.unionByName(rows.join(F.broadcast(best), "key").select("id", "first_id", "copies"))
