"""Queries of the subpackage against their SQL on the smallest tables."""

import os
import pathlib

import pytest

from crestline.llm.catalogue import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.01"


def stored(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def subclusters(spark, df):
    """As many members as the clusters have, and each sub-cluster within one of them."""
    rows, whole = df.collect(), QUERIES["p3_found"](spark, FOLDER).collect()
    assert sum(r.members for r in rows) == len(whole) and {r.group_ord for r in rows} == {r.first_ord for r in whole}
    of = {r.ord: r.first_ord for r in whole}
    assert all(of[r.first_ord] == of[r.typical_ord] == r.group_ord for r in rows)


def copies(spark, df):
    rows = df.collect()
    assert len(rows) == len({r.record_id for r in rows}) > 0 and all(r.first_record_id < r.record_id for r in rows)
    firsts = {r.first_record_id for r in rows}
    assert not firsts & {r.record_id for r in rows}


def records(spark, df):
    """Every text is a copy of one record."""
    rows = df.collect()
    assert sum(r.copies for r in rows) == stored(spark, "raw_results").where("record_id is not null and raw_text is not null").count()
    assert sum(r.copies - 1 for r in rows) == QUERIES["p6_found"](spark, FOLDER).count()


def sequences(spark, df):
    """Every page whole and once, nothing beyond the capacity, no two at one place."""
    rows = df.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in stored(spark, "documents").select("doc_id").collect()}
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence or 0, r.offset or 0)):
        if r.n_tokens:
            assert r.offset == filled.get(r.sequence, 0)
            filled[r.sequence] = r.offset + r.n_tokens
    assert max(filled.values()) <= 2048 and sum(filled.values()) > 0.9 * 2048 * len(filled)


def fill(spark, df):
    assert sum(r.tokens for r in df.collect()) == sum(r.n_tokens or 0 for r in QUERIES["p7_sequences"](spark, FOLDER).collect())


def leaks(spark, df):
    """Pages and items that exist, each pair once, and the same pages as have spans."""
    rows = df.collect()
    assert rows and len(rows) == len(set(rows)) and {r.item_id for r in rows} <= {r.item_id for r in stored(spark, "eval_items").collect()}
    assert {r.doc_id for r in rows} == {r.doc_id for r in QUERIES["p8_spans"](spark, FOLDER).collect()}


def spans(spark, df):
    size = {r.doc_id: len(r.text) for r in stored(spark, "documents").where("text is not null").collect()}
    rows = df.collect()
    assert rows and all(0 <= r.first_char < r.end_char <= size[r.doc_id] and r["items"] >= 1 for r in rows)


def stretches(spark, df):
    """Every page that is not blank, cut from its start to its end."""
    pages = {}
    for r in df.collect():
        pages.setdefault(r.doc_id, []).append(r)
    assert set(pages) == {r.doc_id for r in stored(spark, "documents").where("length(trim(text)) > 0").collect()}
    for own in pages.values():
        own.sort(key=lambda r: r.seg_no)
        assert [r.seg_no for r in own] == list(range(1, len(own) + 1)) and all(a.lang != b.lang for a, b in zip(own, own[1:]))


def languages(spark, df):
    rows = {(r.doc_id, r.seg_no, r.lang) for r in df.collect()}
    assert rows and rows <= {(r.doc_id, r.seg_no, r.lang) for r in QUERIES["p9_stretches"](spark, FOLDER).collect()}


def likeness(spark, df):
    """Neighbours on the curve are of one language far more often than by chance. The smallest table has four blocks only, too few to tell."""
    row = df.first()
    assert row.pairs > 0 and 0 < row.share <= 1
    if os.path.exists(LARGER):
        row = QUERIES["p7_likeness"](spark, LARGER).first()
        assert row.share > 1.7 * row.by_chance


KNOWN = {"p7_likeness": likeness, "p3_subclusters": subclusters, "p6_found": copies, "p6_records": records, "p7_sequences": sequences, "p7_fill": fill, "p8_found": leaks, "p8_spans": spans, "p9_stretches": stretches, "p9_found": languages}


@pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(small, name):
    df = QUERIES[name](small, FOLDER)
    if name not in SQL:
        KNOWN[name](small, df)
        return
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for p in pathlib.Path(FOLDER).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.sql(SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    at = {c: i for i, c in enumerate(want.columns)}
    assert sorted(repr([r[c] for c in cols]) for r in df.collect()) == sorted(repr([r[at[c]] for c in cols]) for r in want.fetchall())
