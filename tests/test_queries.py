"""Queries against their SQL on the smallest tables, as the driver does."""

import math
import os
import pathlib

import pytest

from crestline.plans.catalogue import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for p in pathlib.Path(FOLDER).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    return float(v) if isinstance(v, int) and not isinstance(v, bool) else v


def same_rows(df, relation):
    cols = sorted(df.columns)
    assert cols == sorted(relation.columns)
    at = {c: i for i, c in enumerate(relation.columns)}
    ours = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    theirs = sorted(repr([plain(r[at[c]]) for c in cols]) for r in relation.fetchall())
    assert ours == theirs


def hundred_groups(df):
    """Single linkage stops at a hundred groups, each named by its least row."""
    rows = {r.ord: r.component for r in df.collect()}
    assert len(set(rows.values())) == min(100, len(rows)) and all(rows[c] == c <= o for o, c in rows.items())


KNOWN = {"single_linkage_groups": hundred_groups}


@pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(small, duck, name):
    df = QUERIES[name](small, FOLDER)
    if name in SQL:
        same_rows(df, duck.sql(SQL[name]))
    else:
        KNOWN[name](df)


def test_llm_is_optional():
    """Nothing outside the subpackage imports it."""
    root = pathlib.Path(__file__).parent.parent / "crestline"
    for p in root.rglob("*.py"):
        if p.relative_to(root).parts[0] != "llm":
            assert "crestline.llm" not in p.read_text(), p
