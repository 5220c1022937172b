import json
import random

import pytest

from pyspark.sql import functions as F

from crestline.llm.notation import canonical_key, host_key, notation_copies, parse_record
from crestline.llm.survivors import Bundle, consistent_survivors

REC = {"domain": "my-shop.co.test", "logo_url": "https://my-shop.co.test/L.png", "source_strategy": "img_tag", "downloaded_path": "logos/x.png", "error": None, "http_status": 200, "extraction_time_ms": 1500, "_best_score": 7}


def variants(rec, r):
    """Texts that are all the same record."""
    d = dict(rec)
    host = rec["domain"]
    d["domain"] = r.choice([host, host.upper(), f"  {host}\t", f"({host})", f"'{host}.'", host.replace(".", " ."), host[:3] + "​" + host[3:], host[:2] + "\xad" + host[2:], f"• {host};", f"\xab{host}\xbb"])
    for k in ("http_status", "extraction_time_ms", "_best_score"):
        d[k] = r.choice([rec[k], float(rec[k]), str(rec[k]), f"{rec[k]}.00"])
    for k in list(d):
        if d[k] is None:
            d[k] = r.choice([None, ""])
            if r.random() < 0.4:
                del d[k]
    items = list(d.items())
    r.shuffle(items)
    items = [(k.capitalize() if r.random() < 0.3 else k, v) for k, v in items]
    form = r.randrange(4)
    if form == 0:
        text = json.dumps(dict(items), indent=r.choice([None, 2]))
    elif form == 1:
        text = json.dumps(dict(items), separators=(",", ":")).replace("/", "\\/")
    elif form == 2:
        text = repr(dict(items))
    else:
        text = "{" + ", ".join(f"{k}: {json.dumps(v)}" for k, v in items) + "}"
    return r.choice(["", "\n", "  ", "\t"]) + text + r.choice(["", ",", " ", "\n"])


def test_all_notations_have_one_key():
    r = random.Random(4)
    assert len({canonical_key(variants(REC, r)) for _ in range(300)}) == 1


def test_what_merely_looks_alike():
    base = canonical_key(json.dumps(REC))
    for k, v in (("domain", "myshop.co.test"), ("domain", "my-shop.cotest"), ("domain", "www.my-shop.co.test"), ("logo_url", REC["logo_url"].lower()), ("source_strategy", "img_tag "), ("http_status", None), ("http_status", 0), ("_best_score", 70), ("error", "x"), ("extraction_time_ms", 1500.5)):
        assert canonical_key(json.dumps({**REC, k: v})) != base, k
    assert canonical_key("no record") != canonical_key("no record ") and canonical_key("no record") == canonical_key("no record")
    assert canonical_key('{"http_status": 123456789012345678901234567890123}') != canonical_key('{"http_status": 123456789012345678901234567890124}')


def test_parse_odd_texts():
    assert parse_record("") is None and parse_record("}{") is None and parse_record("[1]") is None and parse_record("{1, 2}") is None
    assert parse_record("{'a': 'it\\'s', 'B': None}") == {"a": "it's", "b": None}
    assert parse_record('x {domain: "a.b", n: 1.50, e: null} y') == {"domain": "a.b", "n": "1.50", "e": None}
    assert canonical_key("{" * 5000) and canonical_key('{"domain": ' + "[" * 3000 + "]" * 3000 + "}")
    assert host_key(" ﻿A.B-c. Test. ") == "a.b-c.test" and host_key("...") == "" and host_key("aㅤb.test") == "ab.test"


def test_copies(small):
    r = random.Random(9)
    data, truth = [], {}
    for g in range(40):
        rec = {**REC, "domain": f"shop-{g}.test", "_best_score": g}
        for _ in range(60 if g == 0 else r.randrange(1, 4)):
            truth[len(data)] = g
            data.append((len(data), variants(rec, r), "f", b"k"))
    r.shuffle(data)
    first = {}
    for i in sorted(truth):
        first.setdefault(truth[i], i)
    for share in (0.001, 0.2, 1.0):  # all keys hot, one, none
        df = small.createDataFrame(data + [(None, "{}", "", b""), (999, None, "", b"")], "record_id long, raw_text string, id string, key binary")
        got = {x.id: (x.first_id, x.copies) for x in notation_copies(df, "record_id", "raw_text", hot_share=share).collect()}
        sizes = [list(truth.values()).count(truth[i]) for i in sorted(truth)]
        assert got == {i: (first[truth[i]], n) for i, n in zip(sorted(truth), sizes)}
    assert notation_copies(df.limit(0), "record_id", "raw_text").count() == 0


RECORD = "result_id long, domain string, source_strategy string, downloaded_path string, error string, extracted_at long, trust int, logo_url string, http_status int, group_id int"


def test_survivors_equal_brute_force(small):
    r = random.Random(2)
    recs = [(i, f"d{r.randrange(12)}" if r.random() < 0.9 else None, None, r.choice(["p", "q", "", None]), r.choice([None, "", "e"]), r.choice([None, 1, 2]), r.choice([None, 5, 9]), r.choice(["u", None]), r.choice([200, 404, None]), 77) for i in range(90)]
    members = [(1, 1, f"d{i}", "x") for i in range(5)] + [(1, 2, f"d{i}", "x") for i in range(5, 9)] + [(2, 1, "d9", "x"), (2, 1, "d9", "x"), (2, 1, None, "x"), (2, 2, "nobody", "x")]
    m, c = small.createDataFrame(members, "run_id long, group_id int, domain string, trust string"), small.createDataFrame(recs, RECORD)
    file = Bundle("file", ["result_id", "domain", "logo_url"], [F.col("trust"), F.col("extracted_at"), F.col("result_id")], (F.col("downloaded_path") != "") & (F.coalesce("error", F.lit("")) == ""))
    timing = Bundle("timing", ["http_status"], [(F.col("http_status") == 200).cast("int"), F.col("result_id")], F.col("http_status").isNotNull(), ["domain", "logo_url"])
    status = Bundle("status", ["http_status"], [F.col("result_id")], F.col("http_status").isNotNull(), ["logo_url"])
    low = lambda v: (v is not None, v or 0)
    want = {}
    for run, g in {(x[0], x[1]) for x in members}:
        own = {x[2] for x in members if x[:2] == (run, g) and x[2]}
        ok = [x for x in recs if x[1] in own and x[3] and not x[4]]
        if ok:
            w = max(ok, key=lambda x: (low(x[6]), low(x[5]), x[0]))
            t = [x for x in recs if x[1] == w[1] and x[7] == w[7] and x[8] is not None]
            s = [x for x in recs if x[1] in own and x[7] == w[7] and x[8] is not None]
            want[run, g] = (w[0], max(t, key=lambda x: (x[8] == 200, x[0]))[8] if t else None, max(s, key=lambda x: x[0])[8] if s else None)
    got = {(x.run_id, x.group_id): x for x in consistent_survivors(m, ["run_id", "group_id"], "domain", c, [file, timing]).collect()}
    other = {(x.run_id, x.group_id): x for x in consistent_survivors(m, ["run_id", "group_id"], "domain", c, [file, status]).collect()}
    assert {k: (v.result_id, v.http_status, other[k].http_status) for k, v in got.items()} == want
    assert consistent_survivors(m.limit(0), ["run_id", "group_id"], "domain", c, [file]).count() == 0
    assert consistent_survivors(m, ["run_id", "group_id"], "domain", c.limit(0), [file]).count() == 0


def test_ties_are_told_apart_by_later_bundles(small):
    """Two records tie in the first bundle; only one has an agreeing candidate for the second."""
    m = small.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (None, "a")], "g int, domain string")
    c = small.createDataFrame([("a", 5, "x", None), ("b", 5, "y", 3), ("c", 4, "z", 9)], "domain string, trust int, path string, score int")
    path = Bundle("path", ["domain", "path"], [F.col("trust")])
    score = Bundle("score", ["score"], [F.col("score")], F.col("score").isNotNull(), ["domain"])
    got = {r.g: (r.domain, r.path, r.score) for r in consistent_survivors(m, ["g"], "domain", c, [path, score]).collect()}
    assert got == {1: ("b", "y", 3), None: ("a", "x", None)}


def test_choice_within_a_source_waits_for_later_bundles(small):
    """Two files of one source tie; only the address of one has a timing."""
    m = small.createDataFrame([(1, "s")], "g int, domain string")
    c = small.createDataFrame([("s", "b", 5, None), ("s", "a", 5, None), ("s", "a", None, 7)], "domain string, url string, trust int, ms int")
    file = Bundle("file", ["domain", "url"], [F.col("trust")], F.col("trust").isNotNull())
    timing = Bundle("timing", ["ms"], [F.col("ms")], F.col("ms").isNotNull(), ["domain", "url"])
    assert [(r.url, r.ms) for r in consistent_survivors(m, ["g"], "domain", c, [file, timing]).collect()] == [("a", 7)]


@pytest.mark.parametrize("shared", [False, True])
def test_three_bundles_equal_brute_force(small, shared):
    """All combinations of candidates that agree, for groups with ties within a source and determinants that conflict."""
    for seed in (1, 2, 3):
        r = random.Random(seed)
        recs = [(f"d{r.randrange(9)}", r.choice("uv"), r.choice("xyz"), r.randrange(3), r.choice([None, 0, 1, 2]), r.choice([None, 0, 3, 4]), r.randrange(4)) for _ in range(120)]
        members = [(k % 3, f"d{k}") for k in range(9)]
        df = small.createDataFrame(recs, "domain string, url string, path string, a int, b int, c int, kind int")
        m = small.createDataFrame(members, "g int, domain string")
        one = Bundle("one", ["domain", "url"], [F.col("a")], F.col("kind") != 0, tiers=[0])
        two = Bundle("two", ["path", "b"], [F.col("b")], F.col("kind") != 1, ["domain", "url"], tiers=[0 if shared else 1])
        three = Bundle("three", ["c"], [F.col("c")], F.col("kind") != 2, ["path"], tiers=[1 if shared else 2])
        low = lambda v: -(1 << 55) if v is None else v
        got = {x.g: x for x in consistent_survivors(m, ["g"], "domain", df, [one, two, three]).collect()}
        for g in range(3):
            own = [x for x in recs if (g, x[0]) in members]
            best = None
            for x in own:
                if x[6] == 0:
                    continue
                for y in [y for y in own if y[6] != 1 and y[:2] == x[:2]] or [None]:
                    path = y[2] if y else None
                    for z in [z for z in own if z[6] != 2 and z[2] == path] or [None]:
                        parts = [low(x[3]), low(y[4]) if y else -(1 << 56), low(z[5]) if z else -(1 << 56)]
                        total = (parts[0] + parts[1], parts[2]) if shared else tuple(parts)
                        best = max(best, total) if best else total
            x = got[g]
            # the trust of what came out, by its fields
            y, z = [low(x.b) if x.path is not None else -(1 << 56), low(x.c)]
            a = max(q[3] for q in own if q[6] != 0 and q[:2] == (x.domain, x.url))
            assert not x.path or (x.domain, x.url, x.path, x.b) in {(q[0], q[1], q[2], q[4]) for q in own if q[6] != 1}
            assert ((a + y, z) if shared else (a, y, z)) == best or x.c is None
            if x.c is None:
                assert ((a + y,) if shared else (a, y)) == best[:-1]
