import itertools
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from crestline.functions.images import crop_to_content, hash_image, hash_pixels, is_low_contrast, resize, to_rgb
from crestline.operators.clustering import cluster_document, cluster_domains, exact_groups, group_members, preview, ranked_groups, representatives, size_bucket, size_histogram, summary, union_counts
from crestline.operators.components import connected_components, label_nodes, star_edges
from crestline.operators.linkage import minimum_forest, single_linkage
from crestline.operators.report import file_types, strategy_histogram, totals
from crestline.operators.joins import spread_join
from crestline.operators.ranks import numbered
from crestline.operators.similarity import gate, gate_pairs, hash_classes, similar_groups
from crestline.sources.sinks import results_document, write_cluster_document, write_cluster_files, write_files, write_results
from crestline.sources.tables import LOGO_RESULT, read_domains, read_files, read_images, read_results

HASH = "ord long, p long, d long"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def near_rows(n=60, seed=3):
    r = random.Random(seed)
    out, cores = [], [r.getrandbits(64) for _ in range(6)]
    for i in range(n):
        p = r.choice(cores) if r.random() < 0.8 else r.getrandbits(64)
        for _ in range(r.randrange(9)):
            p ^= 1 << r.randrange(64)
        out.append((i, signed(p), signed(r.getrandbits(3))))
    return out


def dist(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count()


def brute_components(nodes, edges):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_gate_cases(spark):
    df = spark.createDataFrame([(10, 64, True), (11, 10, True), (12, 10, True), (12, 11, False), (13, 0, False), (None, 0, False), (11, None, False), (10, None, True)], "p int, d int, e boolean")
    assert all(r.x == r.e for r in df.select("e", gate(F.col("p"), F.col("d")).alias("x")).collect())


@pytest.mark.parametrize("t", [(10, 12, 10), (18, 20, 20), (0, 0, 0)])
def test_gate_pairs_equal_brute_force(spark, t):
    rows = near_rows()
    df = spark.createDataFrame(rows + rows[:5] + [(99, None, 1)], HASH)
    members = {}
    for r in hash_classes(df).collect():
        members.setdefault(r["class"], []).append(r.k)
    got = {tuple(sorted((a, b))) for r in gate_pairs(df, "ord", t).collect() for a in members[r.i] for b in members[r.j]}
    got |= {pair for m in members.values() for pair in itertools.combinations(sorted(m), 2)}
    want = {(a[0], b[0]) for a, b in itertools.combinations(rows, 2) if dist(a[1], b[1]) <= t[0] or (dist(a[1], b[1]) <= t[1] and dist(a[2], b[2]) <= t[2])}
    assert got == want


def test_copies_are_one_member_of_pairs(small):
    """Equal hashes are joined by their class, in blocks where they are many."""
    rows = [(k, 5, 1) for k in range(3000)] + [(5000 + k, 5 ^ (1 << (k % 60)), k) for k in range(300)] + [(9000, None, 1), (None, 5, 1)]
    df = small.createDataFrame(rows, HASH)
    heads = {}
    for k, p, d in rows:
        if k is not None and p is not None:
            heads[p, d] = min(k, heads.get((p, d), k))
    want = {tuple(sorted((a, b))) for (p, d), a in heads.items() for (q, e), b in heads.items() if a < b and (dist(p, q) <= 10)}
    assert {(r.i, r.j) for r in gate_pairs(df, hot=50).collect()} == want
    assert {(r.k, r["class"]) for r in hash_classes(df).collect()} == {(k, heads[p, d]) for k, p, d in rows if k is not None and p is not None}
    assert {(r.node, r.component) for r in similar_groups(df, hot=50).collect()} == {(k, 0) for k, p, d in rows if k is not None and p is not None}
    assert similar_groups(df.limit(0)).count() == 0


def test_similar_groups_equal_brute_force(small):
    rows = near_rows(120, 11)
    edges = [(a[0], b[0]) for a, b in itertools.combinations(rows, 2) if dist(a[1], b[1]) <= 10 or (dist(a[1], b[1]) <= 12 and dist(a[2], b[2]) <= 10)]
    want = brute_components([r[0] for r in rows], edges)
    for hot in (3, 20_000):
        assert {r.node: r.component for r in similar_groups(small.createDataFrame(rows + rows[:9], HASH), hot=hot).collect()} == want


def test_hot_keys_are_spread(small):
    rows = small.createDataFrame([(None if k % 50 == 0 else "hot" if k % 3 else f"k{k}", k) for k in range(1000)], "key string, n long")
    table = rows.where("key is not null").groupBy("key").agg(F.min("n").alias("least"))
    for how in ("inner", "left"):
        want = sorted(map(str, rows.join(table, "key", how).collect()))
        assert sorted(map(str, spread_join(rows, table, ["key"], how, hot=100).collect())) == want
        assert sorted(map(str, spread_join(rows, table, ["key"], how).collect())) == want
    plan = spread_join(rows, table, ["key"], hot=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "broadcast" in plan


def test_hub_and_giant_group_with_hot_keys(small):
    """A hub of many leaves, and a chain into it: its neighbours are hot in every round."""
    edges = [(0, k) for k in range(1, 2000)] + [(2000 + k, 2001 + k) for k in range(20)] + [(2000, 1999), (5000, 5001)]
    df = small.createDataFrame([(a + 3, b + 3) for a, b in edges] + [(1999 + 3, 1)], "src long, dst long")
    got = {r.node: r.component for r in connected_components(df, hot=100).collect()}
    assert len(got) == 2000 + 21 + 2 + 1 and {v for k, v in got.items() if k < 5000} == {1} and got[5004] == 5003
    stars = small.createDataFrame([("u", k, k % 7) for k in range(500)] + [(None, 900, 1), ("v", 901, 1)], "key string, node long, o long")
    assert {(r.src, r.dst) for r in star_edges(stars, "key", "node", "o", hot=100).collect()} == {(0, k) for k in range(1, 500)}


def test_numbered_is_a_total_order(small):
    r = random.Random(4)
    rows = [(r.randrange(5), k) for k in range(500)]
    df = small.createDataFrame(rows, "size int, k long").repartition(7)
    got = numbered(df, [F.desc("size"), F.col("k")], "at").orderBy("at").collect()
    assert [(x["size"], x.k, x["at"]) for x in got] == [(s, k, i + 1) for i, (s, k) in enumerate(sorted(rows, key=lambda x: (-x[0], x[1])))]
    assert numbered(df.limit(0), ["k"], "at").count() == 0


def test_components_of_shapes(small):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101 + i) for i in range(30)] + [(200, 201), (201, 202), (202, 200)] + [(7, 7), (None, 3), (300, 300)]
    df = small.createDataFrame(edges, "src long, dst long")
    clean = [(a, b) for a, b in edges if a is not None and a != b]
    want = brute_components({x for e in clean for x in e}, clean)
    for part in (df, df.repartition(5).orderBy(F.rand(3))):
        assert {r.node: r.component for r in connected_components(part).collect()} == want
    assert connected_components(df.limit(0)).count() == 0


def test_chain_over_the_gate_is_one_group(small):
    rows = [(0, 0, 0), (1, 0x3FF, 0), (2, 0xFFFFF, 0)]
    pairs = gate_pairs(small.createDataFrame(rows, HASH))
    nodes = small.createDataFrame(rows, HASH)
    assert {r.component for r in label_nodes(nodes, pairs.select(F.col("i").alias("src"), F.col("j").alias("dst")), "ord").collect()} == {0}


def brute_linkage(rows, k):
    edges = sorted((dist(a[1], b[1]), a[0], b[0]) for a, b in itertools.combinations(rows, 2))
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    left = len(rows)
    for _, a, b in edges:
        if left <= max(1, k):
            break
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            left -= 1
    return {x: find(x) for x in root}


def test_single_linkage_is_kruskal(small):
    rows = near_rows(40, 9)
    df = small.createDataFrame(rows, HASH)
    assert minimum_forest(df, block_rows=8).count() == 39
    # rows with equal p hang on the least of them
    twins = [(-3, rows[1][1], 2), *rows, *((100 + k, rows[0][1], 1) for k in range(5))]
    for k in (1, 4, 30, 42):
        assert {r.node: r.component for r in single_linkage(small.createDataFrame(twins, HASH), k).collect()} == brute_linkage(twins, k), k
    for k in (0, 1, 5, 17, 40, 60):
        got = {r.node: r.component for r in single_linkage(df, k).collect()}
        assert got == brute_linkage(rows, k), k
    assert len({r.component for r in single_linkage(df, 3, unhashed=2).collect()}) == 1  # floor: unhashed groups stay
    assert len({r.component for r in single_linkage(df, 10, unhashed=4).collect()}) == 6


def files(spark):
    rows = [("a", "u1", "a.png", 1), ("b", "u1", "b.png", 2), ("c", None, "c.png", 3), ("d", "u2", "d.png", 4), ("e", "u3", "e.png", 5), ("f", None, "f.png", 6)]
    return spark.createDataFrame(rows, "domain string, logo_url string, path string, ord long")


def test_cluster_phases(small):
    f = files(small)
    digests = small.createDataFrame([("c", "x"), ("d", "x"), ("e", "y")], "domain string, digest string")
    hashes = small.createDataFrame([("a", 0, 0), ("c", 7, 0), ("e", -1, 0), ("d", 1 << 40, 0)], "domain string, p long, d long")
    by_url = exact_groups(f)
    assert {(r.domain, r.component) for r in by_url.collect()} == {("a", "a"), ("b", "a"), ("c", "c"), ("d", "d"), ("e", "e"), ("f", "f")}
    exact = exact_groups(f, digests)
    assert {r.domain for r in representatives(exact, f).collect()} == {"a", "c", "e", "f"}
    full = {r.domain: r.component for r in cluster_domains(f, hashes, digests).collect()}
    assert full == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e", "f": "f"}
    assert union_counts([by_url, exact]) == [1]
    # f has no hash: it counts as a group, but is never merged
    k1 = {r.domain: r.component for r in cluster_domains(f, hashes, digests, k=1).collect()}
    assert len(set(k1.values())) == 2 and k1["f"] == "f"
    k3 = cluster_domains(f, hashes, digests, k=3)
    assert {r.domain: r.component for r in k3.collect()} == full


def test_reports(small, tmp_path):
    labels = small.createDataFrame([(f"n{i:02d}", "n00" if i < 8 else "n08" if i < 10 else f"n{i:02d}") for i in range(12)], "domain string, component string")
    assert [(r.group_id, r["size"], r.first_node) for r in ranked_groups(labels).orderBy("group_id").collect()] == [(1, 8, "n00"), (2, 2, "n08"), (3, 1, "n10"), (4, 1, "n11")]
    s = summary(labels).first()
    assert (s.total_domains, s.total_groups, s.multi_groups, s.singletons, s.largest, s.avg_multi) == (12, 4, 2, 2, 8, 5.0)
    assert {r.bucket: r.groups for r in size_histogram(labels).collect()} == {"1": 2, "2-5": 1, "6-10": 1}
    sizes = [1, 2, 5, 6, 10, 11, 25, 26, 50, 51, 100, 101]
    df = small.createDataFrame([(x,) for x in sizes], "s int")
    assert [r.b for r in df.select(size_bucket(F.col("s")).alias("b")).collect()] == ["1", "2-5", "2-5", "6-10", "6-10", "11-25", "11-25", "26-50", "26-50", "51-100", "51-100", "100+"]
    top = {r.group_id: r.members for r in preview(labels).collect()}
    assert top[1] == "n00, n01, n02, n03, n04, n05, ... +2" and top[2] == "n08, n09"
    held = small.createDataFrame([(f"n{i:02d}", f"p{i}.png", i) for i in range(12)], "domain string, path string, ord long")
    doc = cluster_document(labels, held, small.createDataFrame([("z",), ("y",)], "domain string"), k=4)
    row = doc.first()
    assert row.failed_domains == ["y", "z"] and row.parameters.k_clusters == 4 and row.groups[0].representative_logo == "p0.png" and [g["count"] for g in row.groups] == [8, 2, 1, 1]
    write_cluster_document(doc, str(tmp_path / "doc"))
    assert small.read.json(str(tmp_path / "doc")).first().total_domains == 12
    write_cluster_files(ranked_groups(labels).join(group_members(labels), "component").select("group_id", F.col("member").alias("path")), str(tmp_path / "files"))
    assert small.read.parquet(str(tmp_path / "files")).where("group_id = 2").count() == 2


def test_files_of_groups_share_a_folder(small, tmp_path):
    folder = tmp_path / "files"
    write_cluster_files(small.createDataFrame([(9, "old.png")], "group_id int, path string"), str(folder))
    # a group of 100 files, 300 of one file
    rows = [(max(1, i - 98), f"logos/n{i:03d}.png") for i in range(400)]
    write_cluster_files(small.createDataFrame(rows, "group_id int, path string").repartition(8), str(folder))
    assert not [p for p in folder.iterdir() if p.is_dir()] and len(list(folder.glob("*.parquet"))) <= 2
    held = small.read.parquet(str(folder))
    assert sorted((r.group_id, r.path, r.name) for r in held.collect()) == sorted((g, p, f"{g}_{p[6:]}") for g, p in rows)
    assert dict(held.dtypes)["group_id"] == "int" and held.where("group_id = 1").count() == 100
    # no group but one on a border is in two files
    spans = sorted((r.lo, r.hi) for r in held.groupBy(F.input_file_name()).agg(F.min("group_id").alias("lo"), F.max("group_id").alias("hi")).collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    write_cluster_files(small.createDataFrame([], "group_id int, path string"), str(folder))
    assert small.read.parquet(str(folder)).count() == 0


def test_empty_tables(small):
    none = small.createDataFrame([], "domain string, logo_url string, path string, ord long")
    hashes = small.createDataFrame([], "domain string, p long, d long")
    assert cluster_domains(none, hashes).count() == 0 and cluster_domains(none, hashes, k=3).count() == 0
    assert summary(small.createDataFrame([], "domain string, component string")).first().total_groups == 0
    assert star_edges(none, "logo_url", "domain", "ord").count() == 0
    assert totals(small.createDataFrame([], LOGO_RESULT)).first().found_pct is None


def test_totals_and_sinks(small, tmp_path):
    rows = [("a", "u", "s", "a.jpeg", None, 200, 5, 7), ("b", "", "s", "", "x", None, 5, 0), ("c", "v", "t", "c.ico", "", 200, 5, 7), ("d", None, None, None, None, None, 5, 0)]
    df = small.createDataFrame(rows, LOGO_RESULT)
    t = totals(df).first()
    assert (t.total, t.found, t.downloaded, t.errors, t.found_pct) == (4, 2, 2, 1, 50.0)
    assert [tuple(r) for r in strategy_histogram(df).collect()] == [("s", 2, 100.0), ("t", 1, 50.0)]
    assert {tuple(r) for r in file_types(df).collect()} == {(".jpg", 1), (".ico", 1)}
    write_results(df, str(tmp_path))
    assert {tuple(r) for r in read_results(small, str(tmp_path / "json"), lines=True).collect()} == set(rows)
    assert small.read.option("header", True).csv(str(tmp_path / "csv")).count() == 4
    (tmp_path / "one.json").write_text(results_document(df).first().json)
    assert {tuple(r) for r in read_results(small, str(tmp_path / "one.json")).collect()} == set(rows)
    write_files(df.select(F.col("domain").alias("name"), F.encode("domain", "utf-8").alias("content")), str(tmp_path / "bin"))
    assert {r.bytes > 0 for r in read_files(small, str(tmp_path / "bin")).collect()} == {True}


def test_read_domains_keeps_order(small, tmp_path):
    small.createDataFrame([("b",), ("a",), (None,), ("b",)], "domain string").coalesce(1).write.parquet(str(tmp_path / "d"))
    assert [r.domain for r in read_domains(small, str(tmp_path / "d")).orderBy("ord").collect()] == ["b", "a", None, "b"]


def png(rgb: np.ndarray) -> bytes:
    h, w, c = rgb.shape
    raw = b"".join(b"\0" + rgb[y].tobytes() for y in range(h))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2 if c == 3 else 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def drawing(w=64, h=64, seed=0):
    g = np.random.default_rng(seed)
    x = np.full((h, w, 3), 255, "uint8")
    for _ in range(5):
        a, b = sorted(g.integers(8, w - 8, 2)), sorted(g.integers(8, h - 8, 2))
        x[b[0] : b[1] + 4, a[0] : a[1] + 4] = g.integers(0, 255, 3)
    return x


def test_image_hashes(small, tmp_path):
    from crestline.functions.images import hash_images

    x = drawing()
    bright = np.clip(x.astype(int) + 8, 0, 255).astype("uint8")
    other = drawing(seed=5)
    for name, im in (("x", x), ("bright", bright), ("other", other), ("flat", np.full((40, 40, 3), 9, "uint8")), ("tiny", x[:6, :6])):
        (tmp_path / f"{name}.png").write_bytes(png(im))
    (tmp_path / "broken.png").write_bytes(b"no image")
    got = {r.path.rpartition("/")[2]: r for r in hash_images(read_images(small, str(tmp_path))).collect()}
    assert set(got) == {"x.png", "bright.png", "other.png", "flat.png", "tiny.png"}
    assert got["flat.png"].p is None and got["tiny.png"].p is None
    assert dist(got["x.png"].p, got["bright.png"].p) <= 10 < dist(got["x.png"].p, got["other.png"].p)
    assert (got["x.png"].p, got["x.png"].d, got["x.png"].a) == hash_pixels(x)


def test_image_parts():
    x = drawing()
    assert to_rgb(np.zeros((2, 2, 4), "uint8").tobytes(), 2, 2, 4).tolist() == [[[128] * 3] * 2] * 2
    assert to_rgb(bytes([1, 2, 3]), 1, 1, 3).tolist() == [[[3, 2, 1]]]
    wide = np.full((200, 200, 3), 255, "uint8")
    wide[90:110, 80:120] = 0
    assert crop_to_content(wide).shape[:2] == (20 + 2 * 16, 40 + 2 * 16)
    assert crop_to_content(np.full((30, 30, 3), 7, "uint8")).shape == (30, 30, 3)
    assert (resize(np.full((9, 7, 3), 33, "uint8"), 16, 16) == 33).all() and is_low_contrast(wide[:50])
    assert hash_image(b"x", 10, 10, 3) == (None, None, None) and hash_image(x.tobytes(), 64, 64, 3)[0] is not None


def test_scratch_is_cleared(spark, tmp_path):
    from crestline.plans.scratch import Scratch, clear_scratch

    clear_scratch(spark)
    cut = Scratch(spark, "test")
    assert cut.cut(spark.range(5)).count() == 5
    root = cut.root.replace("file://", "")
    import os

    assert os.path.exists(root) and clear_scratch(spark) == 1 and not os.path.exists(root) and clear_scratch(spark) == 0
