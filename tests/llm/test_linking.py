import itertools
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crestline.llm.hamming import near_codes, ring, similar_pairs, similar_classes
from crestline.llm.linking import link_groups
from crestline.llm.spectral import _forest, _nearest, similarity_clusters, similarity_subclusters, with_typical

HASH = "ord long, domain string, p long, d long, code string, payload int"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def dist(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count()


def rows(n=80, seed=3, flips=9):
    r = random.Random(seed)
    out, cores = [], [(r.getrandbits(64), r.getrandbits(64)) for _ in range(6)]
    for i in range(n):
        p, d = r.choice(cores) if r.random() < 0.8 else (r.getrandbits(64), r.getrandbits(64))
        for _ in range(r.randrange(flips)):
            p ^= 1 << r.randrange(64)
            d ^= 1 << r.randrange(64)
        out.append((i, f"d{i}", signed(p), signed(d), "x", 1))
    return out


def gate(a, b):
    return dist(a[2], b[2]) <= 10 or (dist(a[2], b[2]) <= 12 and dist(a[3], b[3]) <= 10)


def brute_groups(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 14), st.lists(st.integers(0, 63), max_size=14))
def test_pigeonring_holds(tau, flips):
    """Any code within the threshold has a segment from which every chain keeps its budget."""
    budgets = ring(tau)
    m, x = len(budgets), 0
    for f in flips:
        x ^= 1 << f
    if x.bit_count() > tau:
        return
    width = 64 // m
    b = [((x >> (s * width)) & ((1 << width) - 1)).bit_count() for s in range(m)]
    assert max(budgets) <= 2
    assert any(all(sum(b[(s + k) % m] - budgets[(s + k) % m] for k in range(n)) <= n - 1 for n in range(1, m + 1)) for s in range(m))


@pytest.mark.parametrize("tau", [0, 1, 3, 7, 10])
@pytest.mark.parametrize("hot", [20_000, 4])
def test_near_codes_lose_nothing(small, tau, hot):
    data = [(r[2], r[0]) for r in rows(60)] + [(rows(60)[0][2], 1000 + i) for i in range(5)]
    got = {(r.code_a, r.payload_a, r.code_b, r.payload_b) for r in near_codes(small.createDataFrame(data, "code long, payload long"), tau, hot=hot).collect()}
    assert got == {(*min(a, b), *max(a, b)) for a, b in itertools.combinations(data, 2) if dist(a[0], b[0]) <= tau}


def test_pairs_equal_brute_force(small):
    data = rows()
    data += [(100 + i, "c", data[0][2], data[0][3], "x", 1) for i in range(4)]  # copies
    df = small.createDataFrame(data + data[:7] + [(500, "n", None, 1, "x", 1), (501, "n", 1, None, "x", 1), (None, "n", 1, 1, "x", 1)], HASH)
    got = similar_pairs(df).collect()
    want = {(a[0], b[0]) for a, b in itertools.combinations(data, 2) if gate(a, b)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert {tuple(r) for r in similar_pairs(df, hot=6, chunk=2).collect()} == want
    links = {}
    for pair in want:
        for x in pair:
            links[x] = links.get(x, 0) + 1
    first, copies = {}, {}
    for r in sorted(data):
        first.setdefault(r[2:4], r[0])
        copies[r[2:4]] = copies.get(r[2:4], 0) + 1
    classes = similar_classes(df).collect()
    assert {(r.ord, r.class_ord, r.copies, r.links) for r in classes} == {(r[0], first[r[2:4]], copies[r[2:4]], links.get(r[0], 0)) for r in data} and len(classes) == len(data)
    assert similar_pairs(df.limit(0)).count() == 0


def test_clusters_equal_brute_force(small):
    data = rows(70, 11) + [(200 + i, "c", 5, i, "x", 1) for i in range(4)]  # one p, other d: all similar
    df = small.createDataFrame(data + data[:5] + [(300, "n", None, 1, "x", 1)], HASH)
    groups = brute_groups((a[0], b[0]) for a, b in itertools.combinations(data, 2) if gate(a, b))
    p = {r[0]: r[2] for r in data}
    want = set()
    for g in set(groups.values()):
        ms = [x for x, y in groups.items() if y == g]
        typical = min((sum(dist(p[x], p[y]) for y in ms), x) for x in ms)[1]
        want |= {(min(ms), typical, x) for x in ms}
    got = with_typical(similarity_clusters(df)).select("first_ord", "typical_ord", "ord").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    # the result does not depend on how far the iteration came
    assert {tuple(r) for r in with_typical(similarity_clusters(df, vectors=1, rounds=1, settle=0)).select("first_ord", "typical_ord", "ord").collect()} == want


def bridged(seed=6, n=60):
    """Two dense clusters, far from each other, with a chain of single links between them, and a third by itself: (rows, cluster of each ord)."""
    r = random.Random(seed)
    cores = [r.getrandbits(63) for _ in range(3)]
    out, truth = [], {}
    for c, core in enumerate(cores):
        for _ in range(n):
            p = core
            for _ in range(r.randrange(1, 5)):
                p ^= 1 << r.randrange(63)
            truth[len(out)] = c
            out.append((len(out), "d", p, r.getrandbits(60), "x", 1))
    # steps of eight bits from one core to the next
    p, apart = cores[0], [b for b in range(63) if (cores[0] ^ cores[1]) >> b & 1]
    while len(apart) > 8:
        for b in apart[:8]:
            p ^= 1 << b
        apart = apart[8:]
        out.append((len(out), "d", p, r.getrandbits(60), "x", 1))
    return out, truth


def subclusters(small, data, **how):
    return {x.ord: x for x in similarity_subclusters(small.createDataFrame(data, HASH), **how).collect()}


def test_embedding_tells_bridged_clusters_apart(small):
    data, truth = bridged()
    got = subclusters(small, data)
    assert got[0].group_ord == got[60].group_ord == 0 and got[120].group_ord == 120  # linked through the chain
    pairs = list(itertools.combinations(truth, 2))
    same, found = {p for p in pairs if truth[p[0]] == truth[p[1]]}, {p for p in pairs if got[p[0]].first_ord == got[p[1]].first_ord}
    recall, precision = len(same & found) / len(same), len(same & found) / len(found)
    assert recall >= 0.9 and precision >= 0.99, (recall, precision)
    # typical members are near their core: they have the greatest affinity to the others
    for first in {x.first_ord for o, x in got.items() if o in truth}:
        own = [x for x in got.values() if x.first_ord == first]
        assert own[0].size == len(own)
    # random places, which no round has moved, tell nothing apart
    loose = subclusters(small, data, rounds=0)
    found = {p for p in pairs if loose[p[0]].first_ord == loose[p[1]].first_ord}
    assert len(same & found) / len(found) < 0.9


def test_nearest_do_not_depend_on_pieces():
    g = np.random.default_rng(1)
    a, b = g.integers(0, 40, 500), g.integers(0, 40, 500)
    d = (a * 7 + b * 7) % 11  # by the pair
    keep = a != b
    a, b, d = a[keep], b[keep], d[keep]
    edges = lambda k, a, b: {(min(x, y), max(x, y)) for x, y in zip(a[k].tolist(), b[k].tolist())}
    whole = edges(_nearest(a, b, d, 3), a, b)
    halves = [_nearest(x, y, z, 3) + s for x, y, z, s in ((a[:200], b[:200], d[:200], 0), (a[200:], b[200:], d[200:], 200))]
    both = np.concatenate(halves)
    assert edges(_nearest(a[both], b[both], d[both], 3), a[both], b[both]) == whole


def test_clusters_of_nothing(small):
    df = small.createDataFrame([], HASH)
    assert similarity_clusters(df).count() == 0
    lone = small.createDataFrame([(1, "a", 0, 0, "x", 1), (2, "b", -1, 0, "x", 1)], HASH)
    assert similarity_clusters(lone).count() == 0
    assert similarity_subclusters(lone).count() == 0 and similarity_subclusters(df).count() == 0
    twins = small.createDataFrame([(1, "a", 0, 0, "x", 1), (2, "b", 0, 9, "x", 1), (3, "c", -1, 0, "x", 1)], HASH)
    assert {(r.group_ord, r.first_ord, r.ord, r["size"], r.affinity) for r in similarity_subclusters(twins).collect()} == {(1, 1, 1, 2, 1024), (1, 1, 2, 2, 1024)}


def test_forest_keeps_links():
    g = np.random.default_rng(0)
    a, b, d = g.integers(0, 50, 300), g.integers(0, 50, 300), g.integers(0, 12, 300)
    keep = _forest(a, b, d)
    assert brute_groups(zip(a[keep].tolist(), b[keep].tolist())) == brute_groups((x, y) for x, y in zip(a.tolist(), b.tolist()) if x != y)
    # the same edges in any order and in pieces, as a repeated task may read them
    edges = lambda k, a, b, d: {(int(d[i]), *sorted((int(a[i]), int(b[i])))) for i in k}
    mix = g.permutation(300)
    a2, b2, d2 = b[mix], a[mix], d[mix]
    first = _forest(a2[:150], b2[:150], d2[:150])
    a3, b3, d3 = (np.concatenate([x[first], x[150:]]) for x in (a2, b2, d2))
    assert edges(keep, a, b, d) == edges(_forest(a2, b2, d2), a2, b2, d2) == edges(_forest(a3, b3, d3), a3, b3, d3)


SHAPES = {
    "path": [(i, i + 1) for i in range(33)], "ring": [(i, (i + 1) % 9) for i in range(9)], "star": [(50, i) for i in range(40)], "two": [(4, 2)],
    "tree": [(i, (i - 1) // 2) for i in range(1, 40)], "rings on a chain": [(0, 1), (1, 2), (2, 0), (2, 3), (3, 4), (4, 5), (5, 6), (6, 4)],
    "dense": list(itertools.combinations(range(9), 2)), "double chain": [(0, 1), (1, 9), (0, 2), (2, 9), (0, 3), (3, 4), (4, 9)], "loop chain": [(0, 1), (1, 2), (2, 3), (3, 0), (0, 7), (0, 8)],
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_shapes(small, shape):
    r = random.Random(1)
    names = list(range(60))
    r.shuffle(names)
    pairs = [(names[a], names[b]) if r.random() < 0.5 else (names[b], names[a]) for a, b in SHAPES[shape]]
    df = small.createDataFrame(pairs + pairs[:3] + [(1, None), (None, None), (5, 5)], "a long, b long")
    assert {x.vertex: x.group for x in link_groups(df, "a", "b").collect()} == brute_groups(pairs)


def test_random_graph_of_names(small):
    r = random.Random(8)
    pairs = [(f"n{r.randrange(150)}", f"n{r.randrange(150)}" if r.random() < 0.8 else "hub") for _ in range(130)]
    df = small.createDataFrame([(a, b, "v", 1) for a, b in pairs], "vertex string, label string, u string, group int")
    assert {x.vertex: x.group for x in link_groups(df, "vertex", "label").collect()} == brute_groups(p for p in pairs if p[0] != p[1])


def test_hub_giant_group_and_hot_keys(small):
    """A hub of many leaves beside a core that star rounds solve; no join may bring its rows together."""
    pairs = [(f"l{k}", "hub") for k in range(1500)] + [(f"c{a}", f"c{b}") for a, b in itertools.combinations(range(12), 2)] + [("c0", "hub")] + [(f"c{k % 12}", f"m{k}") for k in range(600)] + [(f"m{k}", f"m{k + 1}") for k in range(0, 600, 2)]
    df = small.createDataFrame(pairs, "a string, b string")
    got = {x.vertex: x.group for x in link_groups(df, "a", "b", hot=100).collect()}
    assert set(got.values()) == {"c0"} and len(got) == len({x for p in pairs for x in p})


def test_link_nothing(small):
    assert link_groups(small.createDataFrame([], "a string, b string"), "a", "b").count() == 0
    assert link_groups(small.createDataFrame([("x", None), ("y", "y")], "a string, b string"), "a", "b").count() == 0


def test_match_rule(spark):
    from crestline.llm.link_queries import matches

    cases = [("a", "b", "same_url", None, None, True), ("a", "b", "phash", 10, None, True), ("a", "b", "phash", 11, None, False), ("a", "b", "phash", None, 1, False), ("a", "b", "phash", 12, 10, True), ("a", "b", "phash", 12, 11, False),
             ("a", "a", "same_file", None, None, False), ("a", None, "same_file", None, None, False), ("a", "b", "other", 1, 1, False), ("a", "b", None, 1, 1, False)]
    df = spark.createDataFrame(cases, "domain_a string, domain_b string, via string, p_dist int, d_dist int, e boolean")
    assert matches(df).where("e").count() == 3 and matches(df).count() == 3
