import random
from collections import Counter, defaultdict

from crestline.operators.skew import heavy_keys, key_percentiles, key_profile, value_frequencies

SCHEMA = "k string, a string, b int, weight int"


def rows(n=600, seed=1):
    r = random.Random(seed)
    out = [("hot" if r.random() < 0.4 else None if r.random() < 0.1 else f"k{r.randrange(30)}", None if r.random() < 0.1 else f"v{r.randrange(12)}", None if r.random() < 0.1 else r.randrange(5000), i) for i in range(n)]
    return out


def test_profile_equals_brute_force(spark):
    data = rows()
    got = {r.k: r for r in key_profile(spark.createDataFrame(data, SCHEMA), "k", distinct={"as_": "a", "bs": "b"}, mode={"top": "a"}).collect()}
    by = defaultdict(list)
    for x in data:
        by[x[0]].append(x)
    assert set(got) == set(by)
    for k, xs in by.items():
        a = Counter(x[1] for x in xs if x[1] is not None)
        assert got[k].records == len(xs) and got[k].as_ == len(a) and got[k].bs == len({x[2] for x in xs if x[2] is not None})
        assert got[k].top == (min(a, key=lambda v: (-a[v], v)) if a else None)


def test_percentiles_are_exact(spark):
    data = rows()
    got = {(r.k, r.share): r.percentile for r in key_percentiles(spark.createDataFrame(data, SCHEMA), "k", "b", [0.0, 0.5, 0.95, 1.0]).collect()}
    by = defaultdict(list)
    for x in data:
        if x[2] is not None:
            by[x[0]].append(x[2])
    import math

    for k, xs in by.items():
        xs.sort()
        for s in (0.0, 0.5, 0.95, 1.0):
            assert got[k, s] == xs[max(1, math.ceil(s * len(xs))) - 1]
    assert len(got) == 4 * len(by)


def test_heavy_keys_and_null_key(spark):
    df = spark.createDataFrame([("a", "x", 1, 1)] * 5 + [(None, "x", 1, 1)] * 5 + [(f"r{i}", "x", 1, 1) for i in range(10)], SCHEMA)
    assert [r.k for r in heavy_keys(key_profile(df, "k"), "k", 0.2).collect()] == ["a"]


def test_empty_and_clashing_names(spark):
    df = spark.createDataFrame([], "k string, field string, value int")
    assert key_profile(df, "k", distinct={"n": "field"}).count() == 0
    assert key_percentiles(df, "k", "value", [0.5]).count() == 0
    assert heavy_keys(key_profile(df, "k"), "k", 0.01).count() == 0
    clash = spark.createDataFrame([("x", "f", 1)], "value string, field string, weight int")
    assert key_profile(clash, "value", distinct={"n": "field"}).collect()[0].asDict() == {"value": "x", "records": 1, "n": 1}


def test_hot_key_is_compressed_before_the_second_shuffle(spark):
    df = spark.createDataFrame([("hot", "v", 1, 1)] * 500, SCHEMA)
    assert value_frequencies(df, "k", ["a"]).count() == 1
