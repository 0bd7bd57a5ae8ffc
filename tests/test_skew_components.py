import random
import statistics
from collections import Counter, defaultdict

import pytest
from calorgrid.operators.components import connected_components
from calorgrid.operators.exact import exact_medians
from calorgrid.operators.skew import heavy_keys, per_key

SCHEMA = "i long, a string, b string, v double, n int, _key string, _salt int"


def _rows(k=600, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(k):
        a = r.choice(["hot"] * 5 + ["x", "y", "z", None])
        b = r.choice(["k"] * 6 + ["m", None])
        v = r.choice([None, float("nan"), float("inf"), -0.0, 1.5, float(r.randint(0, 9))])
        out.append((i, a, b, v, 7, "clash", 3))
    return out


@pytest.mark.parametrize("share", [0.04, 0.3, 1.0])
def test_heavy_keys_are_exact(spark, share):
    rows = _rows()
    whole = [(a, b) for _, a, b, *_ in rows if a is not None and b is not None]
    want = {(k, n) for k, n in Counter(whole).items() if n >= share * len(whole)}
    got = {((r["a"], r["b"]), r["n"]) for r in heavy_keys(spark.createDataFrame(rows, SCHEMA), ["a", "b"], share).collect()}
    assert got == want


def test_per_key_against_a_plain_loop(spark):
    rows = _rows()
    df = spark.createDataFrame(rows + rows[:5], SCHEMA).repartition(5)
    got = {(r["a"], r["b"]): r for r in per_key(df, ["a", "b"], "v", "i", heavy_keys(df, ["a", "b"], 0.05), 2, salts=4).collect()}
    want = defaultdict(list)
    for i, a, b, v, *_ in rows + rows[:5]:
        want[a, b].append((i, v))
    assert set(got) == set(want)
    for k, each in want.items():
        values = [(v + 0.0, i) for i, v in each if v is not None and v - v == 0]
        top = [i for v, i in sorted(values, key=lambda x: (-x[0], x[1]))[:2]]
        r = got[k]
        assert (r["n"], r["n_value"], r["worst"]) == (len(each), len(values), top)
        assert r["mean_value"] == (pytest.approx(sum(v for v, _ in values) / len(values)) if values else None)


def test_nothing_in_nothing_out(spark):
    none = spark.createDataFrame([], SCHEMA)
    heavy = heavy_keys(none, ["a", "b"], 0.1)
    assert heavy.count() == 0 and per_key(none, ["a", "b"], "v", "i", heavy).count() == 0
    assert exact_medians(none, ["a"], "v").count() == 0
    assert connected_components(none, "a", "b").count() == 0
    with pytest.raises(ValueError):
        heavy_keys(none, ["a"], 0.00001)


def test_components_against_union_find(spark):
    r = random.Random(5)
    links = [(f"n{r.randint(0, 60):02d}", f"n{r.randint(0, 60):02d}") for _ in range(45)] + [("hub", f"h{i}") for i in range(30)] + [("loop", "loop"), (None, "solo"), ("z1", None)]
    links += [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(25)] + links[:4]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        for x in (a, b):
            if x is not None:
                find(x)
        if a is not None and b is not None:
            p, q = sorted((find(a), find(b)))
            parent[q] = p
    got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(links, "l string, r string"), "l", "r").collect()}
    assert got == {x: find(x) for x in parent}


@pytest.mark.parametrize("most", [3, 50, 100000])
def test_exact_medians_of_any_size(spark, most):
    r = random.Random(2)
    data = {"a": [r.choice([0.25, 1.0, 7.5]) for _ in range(101)], "b": [r.uniform(-1e3, 1e9) for _ in range(200)], "c": [5.0], "d": [1e-300, 2e-300, -1e300, 1e300], "e": [3.0] * 40}
    rows = [(k, v) for k, vs in data.items() for v in vs] + [("f", None), ("a", float("nan"))]
    got = {x["k"]: (x["n"], x["median"]) for x in exact_medians(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", most).collect()}
    assert got == {k: (len(v), pytest.approx(statistics.median(v))) for k, v in data.items()}
