"""Forms that see no whole group in one task, against plain ones; splits of sessions against all choices."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from calorgrid.operators import sampling, similarity, stats, windows
from calorgrid.operators.exact import exact_quantiles, quantiles


@pytest.mark.parametrize("most", [5, 100, 100000])
def test_quantiles_of_keys_of_any_size(spark, most):
    r = random.Random(2)
    rows = [(r.choice(["a", "a", "a", "b", None]), r.choice([1, None]), r.choice([None, float("nan"), r.gauss(0, 5), float(r.randint(0, 3)), 1e12])) for _ in range(3000)] + [("only null", 1, None)] * 8
    df = spark.createDataFrame(rows, "k string, j int, v double").repartition(5)
    shares = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p1": 1.0}
    groups = {}
    for k, j, v in rows:
        groups.setdefault((k, j), []).append(v)
    want = {}
    for key, vs in groups.items():
        x = [v for v in vs if v is not None and v == v]
        want[key] = tuple(np.percentile(x, [0, 50, 99, 100])) if x else (None,) * 4
    for got in (quantiles(df, ["k", "j"], "v", shares, most), exact_quantiles(df, ["k", "j"], "v", shares, most)):
        out = {(x["k"], x["j"]): tuple(x[c] for c in shares) for x in got.collect()}
        for key, w in want.items():
            assert out.get(key, (None,) * 4) == pytest.approx(w) if w[0] is not None else out.get(key, w) == w
    assert quantiles(df.limit(0), ["k"], "v", shares).count() == 0
    with pytest.raises(ValueError):
        quantiles(df, ["k", "j"], "v", shares, 5, most_heavy=1)


def test_quantiles_keep_keys_of_any_kind(spark):
    df = spark.range(60).selectExpr("timestamp_micros(1700000000000000 + id % 2) t", "date_add(date '2024-01-01', cast(id % 2 as int)) d", "cast(id % 2 as decimal(9,4)) x", "if(id % 2 = 0, 'a\"b', null) s", "id % 2 = 0 b", "cast(id as double) v")
    keys = ["t", "d", "x", "s", "b"]
    want = {tuple(r) for r in df.groupBy(*keys).agg(F.percentile("v", 0.5).alias("p")).collect()}
    assert {tuple(r) for r in exact_quantiles(df, keys, "v", {"p": 0.5}, 5).drop("n").collect()} == want and len(want) == 2


@pytest.mark.parametrize("stretch", [1, 3, 50, 100000])
def test_runs_are_sewn_over_stretches(spark, monkeypatch, stretch):
    monkeypatch.setattr(windows, "_STRETCH", stretch)
    r = random.Random(4)
    rows = [(r.choice(["a", "a", "a", "b", None]), i, r.choice([1.0, 9.0, 9.0, 9.0, None])) for i in range(300)] + [("all hot", i, 9.0) for i in range(120)]
    got = {(x["k"], x["run"], x["length"]) for x in windows.run_lengths(spark.createDataFrame(rows, "k string, i int, v double").repartition(6), ["k"], ["i"], F.col("v") > 5).collect()}
    want = set()
    for k in {x[0] for x in rows}:
        line = [v is not None and v > 5 for kk, _, v in sorted((x for x in rows if x[0] == k), key=lambda x: x[1])]
        at = 0
        for hot, part in itertools.groupby(line):
            n = len(list(part))
            if hot:
                want.add((k, at + 1, n))
            at += n
    assert got == want


def test_lowest_ranks(spark):
    rows = [("a", float(i % 7)) for i in range(95)] + [("b", 3.0), ("c", None), (None, 1.0), (None, 2.0)]
    got = {x["k"]: x["ambient"] for x in stats.ambient_by_rank(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    assert got == {"a": 0.0, "b": 3.0, None: 1.0}


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7, 9])
def test_near_codes_against_all_pairs(spark, radius):
    r = random.Random(radius)
    codes = [r.getrandbits(64) for _ in range(12)]
    for c in list(codes):
        for _ in range(6):
            for b in r.sample(range(64), r.randint(0, radius + 2)):
                c ^= 1 << b
            codes.append(c)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    first = {}
    for i, c in enumerate(signed):
        first.setdefault(c, i)
    want = {(min(i, j), max(i, j), bin((a ^ b) & (1 << 64) - 1).count("1")) for (a, i), (b, j) in itertools.combinations(first.items(), 2) if bin((a ^ b) & (1 << 64) - 1).count("1") <= radius}
    got = similarity.near_hashes(spark.createDataFrame([*enumerate(signed), (999, None)], "id int, c long"), "id", "c", radius).collect()
    assert {tuple(x) for x in got} == want and len(got) == len(want)


@pytest.mark.parametrize("first,growth,tile", [(2048, 8, 512), (7, 2, 5), (50, 4, 3)])
def test_leaders_grow(spark, first, growth, tile):
    g = np.random.default_rng(0)
    v = g.normal(size=(400, 8))
    v[200:] = v[g.integers(0, 200, 200)] * 2
    got = dict(similarity.leaders(spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "id int, v array<double>, b int"), "id", "v", "b", 0.93, first, growth, tile).collect())
    unit = (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32).astype(float)
    lead, want = [], {}
    for i, x in enumerate(unit):
        near = [k for k in lead if unit[k] @ x >= 0.93]
        want[i] = near[0] if near else i
        if not near:
            lead.append(i)
    assert got == want and len(lead) > 128


def test_odd_vectors_lead_themselves(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [2.0, 0.1], "a"), (3, [1.0, 0.0], "b"), (4, [1.0, 0.0, 0.0], "a"), (5, None, "a"), (6, [0.0, 0.0], "a"), (7, [3.0, 0.0], None), (8, [1.0, 0.0], None), (9, [], "a")]
    df = spark.createDataFrame(rows, "id int, v array<double>, b string")
    assert dict(similarity.leaders(df, "id", "v", "b").collect()) == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7, 9: 9}
    assert similarity.leaders(df.limit(0), "id", "v", "b").count() == 0


def test_folds_without_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "s string, i int")
    assert sorted(map(tuple, sampling.fold_splits(df, "s").collect())) == [("a", "a", "val"), ("a", "b", "train"), ("b", "a", "train"), ("b", "b", "val")]


def boxes_of(sizes, classes=("x", "y")):
    r = random.Random(sum(sizes))
    return [(f"s{k}", f"s{k}f{f}", r.choice(classes)) for k, n in enumerate(sizes) for f in range(n) for _ in range(r.randint(1, 3))]


def greedy(rows, ratio):
    """The rule, written out plainly."""
    frames, per, total = {}, {}, {}
    for s, f, c in rows:
        frames.setdefault(s, set()).add(f)
        per.setdefault(s, {}).setdefault(c, 0)
        per[s][c] += 1
        total[c] = total.get(c, 0) + 1
    all_frames = sum(len(x) for x in frames.values())
    target, val = max(1, int(all_frames * ratio)), []
    while sum(len(frames[s]) for s in val) < target:
        options = []
        for s in sorted(frames):
            n = sum(len(frames[x]) for x in (*val, s))
            if s not in val and n < all_frames:
                inside = {c: sum(per[x].get(c, 0) for x in (*val, s)) for c in total}
                options.append((round(sum(total[c] * abs(inside[c] / total[c] - ratio) for c in total) + 2 * abs(n - target), 9), s))
        if not options:
            break
        val.append(min(options)[1])
    return val


@pytest.mark.parametrize("sizes", [(95, 5), (5, 95), (50, 50), (10, 20, 30, 40), (1, 1), (3, 3, 3, 3, 3, 3, 80)])
def test_sessions_leave_something_to_train(spark, sizes):
    rows = boxes_of(sizes)
    df = spark.createDataFrame(rows, "s string, f string, c string")
    held = sampling.balanced_sessions(df, "s", "c", 0.2, "f")
    assert held == greedy(rows, 0.2) and 0 < len(held) < len(sizes)
    out = sampling.balanced_validation(df, "s", "c", "f").collect()
    assert len(out) == len(rows) and {x["split"] for x in out} == {"train", "val"}


def test_one_session_is_split_by_frames(spark):
    df = spark.createDataFrame([*boxes_of((20,)), ("s0", None, "x")], "s string, f string, c string")
    out = sampling.balanced_validation(df, "s", "c", "f").collect()
    split = {x["f"]: x["split"] for x in out}
    assert sorted(split.values()).count("val") == 4 and len({(x["f"], x["split"]) for x in out}) == 21
    alone = spark.createDataFrame([("s", "f", "x")] * 3, "s string, f string, c string")
    assert {x["split"] for x in sampling.balanced_validation(alone, "s", "c", "f").collect()} == {"train"}
    assert sampling.balanced_validation(alone.limit(0), "s", "c", "f").count() == 0


def test_many_classes_a_session(spark):
    rows = [(f"s{k}", f"s{k}f{f}", str((k * 7 + f) % 65)) for k in range(6) for f in range(65)]
    assert sampling.balanced_sessions(spark.createDataFrame(rows, "s string, f string, c string"), "s", "c", 0.2, "f", most_sessions=7) == greedy(rows, 0.2)


def test_many_owners_and_folds(spark):
    rows = [(f"o{i:04d}", i) for i in range(1001)]
    df = spark.createDataFrame(rows, "owner string, id int")
    out = sampling.cross_review(df, "owner", "id", sampling.following_owners(df, "owner"))
    got = {(x["owner"], x["id"]) for x in out.where("role = 'cross'").collect()}
    assert got == {(f"o{(i + 1) % 1001:04d}", i) for i in range(1001)}
    folds = df.select(F.col("owner").alias("fold"))
    assert sampling.leave_one_out(df, "owner", folds).where("split = 'val'").count() == 1001
