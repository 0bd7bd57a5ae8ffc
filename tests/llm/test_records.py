"""Splits, overlaps, percentiles, packing."""

import itertools
import random
from datetime import date

import numpy as np
import pytest

from calorgrid.llm import packing, quantiles
from calorgrid.llm.overlap import FIGURES, cross_split_pairs, overlap_report
from calorgrid.llm.splits import cabinet_groups, frame_splits, grouped_splits, place

FRAME = "frame_id long, stem string, panel string, verdict string, split string, source string, t_ambient double, t_med double, t_max double, worst_temp double, cabinet string, k int, x long"
MOVES = "move_id int, old_key string, new_key string, moved_on date"


def frame(i, stem, panel=None, verdict="normal", split="train", source="s", figures=(20.0, 25.0, 40.0, 39.0)):
    return (i, stem, panel, verdict, split, source, *figures, "clash", 1, 2)


def test_cabinets_and_their_moves(spark):
    moves = [(1, "C2_B1_P3", "C2_B2_P3", date(2024, 1, 1)), (2, "C2_B2_P3", "C5_B1_P3", None), (3, "C9_B1_P1", "C10_B1_P1", None), (3, "C9_B1_P1", "C10_B1_P1", None), (4, "E1_B1_P1", "E1_B1_P1", None), (5, None, "E3_B1_P1", None)]
    frames = [frame(1, "C5_B1_P3_2024-01-01_IR1_00001"), frame(2, "c2-b2-p03-nonsense"), frame(3, "C9_B1_P1_2024-01-01_IR1_00001"), frame(4, "E1_B1_2024-01-01_IR1_00001", "p1"), frame(5, "DSC1", "P1"), frame(6, None), frame(7, "E3_B1_2024-01-01_IR1_00001")]
    got = {r["frame_id"]: r["group_key"] for r in cabinet_groups(spark.createDataFrame(frames, FRAME), spark.createDataFrame(moves, MOVES)).collect()}
    assert got == {1: "C2_B1_P3", 2: "C2_B1_P3", 3: "C10_B1_P1", 4: "E1_B1_P1", 7: "E3_B1"}
    none = cabinet_groups(spark.createDataFrame([], FRAME), spark.createDataFrame([], MOVES))
    assert none.count() == 0


@pytest.mark.parametrize("heavy,shard", [(1 / 2000, 20000), (0.05, 7), (1.0, 10)])
def test_splits_keep_groups_and_proportions(spark, heavy, shard):
    r = random.Random(1)
    rows = [(f"g{g:03d}" if g else None, r.choice(["a", "a", "a", "b", None, "rare" if g % 9 == 0 else "a"])) for g in range(200) for _ in range(r.choice([1, 5, 30, 300 if g < 3 else 9]))]
    df = spark.createDataFrame(rows, "g string, label string")
    got = grouped_splits(df, "g", df["label"], ("a", "b", "rare"), {"train": 0.8, "val": 0.1, "test": 0.1}, heavy, shard)
    split = {x["g"]: x["split"] for x in got.collect()}
    assert len(split) == 200 and got.count() == 200
    for label in ("a", "b", "rare", None):
        n = [sum(1 for g, x in rows if x == label and split[g] == s) for s in ("train", "val", "test")]
        assert abs(n[0] / sum(n) - 0.8) < 0.08, (label, n)
    assert grouped_splits(df.limit(0), "g", df["label"], ("a",), {"train": 1.0}).count() == 0


def test_rarest_label_is_placed_first():
    labels = np.array([[10, 1], [10, 0], [10, 0], [10, 1]])
    k = place(labels, np.outer([0.5, 0.5], labels.sum(axis=0)))
    assert k[0] != k[3] and sorted(k) == [0, 0, 1, 1]


def test_every_frame_gets_a_split(spark):
    frames = [frame(i, f"C{i % 7}_B1_P1_2024-01-01_IR1_{i:05d}", verdict="critical" if i % 5 == 0 else None) for i in range(70)] + [frame(100, None), frame(101, "DSC1"), frame(102, "DSC1")]
    df = frame_splits(spark.createDataFrame(frames, FRAME), spark.createDataFrame([], MOVES), {"train": 0.8, "val": 0.1, "test": 0.1}, ("normal", "critical"))
    got = {r["frame_id"]: (r["group_key"], r["split"]) for r in df.collect()}
    assert len(got) == 73 and got[101] == got[102]
    assert len({(g, s) for g, s in got.values()}) == len({g for g, _ in got.values()})


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_overlaps_against_all_pairs(spark):
    r = random.Random(9)
    plain = [f"C{r.randint(1, 2)}_B1_P{r.randint(1, 3)}_2024-0{r.randint(1, 2)}-1{r.randint(0, 3)}_IR{r.randint(1, 2)}_000{r.randint(10, 40)}" for _ in range(40)]
    rows, truth = [], {}
    for i in range(500):
        text, valid = r.choice(plain), True
        if r.random() < 0.35:
            fields = text.split("_")
            for _ in range(r.choice([1, 1, 2])):
                f = r.choice([3, 3, 4])
                s = fields[f]
                p = r.choice([k for k, c in enumerate(s) if c.isdigit()] or [len(s)])
                fields[f] = r.choice([s[:p] + s[p + 1 :], s[:p] + str(r.randint(0, 9)) + s[p:], s[:p] + str(r.randint(0, 9)) + s[p + 1 :]])
            text = "_".join(fields)
        figures = tuple(None if r.random() < 0.05 else round(20.0 * k + r.choice([0, 0.06, 0.1, 0.13, 0.97, 1.0]), 2) for k in range(1, 5))
        split = r.choice(["train", "TRAIN ", "val", "Test", None])
        rows.append(frame(i, text.lower() if r.random() < 0.2 else text, split=split, figures=figures))
        import re

        valid = re.fullmatch(r"C\d_B1_P\d_\d{4}-\d\d-\d\d_IR\d_\d{5}", text) is not None
        truth[i] = (text, valid, (split or "").strip().lower(), figures)
    rows.append(frame(900, "DSC000000001", split="val"))
    rows.append(frame(901, None, split="val"))
    want = set()
    for (i, a), (j, b) in itertools.combinations(truth.items(), 2):
        if {a[2], b[2]} in ({"train", "val"}, {"train", "test"}):
            near = all(x is not None and y is not None and abs(x - y) <= 0.1 + 1e-9 for x, y in zip(a[3], b[3], strict=True)) and distance(a[0], b[0]) <= 2
            if (a[1] and b[1] and a[0] == b[0]) or near:
                want.add((i, j))
    df = spark.createDataFrame(rows, FRAME).repartition(5)
    pairs = cross_split_pairs(df)
    got = [tuple(x) for x in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300
    report = overlap_report(df, pairs).collect()
    assert sum(x["n_pairs"] for x in report) == len(want) and {x["split"] for x in report} == {"val", "test"}
    assert cross_split_pairs(df.limit(0)).count() == 0 and len(FIGURES) == 4
    with pytest.raises(ValueError):
        cross_split_pairs(df, edits=3)


def rank_error(values, x, q):
    tol = abs(x) * 2**-20 + 1e-300
    rank = max(1, np.ceil(q * len(values)))
    return max(0, np.searchsorted(values, x - tol) + 1 - rank, rank - np.searchsorted(values, x + tol, side="right")) / len(values)


@pytest.mark.parametrize("kind", ["normal", "ties", "outliers", "uniform"])
def test_percentiles_have_bounded_rank_error(kind):
    g = np.random.default_rng(3)
    v = {"normal": g.normal(60, 15, 40000), "ties": g.integers(0, 12, 40000) / 4, "outliers": np.concatenate([g.normal(0, 1, 39000), g.uniform(-1e12, 1e12, 1000)]), "uniform": g.uniform(-1, 1, 40000)}[kind]
    s = quantiles.merge([quantiles.pack(quantiles.encode(part), np.ones(len(part), int)) for part in np.array_split(v, 7)])
    shares = [0, 0.01, 0.25, 0.5, 0.9, 0.99, 1]
    n, got = quantiles.quantiles(s, shares)
    v = np.sort(v)
    assert n == len(v) and max(rank_error(v, x, q) for q, x in zip(shares, got, strict=True)) < 0.02


def test_sketches_add_and_delete(monkeypatch):
    g = np.random.default_rng(4)
    a, b = g.normal(50, 9, 30000), g.normal(90, 1, 30000)
    pack = lambda v, w=1: quantiles.pack(quantiles.encode(v), np.full(len(v), w))
    whole = pack(np.concatenate([a, b]))
    back = quantiles.merge([whole, quantiles.merge([pack(b)], -1)])
    assert (quantiles.dense(back) == quantiles.dense(pack(a))).all()
    monkeypatch.setattr(quantiles, "MOST_UPDATES", 10)
    assert pack(a)[:1] == b"c" and (quantiles.dense(pack(a)) == quantiles.dense(quantiles.merge([pack(a[:9000]), pack(a[9000:])]))).all()
    assert (quantiles.dense(quantiles.merge([whole, quantiles.merge([pack(b)], -1)])) == quantiles.dense(pack(a))).all()
    assert quantiles.quantiles(pack(np.zeros(0)), [0.5]) == (0, [None])


def test_codes_keep_the_order():
    v = np.array([-1e300, -5.0, -1e-300, -0.0, 0.0, 1e-300, 0.5, 87.8, 42906964.38, 1e300])
    c = quantiles.encode(v)
    assert (np.diff(c) >= 0).all() and c[3] == c[4] and 0 <= c.min() and c.max() < 1 << 32
    assert np.allclose(quantiles.decode(c)[[0, 1, 6, 7, 8, 9]], v[[0, 1, 6, 7, 8, 9]], rtol=2**-20)


def test_summaries_of_a_table_dont_depend_on_its_parts(spark):
    r = random.Random(6)
    rows = [(r.choice(["a", "b", None]), r.randint(1, 3), r.choice([None, float("nan"), float("-inf"), r.gauss(50, 9)]), b"clash", 1) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, d int, v double, summary binary, salt int")
    out = []
    for parts in (1, 7):
        days = quantiles.summarise(df.repartition(parts), ["g", "d"], "v")
        out.append(sorted(map(str, quantiles.answers(quantiles.merged(days, ["g"]), ["g"], {"p50": 0.5, "p99": 0.99}).collect())))
    assert out[0] == out[1] and len(out[0]) == 3
    got = quantiles.answers(quantiles.merged(days, ["g"]), ["g"], {"p50": 0.5}).where("g = 'a'").first()
    v = np.sort([x for g, _, x, *_ in rows if g == "a" and x is not None and np.isfinite(x)])
    assert got["n"] == len(v) and rank_error(v, got["p50"], 0.5) < 0.02
    assert quantiles.summarise(df.limit(0), ["g"], "v").count() == 0


def test_windows_are_filled_best():
    r = random.Random(3)
    for _ in range(200):
        counts = {n: r.randint(1, 3) for n in r.sample(range(1, 30), r.randint(1, 6))}
        room = r.randint(0, 60)
        items = [n for n, c in counts.items() for _ in range(c)]
        sums = {0}
        for n in items:
            sums |= {s + n for s in sums}
        got = packing.fullest(sorted(counts, reverse=True), counts, room)
        assert sum(n * k for n, k in got) == max(s for s in sums if s <= room)
        assert all(k <= counts[n] for n, k in got)


def first_fit_decreasing(items, capacity):
    bins = []
    for n in sorted(items, reverse=True):
        k = next((k for k, left in enumerate(bins) if left >= n), None)
        if k is None:
            bins.append(capacity - n)
        else:
            bins[k] -= n
    return len(bins)


def test_plans_place_everything_and_beat_first_fit():
    r = random.Random(8)
    for top in (60, 200, 512):
        counts = {n: r.randint(1, 20) for n in r.sample(range(1, top + 1), 50)}
        plan = packing.plan(dict(counts), 512)
        used = {}
        for times, pattern in plan:
            assert times > 0 and sum(n * k for n, k in pattern) <= 512
            for n, k in pattern:
                used[n] = used.get(n, 0) + k * times
        assert used == counts
        assert sum(t for t, _ in plan) <= first_fit_decreasing([n for n, c in counts.items() for _ in range(c)], 512)


@pytest.mark.parametrize("bucket_rows", [5, 500000])
def test_packing_a_table(spark, bucket_rows):
    r = random.Random(2)
    rows = [(i, r.choice([0, None, 7, 7, 7, 100, 101, r.randint(1, 300), 64 * 7]), 9, 3) for i in range(700)] + [(5, 7, 1, 1), (None, 7, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, n int, container int, capacity int").repartition(5)
    got = packing.pack(df, "doc_id", "n", [64, 256], bucket_rows).collect()
    for cap in (64, 256):
        each = [x for x in got if x["capacity"] == cap]
        fill = {}
        for x in each:
            fill[x["container"]] = fill.get(x["container"], 0) + x["size"]
            assert x["start"] == x["piece"] * cap
        total = sum(n or 0 for _, n, *_ in rows)
        assert max(fill.values()) <= cap and sum(fill.values()) == total and set(fill) == set(range(len(fill)))
        assert len(fill) <= first_fit_decreasing([x["size"] for x in each], cap)
        assert len(each) == sum(max(1, -(-(n or 0) // cap)) for _, n, *_ in rows)
    assert packing.pack(df.limit(0), "doc_id", "n", [64]).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, "doc_id", "n", [])
