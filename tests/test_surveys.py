"""Box statistics, remaps, merging, forms and agreement on small and odd inputs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from calorgrid.operators import audits, boxstats, match, raster, remap, sampling

BOX = "frame string, box int, x1 double, y1 double, x2 double, y2 double, n_px string"


@pytest.mark.parametrize("rounding,hidden,fallback,finite", [("half_even", (), False, True), ("truncate", ((0, 0, 4, 3), (8, 5, 12, 9)), False, True), ("half_even", ((0, 0, 20, 10),), True, True), ("half_even", ((0, 0, 4, 3),), False, False)])
def test_box_statistics_against_numpy(spark, rounding, hidden, fallback, finite):
    g = np.random.default_rng(3)
    r = random.Random(3)
    w, h = 12, 9
    frames = {f"f{k}": np.where(g.random((h, w)) < 0.1, np.nan if k else np.inf, g.normal(40, 9, (h, w))) for k in range(4)}
    boxes = [(r.choice(["f0", "f1", "f2", "f3", "none", None, "short"]), i, *(lambda x, y: (x, y, x + r.choice([0.4, 1.5, 2.5, 6, 30]), y + r.choice([0.4, 1.5, 3.5, 20])))(r.uniform(-3, 12), r.uniform(-3, 9)), "clash") for i in range(200)]
    rows = [(k, v.ravel().tolist(), 1) for k, v in frames.items()] + [("short", [1.0], 1), ("empty", None, 1), (None, [1.0] * (w * h), 1)]
    out = boxstats.box_statistics(spark.createDataFrame(rows, "frame string, raster array<double>, x1 int"), spark.createDataFrame(boxes, BOX).drop("n_px"), "frame", "raster", w, h, rounding, 2, 4, hidden, fallback, finite, few=20)
    got = {x["box"]: x for x in out.collect()}
    assert len(got) == 200
    mask = np.ones((h, w), dtype=bool)
    for a, b, c, d in hidden:
        mask[b:d, a:c] = False
    for frame, i, *box, _ in boxes:
        a, b, c, d = (int(round(v)) if rounding == "half_even" else int(v) for v in box)
        a, b, c, d = max(0, a), max(0, b), min(w, c), min(h, d)
        x = got[i]
        if frame not in frames or c - a < 2 or d - b < 2:
            assert x["t_p99"] is None
            continue
        part, m = frames[frame][b:d, a:c], mask[b:d, a:c]
        good = (lambda v: v[np.isfinite(v)]) if finite else (lambda v: v)
        v = good(part[m])
        if fallback and not len(v):
            v = good(part)
        if len(v) < 4:
            assert x["t_p99"] is None
        elif finite:
            assert (x["t_p99"], x["t_max"], x["t_mean"], x["n_px"]) == pytest.approx((np.percentile(v, 99), v.max(), v.mean(), len(v))) and x["low_confidence"] == (len(v) < 20)
        else:
            assert x["n_px"] == len(v)


def test_no_boxes_no_frames(spark):
    none = spark.createDataFrame([], "frame string, raster array<double>")
    b = spark.createDataFrame([("f", 1, 0.0, 0.0, 5.0, 5.0, "x")], BOX).drop("n_px")
    assert [x["n_px"] for x in boxstats.box_statistics(none, b, "frame", "raster", 8, 8).collect()] == [None]
    assert boxstats.box_statistics(none, b.limit(0), "frame", "raster", 8, 8).count() == 0


def test_registration(spark):
    g = np.random.default_rng(1)
    image = g.normal(size=(30, 40))
    part = image[7:17, 11:26]
    df = spark.createDataFrame([(1, part.ravel().tolist(), image.ravel().tolist()), (2, None, image.ravel().tolist()), (3, [1.0], image.ravel().tolist())], "id int, t array<double>, im array<double>")
    got = {x["id"]: (x["ncc"], x["scale"], x["x"], x["y"]) for x in raster.registered(df, "id", "t", (15, 10), "im", (40, 30), (0.8, 1.0, 1.2), ((0, 0, 3, 3),)).collect()}
    assert got[1][1:] == (1.0, 11, 7) and got[1][0] == pytest.approx(1) and got[2] == got[3] == (None,) * 4


def test_remaps(spark):
    known = remap.vocabulary(spark.createDataFrame([("a", 1), ("b", 2), (None, 9), ("b", 3)], "name string, cls int"), spark.createDataFrame([("b", 7), ("c", 8)], "name string, cls int"))
    assert sorted(map(tuple, known.collect())) == [("a", 1), ("b", 7), ("c", 8)]
    names = spark.createDataFrame([(0, "c"), (1, "zz"), (2, "a")], "id int, name string")
    rows = spark.createDataFrame([(0,), (1,), (2,), (5,), (None,)], "cls int")
    assert sorted((str(x["cls"]), x["new_cls"]) for x in remap.remap_by_name(rows, names, known).collect()) == [("0", 8), ("1", None), ("2", 1), ("5", None), ("None", None)]
    assert [tuple(x) for x in remap.unmatched(names, known).collect()] == [(1, "zz")]
    assert sorted(str(x["new_cls"]) for x in remap.remap_by_name(spark.createDataFrame([(1,), (4,)], "cls int"), None, known).collect()) == ["1", "None"]
    assert sorted(x["cls"] for x in remap.remap_by_index(rows, {0: 4, 1: 4}).collect()) == [4, 4]
    assert sorted(str(x["cls"]) for x in remap.remap_by_index(rows, {0: 4}, keep=True).collect()) == ["1", "2", "4", "5", "None"]
    assert remap.remap_by_index(rows, {}).count() == 0
    assert [x["cls"] for x in remap.chosen_classes(spark.createDataFrame([(1,), (7,)], "cls int"), known, ["b"]).collect()] == [7]
    with pytest.raises(ValueError, match="nope"):
        remap.chosen_classes(rows, known, ["a", "nope"])


def merged_plainly(boxes, least=0.6, gap=40):
    """From the first pair again after each joining, which goes to the end."""
    now = list(boxes)
    while True:
        for i, j in itertools.combinations(range(len(now)), 2):
            a, b = now[i], now[j]
            wide = (min(a[4], b[4]) - max(a[2], b[2])) / max(min(a[4] - a[2], b[4] - b[2]), 1e-9)
            if a[1] == b[1] and wide >= least and max(a[3], b[3]) - min(a[5], b[5]) <= gap:
                now = [x for k, x in enumerate(now) if k not in (i, j)] + [(min(a[0], b[0]), a[1], min(a[2], b[2]), min(a[3], b[3]), max(a[4], b[4]), max(a[5], b[5]))]
                break
        else:
            return now


def test_joining_of_split_boxes_in_order(spark):
    r = random.Random(5)
    frames = {}
    for f in range(60):
        frames[f"f{f}"] = [(i, r.choice([1, 1, 2]), x, y, x + r.uniform(5, 60), y + r.uniform(5, 40)) for i, (x, y) in enumerate((r.uniform(0, 90), r.uniform(0, 200)) for _ in range(r.randint(1, 12)))]
    rows = [(f, *b) for f, bs in frames.items() for b in bs] + [("g", 0, 9, 0.0, 0.0, 1.0, 1.0), ("g", 1, None, 0.0, 0.0, 1.0, 1.0)]
    out = match.merge_split_boxes(spark.createDataFrame(rows, "frame string, idx int, cls int, x1 double, y1 double, x2 double, y2 double").repartition(4), "frame", "idx", [1, 2]).collect()
    want = [(f, *b) for f, bs in frames.items() for b in merged_plainly(bs)]
    assert sorted(tuple(x) for x in out if x["frame"] != "g") == sorted(want) and sum(x["frame"] == "g" for x in out) == 2


def test_forms_checks_and_agreement(spark):
    files = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None), ("e", "z")], "name string, content string")
    digest = files.select("name", F.sha2("content", 256).alias("sha256")).where("name in ('a')").unionByName(spark.createDataFrame([("b", "0"), ("c", "0"), ("d", "1")], "name string, sha256 string"))
    assert dict(map(tuple, audits.manifest_check(files, digest, "name", "content").collect())) == {"a": "same", "b": "changed", "c": "changed", "d": "missing", "e": "unlisted"}
    assert tuple(audits.weighted_score(spark.createDataFrame([], "s double, m double"), "s", "m").first()) == (0.0, 0.0, None)
    form = spark.createDataFrame([("clear a", "a", "far"), ("clear b", "a", None), ("mixed", "a", "odd"), (" ", "a", "odd"), (None, "a", "odd")], "v string, l string, r string")
    assert tuple(audits.form_scores(form, "v", "l", "r", ["far"]).first()) == (3, 2, 1, 1, 1, pytest.approx(200 / 3))
    assert audits.form_scores(form.limit(0), "v", "l", "r", ["far"]).first()["pct"] is None
    rows = spark.createDataFrame([("f", "a", 1), ("f", "b", 1), ("f", "c", 1), ("g", "a", 1), ("g", "b", 2), ("g", "c", None), ("h", None, 1)], "s string, w string, v int")
    every, pairs, differ = audits.verdict_agreement(rows, "s", "w", "v")
    assert tuple(every.first()) == (1, 1, 1.0) and {(x["a"], x["b"]): (x["frames"], x["agreed"]) for x in pairs.collect()} == {("a", "b"): (2, 1), ("a", "c"): (1, 1), ("b", "c"): (1, 1)}
    assert [tuple(x) for x in differ.collect()] == [("g", "a: 1 / b: 2")]
    key = lambda *v: spark.createDataFrame([(x,) for x in v], "k string")
    labels = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1), ("z", 0)], "k string, n int")
    assert sorted(map(tuple, audits.skip_hygiene(key("a", "b", "c"), labels, key("b", "y"), "k", "n").collect())) == [("a", "no record"), ("y", "unknown"), ("z", "unknown")]


def test_patches_lie_inside(spark):
    df = spark.range(50).withColumn("x", F.lit("clash"))
    got = sampling.patches(df.drop("x"), "id", 24, 20, 12, 3, 9, ((0, 0, 5, 12),)).collect()
    assert all(5 <= x["x"] and x["x"] + x["side"] <= 20 and 0 <= x["y"] and x["y"] + x["side"] <= 12 and 3 <= x["side"] <= 9 for x in got)
    assert 200 < len(got) < 1200 and sampling.patches(df.limit(0).drop("x"), "id", 3, 9, 9, 1, 2).count() == 0
