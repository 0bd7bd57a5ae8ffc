import io
import random
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from calorgrid.functions import geometry as g
from calorgrid.functions.grading import judged, ladder, ladder_with_fallback
from calorgrid.functions.numeric import bar, to_byte
from calorgrid.operators import match, raster, sampling, similarity, stats, windows
from calorgrid.sources import flir, labels, sinks
from calorgrid.streaming import runs


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_ladders_at_their_steps(spark):
    got = one(spark, *[ladder(F.lit(v), (5, 15, 40)) for v in (4.999, 5.0, 15.0, 40.0)], ladder(F.lit(None).cast("double"), (5, 15, 40)))
    assert got == ("normal", "caution", "abnormal", "critical", "normal")
    assert one(spark, ladder_with_fallback(F.lit(2.0), F.lit(50.0), (5, 15, 40), (5, 15, 40)))[0] == "critical"
    null = F.lit(None).cast("double")
    steps = [F.lit(5.0), F.lit(15.0), F.lit(40.0)]
    cases = [("ABS", 16.0, 10.0, null), ("PHASE", 60.0, 20.0, F.lit(58.0)), ("PHASE", 60.0, 20.0, null), ("AMB", 60.0, 20.0, F.lit(58.0))]
    got = [one(spark, *judged(F.lit(t), F.lit(a), p, F.lit(m), steps, (15.0, 30.0, 50.0))) for m, t, a, p in cases]
    assert got == [("abnormal", "value"), ("normal", "peer"), ("abnormal", "ambient, no peer"), ("critical", "ambient")]


def test_boxes(spark):
    box = [F.lit(x) for x in (10.5, 20.5, 30.5, 41.5)]
    back = g.corners(*g.shares(*box, 320, 240), 320, 240)
    assert one(spark, *back) == pytest.approx((10.5, 20.5, 30.5, 41.5))
    assert one(spark, *g.ir_to_visual(*g.visual_to_ir(F.lit(7.0), F.lit(9.0)))) == pytest.approx((7, 9))
    neg = [F.lit(x) for x in (-1.7, 2.5, 3.5, 999.0)]
    assert one(spark, *g.pixel_window(neg, 320, 240)) == (0, 2, 4, 240)
    assert one(spark, *g.pixel_window(neg, 320, 240, "truncate")) == (0, 2, 3, 240)
    assert one(spark, g.iou(box, box), g.iou(box, [F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)])) == (1.0, 0.0)
    assert one(spark, g.osd_overlap([F.lit(2.0), F.lit(2.0), F.lit(100.0), F.lit(27.0)]))[0] == pytest.approx(1.0)
    assert one(spark, g.visual_box_to_ir([F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(10.0)]))[0] is None
    assert int((~raster.osd_mask()).sum()) == 8710
    assert one(spark, to_byte(F.lit(2.0), F.lit(0.0), F.lit(1.0)), to_byte(F.lit(0.5), F.lit(0.0), F.lit(1.0)), bar(F.lit(1), F.lit(2), 4)) == (255, 127, "##")


def boxes(seed=3):
    r = random.Random(seed)
    out = []
    for i in range(120):
        x, y = r.randint(0, 30), r.randint(0, 30)
        out.append((i, f"f{r.randint(0, 5)}", r.randint(0, 2), float(x), float(y), float(x + r.randint(5, 20)), float(y + r.randint(5, 20))))
    return out


SCHEMA = "i int, f string, cls int, x1 double, y1 double, x2 double, y2 double"


def overlap(a, b):
    w, h = min(a[5], b[5]) - max(a[3], b[3]), min(a[6], b[6]) - max(a[4], b[4])
    if w <= 0 or h <= 0:
        return 0.0
    return w * h / ((a[5] - a[3]) * (a[6] - a[4]) + (b[5] - b[3]) * (b[6] - b[4]) - w * h)


def test_greedy_matches_against_a_plain_loop(spark):
    a, b = boxes(3), boxes(4)
    want, used = set(), set()
    for x in a:
        best = max(((overlap(x, y), -y[0]) for y in b if y[1] == x[1] and y[2] == x[2] and y[0] not in used), default=(0, 0))
        if best[0] >= 0.4:
            used.add(-best[1])
            want.add((x[1], x[0], -best[1]))
    left, right = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    m = match.greedy_matches(left, right, "f", "i", 0.4)
    assert {tuple(r)[:3] for r in m.collect()} == want
    scores = {r["cls"]: r for r in match.match_scores(left, right, m, "f", "i").collect()}
    assert scores[None]["tp"] == len(want) and scores[None]["touch"] == 240 - 2 * len(want)
    assert match.greedy_matches(left.limit(0), right, "f", "i").count() == 0


def test_merging_is_a_fixpoint(spark):
    rows = [(0, "a", 1, 0.0, 0.0, 10.0, 10.0), (1, "a", 1, 1.0, 30.0, 11.0, 50.0), (2, "a", 1, 2.0, 80.0, 9.0, 99.0), (3, "a", 2, 0.0, 0.0, 10.0, 10.0), (4, "b", 1, 0.0, 0.0, 5.0, 5.0), (5, "b", 1, 100.0, 0.0, 105.0, 5.0)]
    once = match.merge_split_boxes(spark.createDataFrame(rows, SCHEMA).select("f", "i", "cls", "x1", "y1", "x2", "y2"), "f", "i", [1])
    got = sorted(tuple(r) for r in once.collect())
    assert got == [("a", 0, 1, 0.0, 0.0, 11.0, 99.0), ("a", 3, 2, 0.0, 0.0, 10.0, 10.0), ("b", 4, 1, 0.0, 0.0, 5.0, 5.0), ("b", 5, 1, 100.0, 0.0, 105.0, 5.0)]
    assert sorted(tuple(r) for r in match.merge_split_boxes(once, "f", "i", [1]).collect()) == got


def test_kappa_and_windows(spark):
    rows = [("x", "x")] * 20 + [("x", "y")] * 5 + [("y", "x")] * 10 + [("y", "y")] * 15 + [(None, "x")]
    k = match.kappa(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()
    assert (k["n"], k["agreement"], k["kappa"]) == (50, 0.7, pytest.approx(0.4))
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate([9, 9, 1, 9, 1, 9, 9, 9])], "k string, o int, v int")
    assert sorted(r["length"] for r in windows.run_lengths(df, ["k"], ["o"], F.col("v") > 5).collect()) == [1, 2, 3]
    peers = spark.createDataFrame([("a", 1.0, 0), ("a", 3.0, 0), ("a", 99.0, 1), (None, 5.0, 0), ("b", 1.0, 0)], "s string, t double, spike int")
    got = {(r["s"], r["t"]): r["peer"] for r in windows.with_peer_median(peers, ["s"], "t", F.col("spike") == 0).collect()}
    assert got == {("a", 1.0): 2.0, ("a", 3.0): 2.0, ("a", 99.0): 2.0, (None, 5.0): None, ("b", 1.0): None}
    deal = spark.createDataFrame([("p", d, i, i == 7) for i, d in enumerate("aaaabbcd")], "p string, d string, i int, keep boolean")
    got = windows.round_robin(deal, "p", "d", [F.col("i")], 4, F.col("keep")).orderBy("pick")
    assert [r["i"] for r in got.collect()] == [7, 0, 4, 6]
    assert [r["i"] for r in windows.stride(deal, ["p"], ["i"], 3).orderBy("i").collect()] == [0, 3, 6]
    assert windows.middle_member(deal, ["p"], ["i"]).first()["i"] == 4


def flood(hot, eight):
    seen, k = np.zeros(hot.shape, int), 0
    for s in zip(*np.nonzero(hot), strict=True):
        if not seen[s]:
            k += 1
            todo = [s]
            seen[s] = k
            while todo:
                y, x = todo.pop()
                for dy in (-1, 0, 1):
                    for dx in (-1, 0, 1):
                        v, u = y + dy, x + dx
                        if (eight or dy * dx == 0) and 0 <= v < hot.shape[0] and 0 <= u < hot.shape[1] and hot[v, u] and not seen[v, u]:
                            seen[v, u] = k
                            todo.append((v, u))
    return seen


@pytest.mark.parametrize("neighbours", [4, 8])
def test_components_of_rasters(neighbours):
    rng = np.random.default_rng(0)
    for _ in range(30):
        hot = rng.random((12, 17)) < 0.45
        assert (raster.label_components(hot, neighbours) == flood(hot, neighbours == 8)).all()
    assert raster.label_components(np.zeros((3, 3), bool)).max() == 0


def test_raster_kernels():
    rng = np.random.default_rng(1)
    image = rng.normal(size=(40, 50))
    ncc, x, y = raster.masked_ncc(image[7:19, 11:30], np.ones((12, 19), bool), image)
    assert (x, y) == (11, 7) and ncc == pytest.approx(1)
    assert raster.best_scale(np.kron(image[10:20, 10:25], np.ones((1, 1))), np.ones((10, 15), bool), image, np.array([1.0, 1.2]))[1] == 1.0
    assert raster.area_resize(np.ones((7, 9)), 4, 3) == pytest.approx(np.ones((3, 4)))
    assert raster.area_resize(np.arange(16.0).reshape(4, 4), 2, 2)[0, 0] == 2.5
    spike = np.zeros((9, 9))
    spike[4, 4] = 9
    assert raster.median_filter(spike).max() == 0 and raster.edges(spike)[4, 4] == 72
    assert (raster.degrade(image, 10, 8, 3) == raster.degrade(image, 10, 8, 3)).all()
    ref, found = raster.blobs(np.where(spike > 0, 50.0, 20.0), np.ones((9, 9), bool), 5, 1)
    assert ref == 20 and found == [(4, 4, 5, 5, 1, 50.0, 50.0, 30.0)]
    assert raster.blobs(np.full((2, 2), np.nan), np.ones((2, 2), bool), 5)[1] == []


def png(raw, kinds=(0, 1, 2, 3, 4)):
    h, w = raw.shape
    lines, before = b"", np.zeros(2 * w, int)
    for y in range(h):
        now = np.frombuffer(raw[y].astype(">u2").tobytes(), np.uint8).astype(int)
        kind, out = kinds[y % len(kinds)], np.zeros(2 * w, int)
        for x in range(2 * w):
            a, b, c = (now[x - 2] if x > 1 else 0), before[x], (before[x - 2] if x > 1 else 0)
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            out[x] = (now[x] - (0, a, b, (a + b) // 2, paeth)[kind]) % 256
        lines += bytes([kind]) + bytes(out.tolist())
        before = now
    chunk = lambda n, d: struct.pack(">I", len(d)) + n + d + struct.pack(">I", zlib.crc32(n + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 16, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def picture(raw):
    record = bytearray(0x320)
    for k, v in {"emissivity": 0.95, "distance": 1.0, "refl_temp": 293.15, "r1": 16000.0, "b": 1400.0, "f": 1.0, "fov": 25.0, "r2": 0.012}.items():
        struct.pack_into("<f", record, flir._FLOATS[k], v)
    struct.pack_into("<i", record, 0x308, -7000)
    record[0xD4:0xDA] = b"Model1"
    image = b"\0" * 32 + png(raw)
    parts = [(flir.RAW, image), (flir.CAMERA, bytes(record)), (flir.RAW, b"second")]
    at, table, body = 0x40 + 32 * len(parts), b"", b""
    for kind, data in parts:
        table += struct.pack(">HHIIII", kind, 0, 0, 0, at + len(body), len(data)).ljust(32, b"\0")
        body += data
    fff = b"FFF\0".ljust(0x18, b"\0") + struct.pack(">II", 0x40, len(parts))
    fff = fff.ljust(0x40, b"\0") + table + body
    half = len(fff) // 2
    seg = lambda i, d: b"\xff\xe1" + struct.pack(">H", len(d) + 10) + b"FLIR\0\x01" + bytes([i, 1]) + d
    return b"\xff\xd8" + seg(1, fff[half:]) + seg(0, fff[:half]) + b"\xff\xda rest"


def test_radiometric_pictures(spark, tmp_path):
    raw = np.random.default_rng(2).integers(9000, 20000, (10, 12)).astype(np.uint16)
    assert (flir.png16(png(raw)) == raw).all()
    (tmp_path / "a.jpg").write_bytes(picture(raw))
    (tmp_path / "b.jpg").write_bytes(b"nothing")
    got = {r["path"].rpartition("/")[2]: r for r in flir.read_pictures(spark, str(tmp_path)).collect()}
    assert got["b.jpg"]["temp"] is None and "JPEG" in got["b.jpg"]["error"]
    a = got["a.jpg"]
    assert a["error"] is None
    assert (a["height"], a["width"], a["error"], a["meta"]["model"]) == (10, 12, None, "Model1")
    assert np.allclose(a["temp"], flir.celsius(raw, a["meta"].asDict()).ravel(), rtol=1e-4)
    assert np.allclose(flir.celsius(raw, a["meta"].asDict()), flir.celsius(raw, a["meta"].asDict()))
    assert flir.centikelvin(np.array([29815])) == pytest.approx([25.0])


def test_label_sources_and_sinks(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l/A_1.txt").write_text("3 0.5 0.5 0.1 0.1\n\n4 0.1 0.2 0.3 0.4 0.9\nbad\n")
    (tmp_path / "l/classes.txt").write_text("x\n\ny\n")
    loose, strict = labels.read_boxes(spark, str(tmp_path / "l")).collect(), labels.read_boxes(spark, str(tmp_path / "l"), True).collect()
    assert [(r["stem"], r["box_idx"], r["cls"]) for r in loose] == [("A_1", 0, 3), ("A_1", 2, 4)] and len(strict) == 1
    assert [tuple(r) for r in labels.read_names(spark, str(tmp_path / "l/classes.txt")).collect()] == [(0, "x"), (1, "y")]
    text = sinks.label_texts(labels.read_boxes(spark, str(tmp_path / "l")), "stem", "box_idx").first()["text"]
    assert text == "3 0.500000 0.500000 0.100000 0.100000\n4 0.100000 0.200000 0.300000 0.400000\n"
    rows = [("a&b.jpg", 0, "lug <1>", -5.0, 1.0, 20.0, 30.126), ("a&b.jpg", 1, "bar", 3.0, 4.0, 5.0, 6.0), ("empty.jpg", None, None, None, None, None, None)]
    xml = sinks.annotation_xml(spark.createDataFrame(rows, "name string, i int, label string, x1 double, y1 double, x2 double, y2 double"), "name", "i", "label", 320, 240)
    sinks.write_annotation_xml(xml, str(tmp_path / "xml"))
    back = labels.read_annotation_xml(spark, str(tmp_path / "xml")).orderBy("name", "box_idx").collect()
    assert [(r["name"], r["label"], r["x1"], r["y2"], r["valid"]) for r in back] == [("a&b.jpg", "lug <1>", 0.0, 30.13, True), ("a&b.jpg", "bar", 3.0, 6.0, True), ("empty.jpg", None, None, None, None)]
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        z.writestr("d/x.txt", "1 2 3 4 5")
        z.writestr("d/x.jpg", "no")
    (tmp_path / "z.zip").write_bytes(blob.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    assert [r["member"] for r in labels.read_archives(spark, str(tmp_path)).collect()] == ["d/x.txt"]
    (tmp_path / "c.csv").write_bytes("﻿id,problem\n# remark\n1,한글\n".encode())
    assert [r.asDict() for r in labels.read_csv(spark, str(tmp_path / "c.csv"), "#").collect()] == [{"id": "1", "problem": "한글"}]
    (tmp_path / "i.json").write_text('[{"stem": "a", "t": 1.5}, {"stem": "b", "t": null}]')
    assert labels.read_index(spark, str(tmp_path / "i.json"), "stem string, t double").count() == 2
    (tmp_path / "log.csv").write_text("epoch, metrics/mAP50(B), metrics/precision(B)\n0, 0.5, 0.25\n")
    log = labels.training_log(labels.read_csv(spark, str(tmp_path / "log.csv")), {"map": "mAP50(B)", "p": "precision"})
    assert tuple(log.first()) == (0.5, 0.25)
    (tmp_path / "l/._A.txt").write_text("x")
    assert {r["file"] for r in labels.list_files(spark, str(tmp_path / "l"), glob="*.txt").collect()} == {"A_1.txt", "classes.txt"}


def test_incremental_and_split_sinks(spark, tmp_path):
    df = spark.createDataFrame([(i, "train" if i < 3 else "val", [i]) for i in range(5)], "k int, split string, xs array<int>")
    out = str(tmp_path / "o")
    assert [sinks.append_missing(df.where("k < 3"), out, "k"), sinks.append_missing(df, out, "k"), sinks.append_missing(df, out, "k")] == [3, 2, 0]
    assert spark.read.parquet(out).count() == 5 and sinks.append_missing(df, out, "k", True) == 5
    assert {tuple(r) for r in sinks.write_split_dataset(df, str(tmp_path / "s")).collect()} == {("train", 3), ("val", 2)}
    kept, stale = sinks.keep_only(df, df.where("k > 3"), "k")
    assert (kept.count(), stale.count()) == (1, 4)
    sinks.write_report_csv(df, str(tmp_path / "r"), bom=True)
    assert labels.read_csv(spark, str(tmp_path / "r")).columns == ["k", "split"]
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 5


def test_partners_leaders_and_hashes(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=16)], i % 3) for i in range(150)] + [(200, None, 0), (201, [0.0] * 16, 1)]
    df = spark.createDataFrame(rows, "id int, v array<float>, b int")
    got = {(r["query"], r["place"]): r["partner"] for r in similarity.best_partners(df, df, "id", "v", "b", 2, tile=20).collect()}
    for i, v, b in rows[:150]:
        scores = sorted(((-float(np.float32(v).astype(float) @ np.float32(w).astype(float)), j) for j, w, c in rows if c == b and j != i and w))
        assert [got[i, 1], got[i, 2]] == [scores[0][1], scores[1][1]]
    lead = {r["id"]: r["leader"] for r in similarity.leaders(df, "id", "v", "b", 0.4).collect()}
    assert lead[200] == 200 and lead[201] == 201 and lead[0] == 0 and all(k >= v for k, v in lead.items())
    codes = [(i, int(x)) for i, x in enumerate(rng.integers(-(1 << 62), 1 << 62, 60))]
    codes += [(100 + i, c ^ (1 << (i % 60)) ^ (1 << (i * 7 % 60))) for i, c in codes[:20]] + [(300, None), (301, codes[0][1])]
    near = {tuple(r)[:2] for r in similarity.near_hashes(spark.createDataFrame(codes, "id int, c long"), "id", "c", 3).collect()}
    assert near == {(i, j) for i, a in codes for j, b in codes if i < j and a is not None and b is not None and a != b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3 and j != 301}


def test_samples(spark):
    df = spark.createDataFrame([(i, f"s{i % 3}", f"c{i % 4}") for i in range(90)], "i int, s string, c string")
    one_way, other = (sampling.per_group(x, ["s"], ["i"], 5).collect() for x in (df, df.repartition(7)))
    assert sorted(one_way) == sorted(other) and len(one_way) == 15
    held = sampling.balanced_sessions(df, "s", "c", 0.3)
    assert len(held) == 1 and sampling.balanced_sessions(df.where("s = 's1'"), "s", "c") == []
    assert sampling.leave_one_out(df, "s", ["s0", "s1", "s2"]).where("split = 'val'").count() == 90
    assert sampling.cross_review(df, "s", "i", {"s0": "s1", "s1": "s2", "s2": "s0"}).where("role = 'cross'").count() == 9
    moved = sampling.jittered(df.withColumn("x", F.lit(0.0)), ["x"], "i", 2.0).agg(F.max("x"), F.min("x")).first()
    assert 1 < moved[0] <= 2 and -2 <= moved[1] < -1


def test_statistics_of_nothing(spark):
    none = spark.createDataFrame([], "g string, v double, w double")
    assert stats.ambient_by_percentile(none, ["g"], "v").count() == stats.ambient_by_rank(none, ["g"], "v").count() == stats.frame_statistics(none, ["g"], "v").count() == 0
    assert stats.linear_fit(none, ["g"], "v", "w").count() == stats.histogram(none, "v", (0, 5)).count() == 0
    few = spark.createDataFrame([("a", 1.0, 2.0), ("a", None, 1.0), (None, 3.0, 1.0)], "g string, v double, w double")
    assert {r["g"] for r in stats.rolled_up(few, "g", [F.count("v").alias("n")]).collect()} == {"a", "(none)", "(all)"}
    assert stats.quality_gated(few, "v", 2.0, 5).count() == 3 and stats.quality_gated(few, "v", 2.0, 1).count() == 1


def stream(spark, tmp_path, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        del i
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def drain(spark, df, name, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    return [tuple(r) for r in spark.sql(f"select * from {name}").collect()]


def test_streams(spark, tmp_path):
    schema = "k string, o long, ts timestamp, v double"
    from datetime import datetime, timedelta

    t = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    s = stream(spark, tmp_path, [[("a", i, t(i), v) for i, v in enumerate([9.0, 9.0, 1.0, 9.0])], [("a", 4, t(4), 9.0), ("a", 5, t(5), 1.0), ("a", 900, t(900), 9.0)]], schema)
    assert sorted(drain(spark, runs.run_counter(s, "k", "o", "v", 5.0), "rc")) in ([("a", 0, 2), ("a", 3, 2)], [("a", 0, 2), ("a", 3, 1), ("a", 4, 1)])
    assert {r[3] for r in drain(spark, runs.hot_sessions(s, "k", "ts", "v", 5.0, "3 minutes", "10 minutes"), "hs")} <= {4, 3, 2, 1}
    assert sum(r[2] for r in drain(spark, runs.windowed(s, "k", "ts", "v"), "w", "complete")) == 7
    rules = spark.createDataFrame([("a", 2.0, 5.0, 8.0)], "k string, caution double, warn double, critical double")
    assert sorted(r[-1] for r in drain(spark, runs.graded(s, rules, "k", "v"), "gr"))[0] == "critical"
    assert len(drain(spark, runs.unseen(s, "o", "ts"), "un")) == 7
    runs.into(s, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7
