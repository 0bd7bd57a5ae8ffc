"""Pictures of other kinds, archives with errors, sinks that count and clean up, a cached bank, a stream against it."""

import io
import json
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from calorgrid.functions.numeric import standardised
from calorgrid.sources import bank, flir, labels, sinks
from calorgrid.streaming import runs
from test_operators import picture, png


def tiff(raw, order="<", packing=1, differ=False, strip=3):
    h, w = raw.shape
    rows = raw.copy()
    if differ:
        rows[:, 1:] = raw[:, 1:] - raw[:, :-1]
    data = rows.astype(order + "u2")
    parts = [data[y : y + strip].tobytes() for y in range(0, h, strip)]
    if packing == 8:
        parts = [zlib.compress(p) for p in parts]
    if packing == 32773:
        parts = [b"".join(bytes([len(p[k : k + 100]) - 1]) + p[k : k + 100] for k in range(0, len(p), 100)) + b"\x80" for p in parts]
    body, offsets = b"", []
    for p in parts:
        offsets.append(8 + len(body))
        body += p
    tags = [(256, 3, [w]), (257, 4, [h]), (258, 3, [16]), (259, 3, [packing]), (273, 4, offsets), (277, 3, [1]), (279, 4, [len(p) for p in parts]), (282, 5, [1]), (317, 3, [2 if differ else 1])]
    at = 8 + len(body)
    extra, table = b"", b""
    base = at + 2 + 12 * len(tags) + 4
    for tag, kind, v in tags:
        form = {3: "H", 4: "I", 5: "I"}[kind]
        packed = struct.pack(f"{order}{len(v)}{form}", *v)
        if len(packed) > 4:
            table += struct.pack(order + "HHII", tag, kind, len(v), base + len(extra))
            extra += packed
        else:
            table += struct.pack(order + "HHI", tag, kind, len(v)) + packed.ljust(4, b"\0")
    return (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "I", at) + body + struct.pack(order + "H", len(tags)) + table + b"\0" * 4 + extra


@pytest.mark.parametrize("order,packing,differ", [("<", 1, False), (">", 1, False), ("<", 8, True), (">", 8, False), ("<", 32773, False)])
def test_tiff(order, packing, differ):
    raw = np.random.default_rng(1).integers(0, 65536, (7, 9)).astype(np.uint16)
    assert (flir.tiff16(tiff(raw, order, packing, differ)) == raw).all()


def test_pictures_in_centikelvin(spark, tmp_path):
    raw = np.full((4, 5), 29815, dtype=np.uint16)
    (tmp_path / "a.tiff").write_bytes(tiff(raw))
    (tmp_path / "b.tif").write_bytes(tiff(raw)[:60])
    (tmp_path / "c.tif").write_bytes(b"x")
    got = {r["path"].rpartition("/")[2]: r for r in flir.read_centikelvin(spark, str(tmp_path)).collect()}
    assert (got["a.tiff"]["height"], got["a.tiff"]["width"]) == (4, 5) and np.allclose(got["a.tiff"]["temp"], 25) and got["a.tiff"]["error"] is None
    assert all(got[k]["error"] and got[k]["temp"] is None for k in ("b.tif", "c.tif"))


def test_embedded_picture_and_magic(spark, tmp_path):
    raw = np.random.default_rng(2).integers(9000, 20000, (6, 8)).astype(np.uint16)
    assert all((flir.png16(png(raw, (k,))) == raw).all() for k in range(5))
    with pytest.raises(ValueError, match="container"):
        flir.records(b"XXX\0" + b"\0" * 60)
    (tmp_path / "a.jpg").write_bytes(picture(raw))
    assert flir.read_pictures(spark, str(tmp_path)).first()["visual"] is None
    keep = flir.segments
    blob = keep(picture(raw))
    grown = bytearray(blob) + b"head\xff\xd8\xffvisual"
    offset, count = struct.unpack_from(">II", grown, 0x18)
    table = bytes(grown[offset : offset + 32 * count])
    entry = struct.pack(">HHIII", flir.EMBEDDED, 0, 0, 0, len(blob)).ljust(16, b"\0")[:12] + struct.pack(">II", len(blob), 13)
    more = bytes(grown) + table + entry.ljust(32, b"\0")
    more = bytearray(more)
    struct.pack_into(">II", more, 0x18, len(grown), count + 1)
    assert flir.records(bytes(more))[flir.EMBEDDED] == b"head\xff\xd8\xffvisual"


def test_archives_tell_their_errors(spark, tmp_path):
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        z.writestr("d/x.txt", "1 2 3 4 5")
    (tmp_path / "z.zip").write_bytes(blob.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    (tmp_path / "y.txt").write_text("6")
    got = {((r["archive"] or "").rpartition("/")[2], (r["member"] or "").rpartition("/")[2]): (r["content"], r["error"] is None) for r in labels.read_members(spark, str(tmp_path)).collect()}
    assert got == {("z.zip", "x.txt"): ("1 2 3 4 5", True), ("bad.zip", ""): (None, False), ("", "y.txt"): ("6", True)}


def test_forms_and_first_sources(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,verdict\n1,clear\n2, \n3,\n")
    assert [r["id"] for r in labels.read_review_form(spark, str(tmp_path / "f.csv")).collect()] == ["1"]
    assert labels.detect_source(spark.createDataFrame([("x", "usb")], "stem string, source string")) == "usb"
    assert labels.detect_source(spark.createDataFrame([("x",)], "stem string")) == labels.detect_source(spark.createDataFrame([("x", None)], "stem string, source string")) == "embedded"


def test_documents_manifests_and_vacuum(spark, tmp_path):
    df = spark.createDataFrame([(2, "나", [1, 2]), (1, None, []), (3, "x", None)], "k int, s string, xs array<int>")
    sinks.write_json_array(df.repartition(3), str(tmp_path / "j"), ["k"])
    files = list((tmp_path / "j").glob("part-*"))
    assert len(files) == 1 and json.loads(files[0].read_text()) == [{"k": 1, "s": None, "xs": []}, {"k": 2, "s": "나", "xs": [1, 2]}, {"k": 3, "s": "x", "xs": None}]
    sinks.write_json_array(df.limit(0), str(tmp_path / "e"), ["k"])
    assert json.loads(next((tmp_path / "e").glob("part-*")).read_text()) == []
    assert sinks.write_report_csv(df, str(tmp_path / "c")) == ["xs"]
    text = sinks.write_manifest(spark, str(tmp_path / "m"), "/data", ["train", "val"], ['a "b"', "나"])
    assert next((tmp_path / "m").glob("part-*")).read_text().strip() == text and '  0: "a \\"b\\""' in text and '  1: "나"' in text
    out = str(tmp_path / "v")
    df.write.parquet(out)
    assert sinks.vacuum(spark, out, spark.createDataFrame([(1,), (3,), (9,)], "k int"), "k") == 1
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [1, 3] and sinks.vacuum(spark, out, df, "k") == 0
    boxes = spark.createDataFrame([("a", "lug", True), ("a", "bar", False), ("b", "lug", None), ("c", None, None)], "name string, label string, human boolean")
    counts, used = sinks.annotation_counts(spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "name string"), boxes, "name", "label", "human")
    assert tuple(counts.first()) == (1, 1, 2, 3) and sorted(map(tuple, used.collect())) == [("bar", 1), ("lug", 2)]


def test_bank_and_stream(spark, tmp_path):
    g = np.random.default_rng(6)
    rows = [(i, i % 2, g.normal(size=64).tolist()) for i in range(12)] + [(99, 0, None)]
    frames = spark.createDataFrame(rows, "ident int, day int, v array<double>")
    made = []
    make = lambda df: made.append(1) or bank.descriptors(df, "ident", "v", 8, 8, (4, 4)).join(df.select("ident", "day"), "ident")
    path = str(tmp_path / "bank")
    first = bank.cached_bank(frames, path, make)
    assert bank.cached_bank(frames, path, make).count() == 13 and len(made) == 1
    assert bank.cached_bank(frames.where("ident < 5"), path, make).count() == 5 and len(made) == 2
    full = bank.cached_bank(frames, path, make)
    assert len(made) == 3 and first.columns == full.columns
    full.where("ident in (3, 4)").select("day", F.col("descriptor").alias("q")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("day int, q array<double>").parquet(str(tmp_path / "in"))
    runs.into(runs.matched(stream, full, "day", "q", 0.99), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r["ident"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [3, 4]
    assert standardised(F.col("q")) is not None


def test_calibrations_and_empty_labels(spark):
    from calorgrid.functions import geometry as g

    by = g.calibration('{"scale": 2.0, "x0": 10}')
    assert by == (2.0, 10.0, float(g.Y0)) and g.calibration("{}") == (g.SCALE, g.X0, g.Y0)
    x, y = g.visual_to_ir(F.lit(100.0), F.lit(100.0), by)
    there = spark.range(1).select(x.alias("x"), y.alias("y"))
    back = there.select(*[c.alias(n) for c, n in zip(g.ir_to_visual(F.col("x"), F.col("y"), by), "xy", strict=True)]).first()
    assert there.first()["x"] == 40.0 and tuple(back) == (100.0, 100.0)
    boxes = spark.createDataFrame([("a", 0, 1, 0.5, 0.5, 0.1, 0.1), ("z", 0, 1, 0.5, 0.5, 0.1, 0.1)], "stem string, i int, cls int, cx double, cy double, w double, h double")
    kept = {r["stem"]: r["text"] for r in sinks.label_texts(boxes, "stem", "i", keep=spark.createDataFrame([("a",), ("b",), ("b",)], "stem string")).collect()}
    assert set(kept) == {"a", "b"} and kept["b"] == "" and kept["a"].count("\n") == 1


def test_made_pictures_are_read_back(spark):
    from calorgrid.plans.surveys import _CAMERA
    from calorgrid.sources import made

    g = np.random.default_rng(9)
    for shape in ((1, 1), (7, 5), (240, 320)):
        raw = g.integers(9000, 20000, shape).astype(np.uint16)
        assert (flir.png16(made.png16(raw)) == raw).all() and (flir.tiff16(made.tiff16(raw)) == raw).all()
        meta, temp, visual = flir.decode(made.picture(raw, _CAMERA, b"head\xff\xd8\xffbody"))
        assert temp.shape == shape and visual == b"\xff\xd8\xffbody" and (meta["model"], meta["o"], meta["real2ir"]) == ("trial", -7000, 1.0)
        assert np.allclose(temp, flir.celsius(raw, meta))
    rows = [(1, made.picture(raw, _CAMERA)), (2, None), (3, b"\xff\xd8\xff\xda"), (4, made.picture(raw, _CAMERA)[:500])]
    got = {r["path"]: r for r in flir.decoded(spark.createDataFrame(rows, "id int, content binary"), "id", "content").collect()}
    assert got["1"]["error"] is None and got["1"]["visual"] is None and all(got[k]["error"] and got[k]["temp"] is None for k in "234")
    bad = flir.decoded_centikelvin(spark.createDataFrame([(1, None), (2, b"II*\0\xff\xff\xff\xff")], "id int, content binary"), "id", "content").collect()
    assert all(r["error"] and r["temp"] is None for r in bad)
