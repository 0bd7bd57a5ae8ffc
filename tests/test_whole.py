"""Rows that were once lost: copies, detections with a value missing, folds beyond a bound."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from calorgrid.operators import sampling, similarity


def test_copies_keep_their_class(spark, tmp_path):
    up, down = [float(i) for i in range(64)], [float(-i) for i in range(64)]
    near = [*up[:63], 0.0]
    rows = [(1, up), (2, down), (3, up), (4, near), (5, near), (6, up), (7, None), (8, None), (9, [float("nan")] * 64), (10, [])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = entry.queries()["perceptual_near_duplicates"](spark, str(tmp_path)).collect()
    assert sorted((r["id_a"], r["id_b"]) for r in got if r["kind"] == "member") == [(1, 1), (1, 3), (1, 6), (2, 2), (4, 4), (4, 5)]
    assert [(r["id_a"], r["id_b"]) for r in got if r["kind"] == "near"] == [(1, 4)]
    codes = spark.createDataFrame([(3, "x"), (2, "x"), (5, "y"), (7, None)], "id int, c string")
    assert sorted(tuple(r) for r in similarity.members(codes, "id", "c").collect()) == [(2, 2, 2), (3, 2, 2), (5, 5, 1)]


NONE = float("nan")


def detections(spark, folder):
    """Class 1 is judged by its peers, 0 by its value, 2 by ambient, 4 by ambient for want of peers; all have readings, the other temperatures often not."""
    rows = [(1, "s", 1, 0.9, 70.0, NONE, 5.0), (2, "s", 1, 0.4, 20.0, 25.0, 5.0), (3, "t", 0, 0.9, 90.0, 91.0, None), (4, "t", 4, 0.9, 90.0, 91.0, NONE), (5, "u", 2, 0.9, 50.0, float("inf"), 45.0), (6, "v", 4, 0.9, None, 50.0, 45.0)]
    rows += [(10 + i, f"w{i // 2}", 7, 0.9, 30.0 + i, [40.0, NONE][i % 2], 1.0) for i in range(20)]
    d = spark.createDataFrame(rows, "det_id long, stem string, cls int, conf double, t_p99 double, t_max double, dt_amb double")
    d.selectExpr("*", "500 as n_px", "timestamp '2024-01-01' as captured_at").write.parquet(f"{folder}/frame_dets.parquet")
    spark.createDataFrame([(i, s) for i, s in enumerate("stuv")], "frame_id long, stem string").write.parquet(f"{folder}/frame_report.parquet")


def test_a_missing_value_costs_only_what_reads_it(spark, tmp_path):
    detections(spark, tmp_path)
    run = lambda name: entry.queries()[name](spark, str(tmp_path)).collect()
    got = {r["det_id"]: (r["verdict"], r["basis"]) for r in run("detection_verdicts_whole")}
    assert {k: got.get(k) for k in range(1, 7)} == {1: ("abnormal", "peer"), 2: ("normal", "peer"), 3: ("abnormal", "value"), 4: (None, "ambient, no peer"), 5: ("abnormal", "ambient"), 6: None}
    frames = {r["stem"]: (r["n_det"], r["verdict"]) for r in run("component_judgement_whole")}
    assert frames == {"s": (2, "abnormal"), "t": (2, "abnormal"), "u": (1, "abnormal"), "v": (0, "none")}
    assert {(r["cls"], r["n"]) for r in run("class_profile_whole")} == {(7, 20)}
    assert {(r["cls"], r["n"]) for r in run("phase_spread_whole")} == {(1, 1), (7, 10)}
    assert [r["classes"] for r in run("macro_spread_whole")] == [1]
    assert {r["stem"]: r["n"] for r in run("review_reasons_whole")} == {"s": 2, "t": 2, "u": 1, "v": 1} | {f"w{i}": 2 for i in range(10)}


def test_reports_hold_every_detection(spark, tmp_path):
    detections(spark, tmp_path)
    got = {r["stem"]: json.loads(r["report"]) for r in entry.queries()["json_reports"](spark, str(tmp_path)).collect()}
    assert sum(x["n_det"] for x in got.values()) == 26
    assert got["s"]["dets"][0] == {"det_id": 1, "cls": 1, "conf": 0.9, "t_p99": 70.0, "t_max": None}
    assert got["v"]["dets"][0]["t_p99"] is None


def test_more_than_a_thousand_sources(spark, tmp_path):
    d = spark.range(1100).select(F.col("id").alias("doc_id"), F.format_string("s%04d", "id").alias("source"), F.lit("en").alias("lang"), F.lit("x").alias("text"))
    d.unionByName(d.limit(1).withColumn("source", F.lit(None).cast("string"))).write.parquet(str(tmp_path / "documents.parquet"))
    run = lambda name: entry.queries()[name](spark, str(tmp_path))
    folds = run("leave_one_out").groupBy("fold").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "val").alias("val")).collect()
    assert len(folds) == 1100 and {(r["n"], r["val"]) for r in folds} == {(1100, 1)}
    cross = {r["doc_id"]: r["owner"] for r in run("cross_review").where("role = 'cross'").collect()}
    assert cross == {i: f"s{(i + 1) % 1100:04d}" for i in range(1100)}


def test_too_many_counts_are_told(spark):
    rows = spark.range(200).select(F.format_string("s%d", F.col("id") % 2).alias("s"), F.col("id").alias("c"))
    assert len(sampling.balanced_sessions(rows, "s", "c", most_sessions=4)) == 1
    with pytest.raises(ValueError, match="counts"):
        sampling.balanced_sessions(rows, "s", "c", most_sessions=3)


def test_a_panel_is_one_however_written(spark, tmp_path):
    rows = [(i, 1 + i % 2, ["P1", "p-01", "P1-2", "Ｐ1"][i // 2 % 4]) for i in range(40)] + [(40 + i, 1 + i % 2, "P2") for i in range(13)]
    spark.createDataFrame(rows, "det_id long, cls int, panel string").write.parquet(str(tmp_path / "frame_dets.parquet"))
    spark.createDataFrame([(1, "P1, P3"), (2, "P2")], "cls int, panels string").write.parquet(str(tmp_path / "class_dim.parquet"))
    run = lambda name: entry.queries()[name](spark, str(tmp_path)).collect()
    assert sum(r["n"] for r in run("balanced_split") if r["split"] == "val") == 13  # P2, no part of P1
    allowed = {r["det_id"] for r in run("class_whitelist_whole") if r["allowed"]}
    assert allowed == {i for i, cls, _ in rows if (cls == 1) == (i < 40)}
