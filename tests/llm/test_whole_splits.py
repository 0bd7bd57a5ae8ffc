"""Repeated and keyless frames in the splits."""

from calorgrid.llm import splits


def test_every_row_has_one_group_and_split(spark):
    stem, other = "C1_B1_P1_2024-01-01_IR1_00001", "C2_B1_P1_2024-01-01_IR1_00001"
    rows = [(1, stem), (1, stem), (1, other), (None, stem), (None, None), (None, None), (2, None), (3, "DSC1")]
    frames = spark.createDataFrame([(i, s, None, "normal") for i, s in rows], "frame_id long, stem string, panel string, verdict string")
    got = splits.frame_splits(frames, spark.createDataFrame([], "old_key string, new_key string"), {"train": 0.8, "test": 0.2}, ("normal",)).collect()
    assert sorted((r["frame_id"] or 0, r["group_key"]) for r in got) == [(0, "C1_B1_P1"), (0, "frame:"), (0, "frame:"), (1, "C1_B1_P1"), (1, "C1_B1_P1"), (1, "C2_B1_P1"), (2, "frame:2"), (3, "stem:DSC1")]
    assert len({(r["group_key"], r["split"]) for r in got}) == 5
