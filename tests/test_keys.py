import unicodedata

import pytest
from pyspark.sql import functions as F

from calorgrid.functions.keys import frame_number, name_key, panel_key, panel_order, session_of, stem_struct, stem_token

PLAIN = "C3_B2_P6_2024-03-11_IR2_00017"


@pytest.mark.parametrize(
    "stem,panel",
    [
        (PLAIN, None), ("B2_C3_P6_2024-03-11_IR2_00017", None), ("c3_b2_p6_2024-03-11_ir2_00017", "P1"), ("C3-B2-P6-2024-03-11-IR2-00017", None),
        ("C3.B2.P6.2024.03.11.IR2.00017", None), ("C3 B2 P6 2024-03-11 IR2 17", None), ("C3__B2__P6__20240311__IR2__#17", None), ("C3_B2_240311_IR2_00017", "p6-진공반"),
        ("./data/ir/C3_B2_P06_2024/03/11_IR2_0000017.JPG", None), ("export\\C3_B2_P6반_2O24-03-ll_IR2_000l7 (1)", None), ("Ｃ３_Ｂ２_Ｐ６_２０２４－０３－１１_ＩＲ２_０００１７-복사본", None),
        ("backup 2/C3_B2_2024-03-11_IR2_00017 - copy", "Ｐ6"), ("﻿C3_B2_P6_2024-03-11_IR2_00017_copy​", None),
    ],
)
def test_a_stem_in_any_writing_is_the_plain_one(spark, stem, panel):
    row = spark.createDataFrame([(stem, panel)], "stem string, panel string").select(stem_struct(F.col("stem"), F.col("panel")).alias("k")).first()["k"]
    assert (row["text"], row["cabinet"], row["valid"]) == (PLAIN, "C3_B2_P6", True)


def test_mistakes_stay_and_no_stems_are_null(spark):
    rows = [("C3_B2_P6_2024-03-1_IR2_00017", None), ("C3_B2_P6_2024-03-11_IR_00017", None), ("C3_B2_P6_2024-03-11_IR2_0017", None), ("C3_B2_2024-03-11_IR2_00017", None), ("DSC000123456", "P6"), (None, "P6"), ("", None)]
    got = spark.createDataFrame(rows, "stem string, panel string").select(stem_struct(F.col("stem"), F.col("panel")).alias("k")).collect()
    assert [g["k"] and (g["k"]["text"], g["k"]["valid"]) for g in got] == [
        ("C3_B2_P6_2024-03-1_IR2_00017", False), ("C3_B2_P6_2024-03-11_IR_00017", False), ("C3_B2_P6_2024-03-11_IR2_0017", False), ("C3_B2_2024-03-11_IR2_00017", False), None, None, None,
    ]
    assert got[3]["k"]["cabinet"] == "C3_B2"


def test_panels_and_names(spark):
    got = spark.createDataFrame([(x,) for x in ("P9", " p9", "P-9", "P09", "Ｐ９", "P9반", "p13-기타반", "", None, "nine")], "p string").select(panel_key(F.col("p"))).collect()
    assert [r[0] for r in got] == ["P9"] * 6 + ["P13", None, None, None]
    names = ["수지 면", "개폐기"]
    mixed = unicodedata.normalize("NFD", "수") + "지면"
    rows = ["수지 면", " 수지 면", unicodedata.normalize("NFD", "수지 면"), mixed, "개폐기 ", "other ", "  ", None]
    got = spark.createDataFrame([(x,) for x in rows], "c string").select(name_key(F.col("c"), names)).collect()
    assert [r[0] for r in got] == ["수지 면"] * 4 + ["개폐기", "other", None, None]
    assert spark.createDataFrame([(" a ",)], "c string").select(name_key(F.col("c"), [])).first()[0] == "a"


def test_tokens(spark):
    r = spark.createDataFrame([(PLAIN,), ("x",)], "s string")
    s = F.col("s")
    got = r.select(stem_token(s, 2, "?"), session_of(s), frame_number(s), panel_order(stem_token(s, 2))).collect()
    assert [tuple(x) for x in got] == [("P6", "C3_B2_P6_2024-03-11", 17, 6), ("?", "x", -1, 99)]
