"""Encoding and sentences."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from calorgrid.llm import sentences as s
from calorgrid.llm.bpe import encoder, token_counts, token_ids, tokenizer_file

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(tokenizer_file())
    t.encode_special_tokens = True
    return t


def test_random_texts_are_encoded_as_by_the_library(library):
    r = random.Random(7)
    letters = ["a", "in", "ing", " ", "  ", "the", "é", "한", "글", "กา", "😀", '"', "'s", "'", "0", "12", "\n", "\t", "ш", "__", "<|endoftext|>", "　", "\r\n"]
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
        assert encoder(tokenizer_file()).encode(text) == library.encode(text, add_special_tokens=False).ids
    for _ in range(500):
        text = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(0, 300)))
        assert encoder(tokenizer_file()).encode(text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_is_encoded_as_by_the_library(text):
    t = tokenizers.Tokenizer.from_file(tokenizer_file())
    t.encode_special_tokens = True
    assert encoder(tokenizer_file()).encode(text) == t.encode(text, add_special_tokens=False).ids


def test_a_long_piece_takes_linear_time(library):
    text = "ab" * 20000 + "é" * 3000
    assert encoder(tokenizer_file()).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_columns(spark):
    rows = [(1, "a b"), (2, ""), (3, None), (1, "a b"), (4, "x" * 100000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'clash' as ids", "0 as n_tokens")
    got = [list(r["ids"]) for r in token_ids(df.repartition(1)).orderBy("doc_id").collect()]
    assert got[0] == got[1] == encoder(tokenizer_file()).encode("a b") and got[2] == [] and got[3] == []
    assert sorted(r["n_tokens"] for r in token_counts(df).collect())[:2] == [0, 0]
    assert token_ids(df.limit(0)).count() == 0


CASES = [
    "It rose to 57.1 K.|The fan was off.",
    "See Fig. 4 and Tab. 3 of sec. 4.2.|Done?!|Yes.",
    "The camera was moved at 6 p.m.|We waited ... and it cooled.|Dust, etc. was noted.|Warmer again...|Then cooler.",
    "Crew K. J. signed, e.g. in bldg. B4.|It fell by 3 K.|Approx. 7 boxes were redrawn.",
    "cut off.|Rev. 8 lists it twice.|After that, shot_12.npy says “Too bright. Shoot again.” and nothing else.",
    '"Who moved it? Put it back."||Next.',
    'He asked, "Is it?" but left.|27 readings of t_max.|t_max stayed flat.',
    "Firmware 2.5.15 shows 3.0.19.|C5_B3_P7_2024-02-19_IR1_00002.jpg and E1_B1_P1_2024-02-19_IR1_00002.npy match.",
    "# Open points||Line one\nand more.|1. first|2. second. |b) third|- fourth",
    "Am 5. März wurde Schrank Nr. 36 geöffnet.|Das 2. Gehäuse ist ggf. neu.|Sie lag z. B. bei 2 °C, d. h. tief.|Staub usw. wurden vermerkt.",
    "„Zu heiß. Zurück!“||Um 9.30 Uhr stieg es auf 9,9 K.|Im Protokoll steht „Zu hell. Noch einmal.“ und sonst nichts.",
    "¿Estaba abierta la puerta n.º 6?|Entre 5 y 7 K osciló, p. ej. al apagar.|Se movió a las 1 p. m. por orden de la Sra. encargada.",
    "См. рис. 5 на стр. 14.|Пыль и т. д. отмечены.|Мы ждали... но зажим не остыл.|Упало на 9 К.|Версия 3.1 хуже.",
    "2024. 6. 26. 촬영분에서는 미뤘다.|담당 조(K. J. 조)가 넘겨받았다.|의심되지만… 다음 장에서는 사라졌다.|‘뜨겁다! 물러서라!’ 외에 없었다.|작다.|현장이다.",
    "値は24.5度です。|「熱い。離れろ。」と書かれていた。|かもしれないが……次の写真。|Ver. 1.1.4では低い。|ファイルa.jpgとNo.28の写真。|えっ？！|これは",
    "请勿触碰！|复核员问“这是接头吗？”，却没有留下。|固件v2.7低了4.1。",
    "ढक्कन किसने हटाया?|डॉ. की सलाह के बाद क्र. 13 बदला।|ठीक है।",
    "من رفع الغطاء؟|بلغت 51.32 درجة، أي أنها عادية.|لا تلمس!",
    "ห้ามแตะขั้วต่อ|ผลต่าง 56.3 ถึง 53.7 องศา|ผู้ตรวจเขียนว่า “ร้อนมาก ถอยออกมา” ไว้|ภาพจาก IR8 กับภาพ",
]


def pieces(text):
    return [text[a:b] for a, b in s.sentences(text)]


@pytest.mark.parametrize("case", CASES)
def test_sentences(case):
    thai = "ห้าม" in case
    want = [x.strip() for x in case.replace("||", "|").split("|")]
    glued = case.startswith(("cut", "値", "请"))
    text = ""
    for k, part in enumerate(case.split("|")):
        listed = part[:2] in ("1.", "2.", "b)", "- ")
        gap = "" if not k else "\n\n" if text.endswith("\x00") else "\n" if listed else "" if glued and not thai else " "
        text = text.rstrip("\x00") + gap + part if part else text + "\x00"
    assert pieces(text) == want


def test_empty_blank_and_unmarked():
    assert s.sentences(None) == s.sentences("") == s.sentences(" \n\t ") == []
    assert pieces("  no mark at all \n") == ["no mark at all"]
    assert pieces("a.\r\n\r\nb") == ["a.", "b"] and pieces('open "quote. never closed\n\nnext. one') == ['open "quote. never closed', "next.", "one"]


TEXT = st.lists(st.sampled_from(["ab", "Ab", "K.", ".", "...", "?", "。", " ", "  ", "\n", "\n\n", "- ", "1. ", "“", "”", '"', "„", "«", "»", "ก", "한", "7", "7.5", "e.g. ", "etc. ", ")", "’", "x_y", "　", "’s"]), max_size=60).map("".join)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_sentences_cover_all_but_white_space(text):
    at = 0
    for a, b in s.sentences(text):
        assert a >= at and b > a and text[at:a].strip() == "" and text[a:b] == text[a:b].strip()
        at = b
    assert text[at:].strip() == ""


@settings(max_examples=300, deadline=None)
@given(TEXT.map(lambda t: t * 4), st.integers(5, 40))
def test_chunks_compose(text, chunk):
    """Chunks are read alone, for every state they may begin in; composed they give the sentences of the whole."""
    at, state, best = s.chunk_cuts(text, chunk), 0, {}
    for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        f, events, skip, instead = s.chunk_function(text[a:b], k == 0)
        for end, nxt in s.chunk_boundaries(events, skip, instead, state):
            best[a + nxt] = min(a + end, best.get(a + nxt, 1 << 30))
        state = f[state]
    starts, size = sorted(best), len(text.rstrip())
    got = [(x, best[starts[i + 1]] if i + 1 < len(starts) else size) for i, x in enumerate(starts)]
    assert [g for g in got if g[1] > g[0]] == s.sentences(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_every_token_has_a_compiled_class(text):
    assert "".join(s._LEX.findall(text)) == text
    assert all(s.classify(t) in s.machine().place or " " in t[1:] for t in s._tokens(text, False))


def test_the_rules_are_compiled():
    m = s.machine()
    assert len(m.next) == len(m.acts) == len(m.states) * m.width and len(m.states) < 1000
    assert {x // m.width for x in m.next} <= set(range(len(m.states)))
    kinds = {state[0] for state in m.states}
    assert {"abbreviation", "initial", "unit", "date 0", "date 1", "article's ordinal", "list", "thai gap", "last"} <= kinds


@pytest.mark.parametrize("mark", ["։", "؟", "።", "။", "។", "༎", "‽", "⸮", "𑁇"])
def test_marks_of_any_script(mark):
    assert pieces(f"ab{mark} Cd{mark}") == [f"ab{mark}", f"Cd{mark}"]


def test_rules_see_as_far_as_they_need():
    """No limit of sight: spaces, closers and letters of any number between what decides."""
    gap = " " * 500
    assert pieces(f"am{gap}5. März war es.{gap}Dann.") == [f"am{gap}5. März war es.", "Dann."]
    assert pieces(f"한{'-' * 300}… 그리고") == [f"한{'-' * 300}… 그리고"] and pieces(f"ab{'-' * 300}… Und") == [f"ab{'-' * 300}…", "Und"]
    assert pieces(f"ab.{')' * 400} Cd") == [f"ab.{')' * 400}", "Cd"] and pieces("x" * 100_000 + ". Y") == ["x" * 100_000 + ".", "Y"]
    assert pieces("It can’t. So it is.") == ["It can’t.", "So it is."]


def test_a_table_by_chunks(spark):
    r = random.Random(11)
    words = ["Wort", "etc. ", "Fig. 4", ". ", "! ", "“a. b”", "\n\n", "한국어다. ", " ", "x"]
    rows = [(i, "".join(r.choice(words) for _ in range(r.choice([3, 400])))) for i in range(40)] + [(50, None), (51, ""), (52, " "), (53, "y" * 3000), (None, "A. b. C."), (1, "Again. And again.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as chunk", "2 as uid", "3 as sent_start").repartition(3)
    want = sorted((str(d), a, b) for d, t in rows for a, b in s.sentences(t))
    for chunk in (150, 100000):
        assert sorted((str(x["doc_id"]), x["sent_start"], x["sent_end"]) for x in s.sentence_places(df, chunk=chunk).collect()) == want
    assert s.sentence_places(df.limit(0)).count() == 0
