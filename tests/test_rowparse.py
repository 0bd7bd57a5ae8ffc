from hypothesis import given, settings
from hypothesis import strategies as st
from calorgrid.operators.rowparse import cheapest_edits, free_parse, parse_lines, parse_record

CASES = [
    ("txt", "3 0.5 .5 1e-1 1", None), ("txt", "", "columns"), ("txt", None, "columns"), ("txt", "3 0.5 0.5 0.1", "columns"), ("txt", "3 0.5 0.5 0.1 0", "value"), ("txt", "26 .5 .5 .1 .1", "value"),
    ("txt", "+3 .5 .5 .1 .1", "value"), ("txt", "3 ０.5 .5 .1 .1", "value"), ("txt", "3 nan .5 .1 .1", "value"), ("txt", "3 .5\t.5　.1 .1\r", None), ("txt", '3 ".5" .5 .1 .1', "value"), (None, "3 .5 .5 .1 .1", None),
    ("csv", 's,3,.5,.5,.1,.1,"a, ""b""\nc"', None), ("csv", "s,3,.5,.5,.1,.1,", None), ("csv", "s,3,.5,.5,.1,.1", "columns"), ("csv", 's,3,.5,.5,.1,.1,a"b', "quoting"), ("csv", 's,3,.5,.5,.1,.1,"ab', "quoting"),
    ("csv", 's,3,.5,.5,.1,.1,"a"b', "quoting"), ("csv", 's, "3" ,.5,+0.5,.1,.1,n', None), ("csv", "s,x,.5,.5,.1,.1,n", "value"), ("csv", None, "columns"), ("csv", '"a"b,3', "quoting"), ("csv", "s,007,.5,.5,.1,5.,n", "value"), ("csv", "s,007,1,0,.1,1.,n", None),
    ("csv", "x" * 50000 + ",3,.5,.5,.1,.1,n", None), ("csv", '"' * 301, "quoting"),
]


def test_reasons_and_values(spark):
    rows = [(i, f, r, 1, ["x"]) for i, (f, r, _) in enumerate(CASES)]
    got = {r["line_id"]: r for r in parse_lines(spark.createDataFrame(rows, "line_id long, feed string, raw string, cls int, parts array<string>")).collect()}
    assert [got[i]["reason"] for i in range(len(CASES))] == [w for *_, w in CASES]
    assert got[0].asDict() | {"edits": None} == {"line_id": 0, "cls": 3, "cx": 0.5, "cy": 0.5, "bw": 0.1, "bh": 1.0, "reason": None, "edits": None}
    assert all((got[i]["cls"] is None) == (w is not None) for i, (*_, w) in enumerate(CASES))
    assert parse_lines(spark.createDataFrame([], "line_id long, feed string, raw string")).count() == 0


def test_edits_are_cheapest():
    assert cheapest_edits("a,b,c,d,e,f,g", 7) == []
    assert cheapest_edits('a,b"c,1,2,3,4,5', 7) == ['delete " at 3']
    assert cheapest_edits('a,b,1,2,3,4,"note', 7) in (['insert " at 17'], ['delete " at 12'])
    assert len(cheapest_edits("a,b", 7)) == 5 and len(cheapest_edits("a,b,c,d,e,f,g,h,i", 7)) == 2
    assert cheapest_edits('a,b,1,2,3,4,"n "x" m"', 7) != []


def apply(text, edits):
    for e in reversed(edits):  # they stand in the order of the text
        what, sign, _, at = e.split(" ")
        at = int(at)
        text = text[:at] + text[at + 1 :] if what == "delete" else text[:at] + sign + text[at:]
    return text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='a,"1 \n', max_size=14))
def test_edited_records_parse(text):
    edits = cheapest_edits(text, 3)
    fields = free_parse(text)
    assert (edits == []) == (fields is not None and len(fields) == 3)
    mended = free_parse(apply(text, edits))
    assert mended is not None and len(mended) == 3


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet='a,"1.5e+ \n', max_size=30), st.sampled_from(["csv", "txt"]))
def test_any_text_has_values_or_a_reason(text, feed):
    values, why, _ = parse_record(feed, text)
    assert (values is None) == (why in ("quoting", "columns", "value"))
