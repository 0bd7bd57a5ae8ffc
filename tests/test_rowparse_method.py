"""The reason comes from the edits of the cheapest parse."""

from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st

from calorgrid.operators import rowparse
from calorgrid.operators.rowparse import cheapest_parse, free_parse, parse_lines, parse_record


def quotes_by_search(text, most=3):
    """Fewest quotes inserted or deleted until the quoting holds, by trying all."""
    now = {text}
    for k in range(most + 1):
        if any(free_parse(t) is not None for t in now):
            return k
        now = {t[:i] + t[i + 1 :] for t in now for i, c in enumerate(t) if c == '"'} | {t[:i] + '"' + t[i:] for t in now for i in range(len(t) + 1)}
    return most + 1


def test_fewest_quote_edits_against_all_edits():
    for n in range(6):
        for text in map("".join, product('a,"', repeat=n)):
            assert min(cheapest_parse(text, "csv", 2).quotes, 4) == min(quotes_by_search(text), 4), text


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet='a,"1 \n', max_size=30), st.integers(1, 9))
def test_costs_follow_the_definition(text, fields):
    free, cost = free_parse(text), cheapest_parse(text, "csv", fields)
    assert (cost.quotes == 0) == (free is not None)
    if free is not None:
        assert cost.delimiters == abs(len(free) - fields)
    assert cheapest_parse(text, "txt", fields) == (0, abs(len(text.split()) - fields))


def test_without_the_programme_there_is_no_reason(monkeypatch):
    monkeypatch.setattr(rowparse, "cheapest_parse", lambda *_: rowparse.Cost(0, 0))
    monkeypatch.setattr(rowparse, "typed", lambda v: (0, 0.0, 0.0, 0.1, 0.1))
    monkeypatch.setattr(rowparse, "free_parse", lambda t: [t] * 7)
    assert parse_record("csv", 's,3,.5,.5,.1,.1,a"b')[1] is None and parse_record("txt", "1 2")[1] is None


def test_carried_columns_and_no_repairs(spark):
    rows = [(1, "txt", "1 2", "f"), (2, "csv", 's,3,.5,.5,.1,.1,"a', "f"), (3, "txt", "3 .5 .5 .1 .1", None), (3, "txt", "3 .5 .5 .1 .1", None)]
    got = parse_lines(spark.createDataFrame(rows, "line_id long, feed string, raw string, file string"), repairs=False, carried=["file"])
    assert [(r["line_id"], r["file"], r["reason"], r["cls"], r["edits"]) for r in got.orderBy("line_id").collect()] == [(1, "f", "columns", None, []), (2, "f", "quoting", None, []), (3, None, None, 3, []), (3, None, None, 3, [])]
    text = got._jdf.queryExecution().toString()
    assert text.count("Scan ExistingRDD") <= 1 or "Union" not in text
