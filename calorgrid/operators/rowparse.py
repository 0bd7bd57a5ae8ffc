"""Rows that fail to parse: a minimum-cost error parse of delimited records.

A record is read by an automaton over the states below. Besides its free moves a parse may insert or delete a quote or a
delimiter at a cost of one each, quotes before delimiters; dynamic programming over (state, number of fields) finds the
cheapest parse with the number of fields asked for. A record whose parse is free and whose values are of their types
loads; otherwise the edits state the reason: a quote among them is ``quoting``, delimiters alone are ``columns``, no edit
at all ``value``. Plainly valid records are told and typed in the JVM; only others reach Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calorgrid.functions.keys import let

FIELDS = {"txt": 5, "csv": 7}
_START, _BARE, _INSIDE, _BEHIND, _AFTER = range(5)
#: free moves of the automaton, by token: a delimiter outside quotes also begins the next field
_FREE = {
    ",": {_START: _START, _BARE: _START, _INSIDE: _INSIDE, _BEHIND: _START, _AFTER: _START},
    '"': {_START: _INSIDE, _INSIDE: _BEHIND, _BEHIND: _INSIDE},
    " ": {_START: _START, _BARE: _BARE, _INSIDE: _INSIDE, _BEHIND: _AFTER, _AFTER: _AFTER},
    "x": {_START: _BARE, _BARE: _BARE, _INSIDE: _INSIDE},
}
#: an inserted quote opens a field, closes it, or doubles the quote before it
_INSERTED = {_START: _INSIDE, _INSIDE: _BEHIND, _BEHIND: _INSIDE}
#: white space parts the fields, and nothing is quoted
_FREE_TXT = {" ": {_START: _START, _BARE: _START}, "x": {_START: _BARE, _BARE: _BARE}}
_BLANK_PARTED = re.compile(r"\s+|\S+")
_TOKEN = re.compile(r'[,"]|\s+|[^,"\s]+')
_NUMBER = re.compile(r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?")


def _tokens(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m[0] if m[0] in ',"' else " " if m[0].isspace() else "x") for m in _TOKEN.finditer(text)]


class Cost(NamedTuple):
    """Edits of the cheapest parse."""

    quotes: int
    delimiters: int

    @property
    def reason(self) -> str | None:
        return "quoting" if self.quotes else "columns" if self.delimiters else None


def _classes(text: str, feed: str) -> Iterator[str]:
    """Token classes of a record; in ``txt`` runs of white space are the delimiters and a quote is a letter like others."""
    if feed == "csv":
        return (t for _, _, t in _tokens(text))
    return (" " if t.isspace() else "x" for t in _BLANK_PARTED.findall(text))


def cheapest_parse(text: str, feed: str, fields: int) -> Cost:
    """Cost of the cheapest parse of a record into ``fields`` fields; of equal ones in quotes the one with fewer delimiters.

    A delimiter is edited as the bound of a column: it changes the number of fields, not how the quotes around it are
    read. So the programme keeps, for each state, the fewest quote edits and the set (as bits) of field counts they can
    give. It runs within a bound of no quote edits first, where one state is alive at most."""
    free = _FREE if feed == "csv" else _FREE_TXT
    begin = {_START: (0, 1 << 1 if feed == "csv" else 1)}
    for bound in (0, len(text) + 2):
        now = begin
        if bound:
            now = _with_inserted(now)
        for t in _classes(text, feed):
            nxt: dict[int, tuple[int, int]] = {}
            for s, (quotes, counts) in now.items():
                move = free[t].get(s)
                if move is not None:
                    more = (t == "," and s != _INSIDE) if feed == "csv" else (t == "x" and s == _START)
                    _keep(nxt, move, quotes, counts << 1 if more else counts)
                if bound and t == '"':
                    _keep(nxt, s, quotes + 1, counts)
            now = _with_inserted(nxt) if bound else nxt
            if not now:
                break
        last = [v for s, v in now.items() if s != _INSIDE]
        if last:
            quotes = min(q for q, _ in last)
            counts = 0
            for q, c in last:
                counts |= c if q == quotes else 0
            return Cost(quotes, _distance(counts, fields))
    raise AssertionError("every record has a parse")


def _keep(into: dict[int, tuple[int, int]], state: int, quotes: int, counts: int) -> None:
    old = into.get(state)
    if old is None or quotes < old[0]:
        into[state] = (quotes, counts)
    elif quotes == old[0]:
        into[state] = (quotes, old[1] | counts)


def _with_inserted(now: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """States with those that inserted quotes lead to."""
    for s in (_START, _INSIDE, _BEHIND, _INSIDE):
        if s in now:
            quotes, counts = now[s]
            _keep(now, _INSERTED[s], quotes + 1, counts)
    return now


def _distance(bits: int, k: int) -> int:
    """How far the set bit nearest to ``k`` is."""
    low = bits & ((1 << (k + 1)) - 1)
    below = k - (low.bit_length() - 1) if low else None
    high = bits >> k
    above = (high & -high).bit_length() - 1 if high else None
    return min(d for d in (below, above) if d is not None)


def free_parse(text: str) -> list[str] | None:
    """Fields of a record whose quoting holds, without outer white space and quotes; else null."""
    state, fields, begin = _START, [], 0
    for at, end, t in _tokens(text):
        move = _FREE[t].get(state)
        if move is None:
            return None
        if t == "," and state != _INSIDE:
            fields.append(text[begin:at])
            begin = end
        state = move
    if state == _INSIDE:
        return None
    fields.append(text[begin:])
    out = []
    for f in map(str.strip, fields):
        out.append(f[1:-1].replace('""', '"').strip() if f[:1] == '"' else f)
    return out


def cheapest_edits(text: str, fields: int) -> list[str]:
    """Edits of the cheapest parse into ``fields`` fields, such as ``insert , at 7``; empty where it is free.

    Among parses of one cost the one that edits fewer quotes counts, then the first found."""
    best: dict[tuple[int, int], tuple[int, int, tuple | None]] = {(_START, 1): (0, 0, None)}

    def keep(into: dict, key: tuple[int, int], cost: int, quotes: int, path: tuple | None) -> bool:
        old = into.get(key)
        if old is None or (cost, quotes) < old[:2]:
            into[key] = (cost, quotes, path)
            return True
        return False

    def insert(now: dict, at: int) -> None:
        todo = list(now)
        while todo:
            s, k = todo.pop()
            cost, quotes, path = now[s, k]
            if s in _INSERTED and keep(now, (_INSERTED[s], k), cost + 1, quotes + 1, (path, f'insert " at {at}')):
                todo.append((_INSERTED[s], k))
            if s != _INSIDE and k < fields and keep(now, (_START, k + 1), cost + 1, quotes, (path, f"insert , at {at}")):
                todo.append((_START, k + 1))

    for at, _, t in _tokens(text):
        insert(best, at)
        nxt: dict = {}
        for (s, k), (cost, quotes, path) in best.items():
            move = _FREE[t].get(s)
            if move is not None:
                k2 = k + 1 if t == "," and s != _INSIDE else k
                if k2 <= fields:
                    keep(nxt, (move, k2), cost, quotes, path)
            if t == '"' or t == "," and s != _INSIDE:
                keep(nxt, (s, k), cost + 1, quotes + (t == '"'), (path, f"delete {t} at {at}"))
        best = nxt
    insert(best, len(text))
    path = min((v for (s, k), v in best.items() if k == fields and s != _INSIDE), key=lambda v: v[:2])[2]
    edits: list[str] = []
    while path is not None:
        path, edit = path
        edits.append(edit)
    return edits[::-1]


def typed(values: list[str]) -> tuple[int, float, float, float, float] | None:
    """cls, cx, cy, bw, bh where each is of its type and range, else null."""
    cls, *rest = values
    if not re.fullmatch(r"[0-9]+", cls) or int(cls[-9:]) > 25 or cls[:-9].strip("0"):
        return None
    if not all(_NUMBER.fullmatch(v) for v in rest):
        return None
    cx, cy, bw, bh = map(float, rest)
    return (int(cls), cx, cy, bw, bh) if 0 <= cx <= 1 and 0 <= cy <= 1 and 0 < bw <= 1 and 0 < bh <= 1 else None


def parse_record(feed: str | None, raw: str | None, repairs: bool = True) -> tuple[tuple | None, str | None, list[str]]:
    """``(values, reason, edits)`` of one record; values or reason is null, edits are those of a repair (if wanted).

    Null counts as empty, a feed other than ``csv`` as ``txt``. An empty record has a wrong number of fields."""
    text, kind = raw or "", "csv" if feed == "csv" else "txt"
    cost = cheapest_parse(text, kind, FIELDS[kind])
    if cost.reason is None:
        values = typed(free_parse(text)[1:6] if kind == "csv" else text.split())
        return (values, None, []) if values else (None, "value", [])
    if not repairs:
        return None, cost.reason, []
    if kind == "csv":
        return None, cost.reason, cheapest_edits(text, FIELDS["csv"])
    return None, cost.reason, ["delete delimiter" if len(text.split()) > FIELDS["txt"] else "insert delimiter"] * cost.delimiters


_N = r"\s*+[+]?(?:[0-9]++\.?[0-9]*+|\.[0-9]++)(?:[eE][+-]?[0-9]++)?\s*+"
_V = rf"(?:\s*+\"{_N}\"\s*+|{_N})"
_PLAIN_CSV = rf"^(?:\s*+\"[^\",]*+\"\s*+|[^\",]*+),(?:\s*+\"\s*+[0-9]++\s*+\"\s*+|\s*+[0-9]++\s*+)(?:,{_V}){{4}},(?:\s*+\"[^\"]*+\"\s*+|[^\",]*+)$"
_PLAIN_TXT = rf"^\s*+[0-9]++(?:\s{_N}){{4}}$"
_OUT = "cls int, cx double, cy double, bw double, bh double, reason string, edits array<string>"


def parse_lines(lines: DataFrame, repairs: bool = True, carried: Sequence[str] = ()) -> DataFrame:
    """``line_id, carried..., cls, cx, cy, bw, bh, reason, edits``: one row per record of ``lines`` (line_id, feed, raw).

    A valid record has its typed values and a null reason. Otherwise the reason is the first that holds of ``quoting``,
    ``columns`` and ``value``, told by the cheapest parse, and ``edits`` (empty without ``repairs``) is the cheapest way to
    give the record its number of fields. Repeated rows give repeated rows. The table is read once; no row is grouped or
    moved, and a plainly valid record goes to Python as a null."""
    rows = lines.select(F.col("line_id").cast("long"), *carried, "feed", "raw")
    csv = F.col("feed") == "csv"
    short = F.length("raw") <= 2000
    plain = F.coalesce(short & F.when(csv, F.col("raw").rlike(_PLAIN_CSV)).otherwise(F.col("raw").rlike(_PLAIN_TXT)), F.lit(False))
    parts = F.when(csv, F.split(F.regexp_replace("raw", r"[\s\"]", ""), ",", 7)).otherwise(F.split(F.regexp_replace("raw", r"^\s+", ""), r"\s+"))
    base = F.when(csv, 1).otherwise(0)
    names = ("cx", "cy", "bw", "bh")

    def values(p: Column) -> Column:
        return F.struct(F.get(p, base).try_cast("int").alias("cls"), *[F.get(p, base + (i + 1)).try_cast("double").alias(c) for i, c in enumerate(names)])

    def good(v: Column) -> Column:
        inside = v["cls"].between(0, 25) & v["cx"].between(0, 1) & v["cy"].between(0, 1)
        return inside & (v["bw"] > 0) & (v["bw"] <= 1) & (v["bh"] > 0) & (v["bh"] <= 1)

    found = F.when(plain, let(parts, lambda p: let(values(p), lambda v: F.when(good(v), v))))
    told = rows.select("line_id", *carried, F.array(F.struct(found.alias("v"), "feed", "raw")).alias("_r"))
    # one element, so that what was found is computed once a row; not outer, it would be computed for a filter as well
    told = told.select("line_id", *carried, F.inline_outer("_r")).select("line_id", *carried, "v", F.col("v").isNull().alias("todo"), *[F.when(F.col("v").isNull(), F.col(c)).alias(c) for c in ("feed", "raw")])

    @F.pandas_udf(_OUT)
    def rest(todo: pd.Series, feed: pd.Series, raw: pd.Series) -> pd.DataFrame:
        none = ((None,) * 5, None, None)
        found = [parse_record(f, r, repairs) if t else none for t, f, r in zip(todo, feed, raw, strict=True)]
        columns = list(zip(*[v or none[0] for v, _, _ in found], strict=True)) or [()] * 5
        return pd.DataFrame({"cls": pd.array(columns[0], dtype="Int32"), **{c: pd.array(columns[i + 1], dtype="Float64") for i, c in enumerate(names)}, "reason": [r for _, r, _ in found], "edits": [e for _, _, e in found]})

    # told to be non-deterministic, so that a filter on the reason doesn't call it a second time
    out = told.select("line_id", *carried, "v", rest.asNondeterministic()("todo", "feed", "raw").alias("r"))
    edits = F.coalesce("r.edits", F.array().cast("array<string>")).alias("edits")
    return out.select("line_id", *carried, *[F.coalesce(f"v.{c}", f"r.{c}").alias(c) for c in ("cls", *names)], F.col("r.reason").alias("reason"), edits)
