"""Sentence boundaries across languages and scripts, by a compiled finite transducer that runs over chunks in parallel.

A text is a sequence of tokens (words, numbers, runs of white space, runs of marks, single signs), each of one class. The
boundary rules are compiled into a table of states and transitions over these classes: what stands before a mark
(abbreviation, initial, unit, number, ordinal, date, name, list mark), and, once a mark was read, that it is pending until
what follows decides. A second table keeps which quotation is open; within one no pending mark ends a sentence.
A long text is cut into chunks between tokens. Each chunk yields its state-transition function (the end state for every
state it may begin in), the functions are composed by a parallel prefix scan, and with its start state each chunk tells
its boundaries. Nothing is looked at beyond a token's neighbour, so there is no limit of sight.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calorgrid.session import checkpointed

# Abbreviations as the languages write them, without the last point.
#: ask for what comes behind them, so no sentence ends there
BEFORE = set(
    "e.g i.e cf vs viz approx avg No Nos Nr Fig fig Figs figs Tab tab Rev rev Ver ver Vol vol sec Sec Ch ch Eq eq Ref ref bldg Bldg dept Dept "
    "Mr Mrs Ms Dr dr Prof prof St Sgt Capt Lt Gen Col Hon pp ed eds min max Max incl excl resp temp art Art est "
    "z.B d.h u.U o.g i.d.R bzw vgl Vgl Abb abb Kap Abs Hr Fr Hrn ca Ca ggf inkl exkl bspw evtl sog lt zzgl Str Bd Anm "
    "p.ej ej Sr Sra Srta D Dña núm Núm pág págs Pág fig cap Cap aprox Aprox máx mín av Av Ud Uds tel "
    "т.е т.к т.н см См ср рис Рис стр Стр табл Табл гл ок Ок напр Напр им ул ред г-н г-жа "
    "डॉ श्री क्र पृ सं प्रो".split()
)
#: may stand last: the sentence ends if a new one begins behind them
LAST = set("etc al p.m a.m P.M A.M Inc Ltd Co Corp Jr inc ltd co usw usf u.a u.ä o.ä ff Std Min Mio Mrd т.д т.п др пр гг тыс млн млрд руб सेमी".split())
#: first and second letter of such ones that are written with a space inside
LAST_SPACED = (("pPaA", "mM"), ("т", "дп"), ("uo", "aäÄ"))
#: abbreviations only before a number; units only behind one
BEFORE_NUMBER, BEHIND_NUMBER = {"no"}, {"min", "Min", "max", "Max"}
BEFORE_ORDINAL = set("am Am das Das der Der die Die dem Dem den Den des Des im Im vom Vom zum Zum zur Zur beim Beim seit Seit ab Ab bis Bis ein eine einen einem einer jeder jede jedes".split())
MONTHS = tuple("Januar Februar März April Mai Juni Juli August September Oktober November Dezember".split())
FILE_ENDS = set("jpg jpeg png txt npy csv xml json pdf zip tif tiff log dat md py".split())

_ALL = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))


def _ranges(chars: Iterable[str]) -> str:
    """Body of a character class that holds ``chars`` (in their order)."""
    out: list[list[int]] = []
    for c in map(ord, chars):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in out)


def _property(name: str) -> str:
    return _ranges(regex.findall(name, _ALL))


#: marks that end sentences, in any script; to what Unicode counts as such come the ellipsis, and Khmer and Tibetan stops
_MARKS = _property(r"[\p{Sentence_Terminal}…។៕།༎]")
_CJK = _property(r"[\p{Hangul}\p{Han}\p{Hiragana}\p{Katakana}ー\u3099\u309a]")
_THAI = _property(r"(?V1)[\p{Thai}--[\p{Nd}฿]]")
_LETTER = _property(r"(?V1)[[\p{L}\p{M}]--[\p{Hangul}\p{Han}\p{Hiragana}\p{Katakana}ー\u3099\u309a\p{Thai}]]")
#: stands for a sign beyond the basic plane, such as an emoji
_SYMBOLIC = "\ue000"
_CLOSERS = ")]}）］】〕｝"
_QUOTES = "“”„«»「」『』‘’‚\"‹›＂"
_BREAK = r"(?:\r\n|[\n\r\x0b\x0c\x85  ])"
_LINE = re.compile(_BREAK)
_LIST = rf"(?:[-*•‣◦]|\d{{1,3}}[.)]|[{_LETTER}{_CJK}{_THAI}]\)|#{{1,6}})(?=\s)"
_DOTTED = "|".join(re.escape(w) for w in sorted(BEFORE | LAST, key=lambda w: (-len(w), w)) if re.search(r"[.-]", w))
#: words that stand between a word and a word, with single spaces, decide nothing and are read at once
_FILLERS = rf"(?<=[{_LETTER}])(?:[ ][{_LETTER}]+(?=[ ][{_LETTER}])){{2,}}|(?<=[{_CJK}])(?:[ ][{_CJK}]+(?=[ ][{_CJK}])){{2,}}"
#: numbers with their points and commas; a year may be the first part of a date and stands alone
_FIGURE = r"(?!(?:19|20)\d\d(?!\d))\d+(?:[.,:]\d+)*"
_PLAIN = rf"[{_LETTER}]+(?![{_LETTER}\d_.\-'’‘])|[{_CJK}]+|{_FIGURE}"
_TOKENS = (
    rf"{_FILLERS}|(?<=[{_LETTER}{_CJK}\d,])[ ](?:{_PLAIN})(?!_)|[ ](?=\S)|[{_LETTER}]+(?![{_LETTER}\d_.\-'’‘])|[{_CJK}]+|[{_THAI}]+"  # what most tokens are; what follows is for the others
    rf"|[^\S\n\r\x0b\x0c\x85  ]*{_BREAK}\s*{_LIST}|\s+|[A-Za-z0-9]*_[A-Za-z0-9_]*|[A-Z]{{1,2}}\d+(?=[.\-])|(?:{_DOTTED})(?![{_LETTER}])|[{_LETTER}](?:\.[{_LETTER}])+(?![{_LETTER}])"
    rf"|[{_LETTER}]+(?:[-'’‘][{_LETTER}]+)*|(?<=\d)[’‘][{_LETTER}\d]+|(?<=[{_LETTER}])[’‘]\d+|\d+|[{_MARKS}]+|[\s\S]"
)
_LEX = re.compile(_TOKENS)
_HEAD = re.compile(rf"\s*{_LIST}")

# ---- the quotation table: no quotation open, or which one --------------------------------------------------------
BREAK, END = 0, 1
_SYMBOL = {q: i + 2 for i, q in enumerate(_QUOTES)}
_CLOSED_BY = {"“": "”", "„": "“”", "«": "»", "「": "」", "『": "』", "‘": "’", "‚": "‘’", '"': '"＂', "‹": "›", "＂": '"＂'}
_OPENERS = list(_CLOSED_BY)
STATES = len(_OPENERS) + 1


def _quotations() -> list[list[int]]:
    table = [[s] * (len(_QUOTES) + 2) for s in range(STATES)]
    for s, row in enumerate(table):
        row[BREAK] = 0
        for q, symbol in _SYMBOL.items():
            if s == 0 and q in _CLOSED_BY:
                row[symbol] = _OPENERS.index(q) + 1
            elif s and q in _CLOSED_BY[_OPENERS[s - 1]]:
                row[symbol] = 0
    return table


TABLE = _quotations()

# ---- token classes: (what it is to a mark before it, what it is to a mark behind it) ------------------------------
_SIGNS = {c: "closer" for c in _CLOSERS} | {c: "quote" for c in _QUOTES} | {c: "comma" for c in ",;:"} | {c: "wide comma" for c in "、，"}
_SIGNS |= {c: "joiner" for c in "/_\\@=%&+'"} | {"-": "dash", "*": "dash", "’": "late quote", "°": "degree", "/": "slash", "•": "bullet", "#": "hash", "(": "open", "（": "open", "[": "begin", "¿": "begin", "¡": "begin"}


def classify(token: str) -> tuple[str, str]:
    """Class of a token: its kind as what follows a mark, and as what stands before one."""
    c = token[0]
    if c == " " and len(token) > 1 and not token[1].isspace():
        follows, kind = classify(token[1:])
        return f"spaced {follows}", kind
    if c.isspace():
        if not token[-1].isspace():
            return "list", "list"
        if len(_LINE.findall(token)) > 1:
            return "blank line", "blank line"
        return ("space", "one space") if len(token) == 1 else ("space", "spaces")
    if re.fullmatch(rf"[{_MARKS}]+", token):
        plain = token.strip(".．") == ""
        return ("mark", "point" if plain and len(token) < 3 else "ellipsis" if token.strip(".…") == "" else "mark")
    if "_" in token and len(token) > 1:
        low = re.match(r"[a-z]+_[a-z\d]", token)
        kind = "identifier" if low else "digit" if c.isdigit() else "lower" if c.islower() else "capital identifier" if c.isalpha() else "joiner"
        return kind, "number" if token[-1].isdigit() else "name" if token[-1].isalpha() else "joiner"
    if len(token) > 1 and c in "’‘":
        return "joiner", "number" if token[-1].isdigit() else "word"
    if c.isdecimal():
        year = len(token) == 4 and token[:2] in ("19", "20")
        return "digit", "year" if year else "ordinal" if len(token) < 3 else "number"
    if c.isdecimal() and set(token) & set(".,:"):
        return "digit", "number"
    if len(token) > 1 and token[-1].isdecimal():
        return "code", "ordinal" if len(token.lstrip("ABCDEFGHIJKLMNOPQRSTUVWXYZ")) < 3 else "number"
    if re.match(rf"[{_CJK}]", c):
        return "cjk", "cjk"
    if re.match(rf"[{_THAI}]", c):
        return "thai", "thai"
    if re.match(rf"[{_LETTER}]", c):
        first = "file end" if token.lower() in FILE_ENDS and not c.islower() else "lower" if c.islower() else "month" if token.startswith(MONTHS) else "upper" if c.isupper() else "uncased"
        return first, _word(token)
    if c in _SIGNS:
        return _SIGNS[c], _SIGNS[c]
    return ("begin", "begin") if c == _SYMBOLIC else ("sign", "sign")


def _word(token: str) -> str:
    cased = token.lower() != token.upper()
    before = token in BEFORE or token[:1].lower() + token[1:] in BEFORE
    if token in BEFORE_NUMBER:
        return "before a number"
    if token in BEHIND_NUMBER:
        return "abbreviation or last, unit" if token in LAST else "abbreviation, unit"
    if token in LAST:
        return "abbreviation or last" if before or len(token) == 1 else "last"
    if before and len(token) > 1:
        return "abbreviation"
    if len(token) == 1 and cased:
        size = "capital" if token.isupper() else "small"
        roles = [f"second {k}" for k, (_, b) in enumerate(LAST_SPACED) if token in b] + [f"first {k}" for k, (a, _) in enumerate(LAST_SPACED) if token in a]
        return " ".join([size, *sorted(roles)])
    if before:
        return "abbreviation"
    if token in BEFORE_ORDINAL:
        return "article"
    if not cased:
        return "uncased"
    latin = bool(regex.match(r"\p{Latin}", token))
    low = token.islower()
    return ("low" if low else "word") if latin else ("low, other" if low else "word, other")


CLASSES: list[tuple[str, str]] = []

# ---- the rules, as one step of the transducer ----------------------------------------------------------------------
EMIT, SET_END, SET_START, BREAKS, QUOTES = 1, 2, 4, 8, 16
#: kinds before a point that are abbreviations, or may stand last
_ABBREVIATION = {"abbreviation", "abbreviation or last", "initial", *[f"initial first {k}" for k in range(len(LAST_SPACED))]}
_LAST_KIND = {"last", "abbreviation or last"}
_DATE = {"date 0": "date 1", "date 1": "date 2", "date 2": "number"}
_NUMBER = {"number", "ordinal", "article's ordinal", *_DATE}
_BEGINS = {"upper", "month", "capital identifier", "uncased", "cjk", "thai", "file end", "code", "digit", "quote", "late quote", "begin", "hash", "open"}
_SIGNS_BEFORE = {"closer", "quote", "late quote", "comma", "wide comma", "joiner", "dash", "degree", "slash", "bullet", "hash", "open", "begin", "sign", "point", "done"}
#: beside a gap that ends a Thai sentence: neither digit, Latin, quotation nor these signs
_GAP_LEFT = {"cjk", "uncased", "low, other", "word, other", "joiner", "degree", "slash", "begin", "sign"}
_GAP_RIGHT = {"cjk", "uncased", "joiner", "dash", "bullet", "hash", "begin", "sign", "degree", "slash"}
State = tuple[str, ...]
START: State = ("start", "")


def _after_word(kind: str, context: str) -> str:
    """Kind of a word before a point, from what stands before the word."""
    behind_number = context in _NUMBER or context == "one space behind a number" or context == "degree"
    if kind.endswith(", unit"):
        return "last" if context == "one space behind a number" else kind.removesuffix(", unit")
    if kind.startswith(("capital", "small")):  # a single letter
        if context.startswith("one space behind first") and f"second {context[-1]}" in kind:
            return "abbreviation or last"
        if kind.startswith("capital") and behind_number:
            return "unit"
        first = kind.find("first")
        return "initial" if first < 0 else f"initial {kind[first : first + 7]}"
    if kind == "low" and context in ("point", "slash"):
        return "low in a path"
    return kind


def _enter(context: str, kind: str) -> str:
    """The context behind a token of ``kind`` that stands in ``context``."""
    if kind == "year":
        return "date 0"
    if kind == "ordinal":
        if context in ("comma", "point") or context in _NUMBER:
            return "number"
        return "article's ordinal" if context == "space behind an article" else "ordinal"
    if kind in ("one space", "spaces"):
        if context == "article":
            return "space behind an article"
        if context == "thai":
            return "thai gap"
        if context in _GAP_LEFT:
            return "gap"
        if kind == "one space" and context in _NUMBER:
            return "one space behind a number"
        return "start"
    if kind in ("list", "blank line"):
        return kind if kind == "list" else "start"
    return _after_word(kind, context)


def _point_ends(kind: str, where: str, follows: str) -> bool:
    """Whether a point behind ``kind`` ends a sentence if no quotation is open. ``where``: what follows stands glued to the
    point, behind a space, or behind closing brackets."""
    number = kind in _NUMBER
    abbreviation = kind in _ABBREVIATION or kind == "before a number" and follows == "digit"
    last = kind in _LAST_KIND
    alone = kind == "start"
    if where == "closed":
        return follows not in ("lower", "identifier", "comma", "wide comma", "mark")
    if where == "spaced":
        if number:
            if kind in _DATE and follows in ("digit", "cjk"):
                return False
            if kind == "article's ordinal":
                return follows not in ("upper", "month", "lower", "capital identifier", "code", "file end", "identifier")
            return not (kind in ("ordinal", "date 1", "date 2") and follows == "month")
        return follows in _BEGINS if last else not abbreviation
    if follows == "digit":
        return kind in ("low", "low, other", "article") and not abbreviation
    if follows == "identifier":
        return not (abbreviation or last or alone or kind in ("unit", "name"))
    if follows in ("lower", "comma", "joiner", "dash", "slash", "late quote", "file end"):
        return False
    if follows in ("cjk", "uncased", "thai"):
        return not alone and not abbreviation and kind not in _DATE
    if follows in ("upper", "month", "capital identifier", "code"):
        return not alone and not abbreviation and not (number and follows == "code")
    return not abbreviation


def step(state: State, cls: tuple[str, str]) -> tuple[State, int]:
    """One transition: the next state, and what is done (told as bits)."""
    follows, kind = cls
    what, script, *pending = state
    act, context = 0, what
    if follows == "filler":
        return (kind, "cjk" if kind == "cjk" else ""), 0
    if follows.startswith("spaced "):  # read only where no mark is pending
        return step(step(state, ("space", "one space"))[0], (follows.removeprefix("spaced "), kind))[0], 0
    if follows in ("list", "blank line"):
        return (_enter("start", kind), script), BREAKS
    if pending:
        mark, where = pending
        if follows == "space":
            if where == "glued" and mark == "point" and kind == "one space" and what.startswith("initial first"):
                return (what, script, mark, "one space"), 0
            return (what, script, mark, "closed, spaced" if where.startswith("closed") else "spaced"), 0
        if follows == "closer" and not where.endswith("spaced") and where != "one space":
            if mark == "point" and what in _ABBREVIATION and where == "glued":
                return ("closer", script), 0
            return (what, script, "mark" if mark == "ellipsis" else mark, "closed"), SET_END
        if mark == "point":
            ends = _point_ends(what, "closed" if where.startswith("closed") else "glued" if where == "glued" else "spaced", follows)
        elif mark == "ellipsis":
            ends = follows not in ("lower", "comma", "identifier")
        else:
            ends = where != "glued" or follows not in ("comma", "wide comma")
        act = EMIT if ends else 0
        context = "point" if where == "glued" else "closer" if where == "closed" else "start"
        if where == "one space":
            context = "one space behind " + what.removeprefix("initial ")
        if mark == "point" and what in _DATE and kind == "ordinal" and not where.startswith("closed"):
            return (_DATE[what], script), act
    elif what in ("thai gap", "gap"):
        if follows == "thai" or what == "thai gap" and follows in _GAP_RIGHT:
            act = EMIT
        context = "start"
    if kind in ("point", "mark", "ellipsis"):
        if kind == "ellipsis" and script == "cjk":
            return ("done", script), act
        before = "start" if context in ("thai gap", "gap", "list") or context.startswith(("one space", "space")) else "sign" if context in _SIGNS_BEFORE else context
        return ((before if kind == "point" else "sign"), script, kind, "glued"), act | SET_END
    if follows in ("quote", "late quote"):
        act |= QUOTES
    if follows in ("cjk", "thai", "lower", "upper", "month", "uncased", "file end", "identifier", "capital identifier", "code"):
        script = "cjk" if follows == "cjk" else ""
    new = _enter(context, kind)
    if new in ("thai gap", "gap"):
        act |= SET_START
    return (new, script), act


class Machine:
    """The rules compiled: states and classes as numbers, ``next`` and ``acts`` as flat tables.

    All classes that tokens can have are found from the lists and one token of each other sort; all states from the start."""

    def __init__(self) -> None:
        words = BEFORE | LAST | BEFORE_ORDINAL | set(MONTHS) | BEFORE_NUMBER | BEHIND_NUMBER | {c for pair in LAST_SPACED for part in pair for c in part}
        samples = [*words, *[f(w) for w in words for f in (str.capitalize, str.upper, str.lower, str.swapcase)], *[a + b for a in "xXшШबǅ\u0301" for b in ("", "x", "X", "xX", "Xx", "ш", "Ш", "ब")], *_SIGNS, *FILE_ENDS, "JPG", " ", "  ", "7.5", "\n", "\n\n", "\n-", "1)", ".", "...", "!", *[a + "_" + b for a in ("", "a", "aB", "A", "5") for b in ("", "x", "X", "7", "_")], "’s", "’5", "2024", "7", "123", "B4", "B123",
                   "한", "ก", "x", "X", "ш", "Ш", "шш", "Шш", "xx", "Xx", "क", "कक", "ǅ", _SYMBOLIC, "~", "B_", "5_", "xé", "ª"]
        self.classes = sorted({classify(t) for t in samples} | {classify(" " + t) for t in samples if t[0].isalnum()} | {("filler", "low"), ("filler", "cjk")})
        self.place = {c: i for i, c in enumerate(self.classes)}
        n = self.width = len(self.classes)
        found, order = {START: 0}, [START]
        self.next: list[int] = []
        self.acts: list[int] = []
        for s in order:
            for c in self.classes:
                new, act = step(s, c)
                if new not in found:
                    found[new] = len(order)
                    order.append(new)
                self.next.append(found[new] * n)
                self.acts.append(act)
        self.states = order
        words = [i for i, (follows, _) in enumerate(self.classes) if follows in ("lower", "upper", "month", "uncased", "file end", "cjk", "thai")]
        #: states a chunk may begin in: the start, and those behind a word
        self.begins = sorted({0} | {self.next[i + c] // n for i in range(0, len(self.next), n) for c in words})
        self.known: dict[str, int] = {}
        self.fillers = {False: self.place["filler", "low"], True: self.place["filler", "cjk"]}
        self.cjk = re.compile(rf"[{_CJK}]").match

    def class_of(self, token: str) -> int:
        if token[0] == " " and len(token) > 1 and not token[1].isspace():
            if " " in token[1:]:
                return self.fillers[self.cjk(token, 1) is not None]
        c = self.place.get(classify(token), self.place["sign", "sign"])
        if len(self.known) >= 500_000:
            self.known.clear()
        self.known[token] = c
        return c


@lru_cache(maxsize=1)
def machine() -> Machine:
    return Machine()


_BEYOND = re.compile("[\U00010000-\U0010ffff]")


@lru_cache(maxsize=10_000)
def _stand_in(c: str) -> str:
    """A character of the basic plane that is of the same kinds as ``c`` beyond it, so that patterns stay short."""
    if regex.match(r"\p{Han}", c):
        return "一"
    if regex.match(r"\p{Sentence_Terminal}", c):
        return "။"
    if c.isdecimal():
        return "0"
    if unicodedata.category(c)[0] in "LM":
        return "ш" if c.islower() else "Ш" if c.isupper() else "ב"
    return _SYMBOLIC


Event = tuple[int, int, int]


def _tokens(text: str, first: bool) -> list[str]:
    """Tokens of a text or chunk; a list mark at the very beginning is told by a line break put before it."""
    text = _BEYOND.sub(lambda m: _stand_in(m[0]), text)
    head = _HEAD.match(text) if first else None
    return _LEX.findall(text) if head is None else ["\n" + head[0], *_LEX.findall(text, head.end())]


def lex(text: str, first: bool = True, state: int = 0) -> tuple[list[Event], int]:
    """Events of a text or chunk as (symbol, end, next), and the state behind it: a boundary there ends a sentence at ``end``,
    the next begins at ``next``. ``first`` tells that the text begins here."""
    return _run(_tokens(text, first), first, state)


def _run(tokens: list[str], first: bool, state: int = 0, trace: list[tuple[int, int]] | None = None, until: list[tuple[int, int]] | None = None) -> tuple[list[Event], int]:
    """The machine over tokens. ``trace`` is filled with the number of events and the state behind each token; with
    ``until``, another run's trace, it ends where the two runs meet, and gives the number of the token there, or -1."""
    m = machine()
    known, nexts, acts = m.known, m.next, m.acts
    out: list[Event] = []
    at = kept = 0
    if first and tokens:  # a text begins with a break; the put line break has no place in it
        lead = len(tokens[0]) - len(tokens[0].lstrip())
        at = -1 if tokens[0][0] == "\n" and lead < len(tokens[0]) else 0
        out.append((BREAK, -1, lead + at))
    state *= m.width
    for token in tokens:
        c = known.get(token)
        k = state + (m.class_of(token) if c is None else c)
        state = nexts[k]
        act = acts[k]
        if act:
            if act & EMIT:
                out.append((END, kept, at))
            if act & SET_END:
                kept = at + len(token)
            elif act & SET_START:
                kept = at
            elif act & BREAKS:
                out.append((BREAK, at, at + len(token) - len(token.lstrip())))
            if act & QUOTES:
                out.append((_SYMBOL[token], at, at + 1))
        at += len(token)
        if trace is not None:
            trace.append((len(out), state))
            if until is not None and until[len(trace) - 1][1] == state:
                return out, len(trace) - 1
    return out, state // m.width if until is None else -1


def boundaries(events: list[Event], state: int = 0) -> list[tuple[int, int]]:
    """(end, next) of the boundaries that stand, from the quotation state the events begin in."""
    out = []
    for symbol, end, nxt in events:
        if symbol == BREAK or symbol == END and state == 0:
            out.append((end, nxt))
        state = TABLE[state][symbol]
    return out


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each sentence, in code points; none for an empty, blank or null text."""
    if not text or text.isspace():
        return []
    return _between(boundaries(lex(text)[0]), len(text.rstrip()))


def _between(cuts: list[tuple[int, int]], stop: int) -> list[tuple[int, int]]:
    out = []
    start = cuts[0][1]
    for end, nxt in cuts[1:]:
        if end > start:
            out.append((start, end))
        start = max(start, nxt)
    if stop > start:
        out.append((start, stop))
    return out


_CUT = re.compile(rf"(?<=[{_LETTER}])(?=\s)|(?<=[{_CJK}])(?=[{_CJK}])|(?<=[{_THAI}])(?=[{_THAI}])")


def chunk_cuts(text: str, chunk: int) -> list[int]:
    """Where to cut a long text: behind ``chunk`` letters or the next place after that where a token ends and no mark is
    pending, between a word and white space, or in a run of a script whose runs may be parted."""
    out, n = [0], len(text)
    while n - out[-1] > chunk:
        m = _CUT.search(text, out[-1] + chunk)
        if m is None or m.start() >= n:
            break
        out.append(m.start())
    return [*out, n]


def chunk_function(text: str, first: bool) -> tuple[list[int], list[Event], list[int], list[list[Event]]]:
    """What a chunk does from every state it may begin in: the end states (numbered by ``begins`` x quotation), the events
    from the first of these states, and for each of them how many of those don't hold and which come instead.

    Runs from different states soon meet; from there on they are one."""
    m = machine()
    tokens, trace = _tokens(text, first), []
    events, end = _run(tokens, first, m.begins[0], trace)
    slot = {s: i for i, s in enumerate(m.begins)}
    rest: dict[int, list[int]] = {}
    out, skip, instead = [], [], []
    for s in m.begins:
        own, at, last = [], 0, end
        if s != m.begins[0]:
            seen: list[tuple[int, int]] = []
            own, met = _run(tokens, first, s, seen, trace)
            at, last = (trace[met][0], end) if met >= 0 else (len(events), seen[-1][1] // m.width if seen else s)
        if at not in rest:
            rest[at] = _quotations_behind(events[at:])
        out += [slot.get(last, 0) * STATES + rest[at][q] for q in _quotations_behind(own)]
        skip.append(at)
        instead.append(own)
    return out, events, skip, instead


def _quotations_behind(events: list[Event]) -> list[int]:
    """Quotation state behind the events, for every one before them."""
    f = list(range(STATES))
    for symbol, _, _ in events:
        if symbol != END:
            f = [TABLE[q][symbol] for q in f]
    return f


def chunk_boundaries(events: list[Event], skip: list[int], instead: list[list[Event]], state: int) -> list[tuple[int, int]]:
    """Boundaries of a chunk that begins in ``state`` (by ``begins`` x quotation)."""
    k = state // STATES
    return boundaries([*instead[k], *events[skip[k] :]], state % STATES)


_PIECES = "doc_id long, uid long, chunk int, base int, size int, text string, sent_start int, sent_end int"


def sentence_places(docs: DataFrame, key: str = "doc_id", text: str = "text", chunk: int = 16384) -> DataFrame:
    """``doc_id, sent_start, sent_end``: one row per sentence; offsets count code points, the end is exclusive.

    Texts up to ``chunk`` code points are done at once, longer ones by chunks spread over the tasks. An empty, blank or
    null text has no sentence; repeated rows give repeated sentences. Results don't depend on ``chunk``."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uid = TaskContext.get().partitionId() << 36
        for pdf in batches:
            out: list[tuple] = []
            for doc, t in zip(pdf["doc_id"], pdf["text"], strict=True):
                uid += 1
                doc = None if pd.isna(doc) else int(doc)
                if not t or t.isspace():
                    continue
                at = chunk_cuts(t, chunk)
                if len(at) == 2:
                    out += [(doc, uid, -1, 0, 0, None, a, b) for a, b in sentences(t)]
                    continue
                size = len(t.rstrip())
                out += [(doc, uid, k, a, size, t[a:b], 0, 0) for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True))]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _PIECES.split(", ")]).astype({"doc_id": "Int64"})

    pieces = checkpointed(rows.mapInPandas(cut, _PIECES))
    done = pieces.where("chunk < 0").select("doc_id", "sent_start", "sent_end")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for p in pdf.itertuples():
                f, events, skip, instead = chunk_function(p.text, p.chunk == 0)
                flat = lambda xs: [v for s, e, n in xs for v in (s, p.base + e, p.base + n)]  # noqa: B023, E731
                upto = np.cumsum([0, *map(len, instead)]).tolist()
                out.append((p.doc_id, p.uid, p.chunk, p.size, f, flat(events), skip, flat([x for own in instead for x in own]), upto))
            yield pd.DataFrame(out, columns=["doc_id", "uid", "chunk", "size", "f", "events", "skip", "instead", "upto"])

    schema = "doc_id long, uid long, chunk int, size int, f array<int>, events array<int>, skip array<int>, instead array<int>, upto array<int>"
    long = pieces.where("chunk >= 0").repartition("uid", "chunk")
    read_chunks = checkpointed(long.mapInPandas(read, schema))
    known = _prefix_scan(read_chunks.select("uid", "chunk", "f"))

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        triples = lambda v: list(map(tuple, np.reshape(v, (-1, 3)).tolist()))
        for pdf in batches:
            out = []
            for p in pdf.itertuples():
                own = [triples(p.instead)[a:b] for a, b in zip(p.upto[:-1], p.upto[1:], strict=True)]
                for end, nxt in chunk_boundaries(triples(p.events), p.skip, own, int(p.state)):
                    out.append((p.doc_id, p.uid, p.size, end, nxt))
            yield pd.DataFrame(out, columns=["doc_id", "uid", "size", "end", "nxt"])

    cuts = read_chunks.join(known, ["uid", "chunk"]).select("doc_id", "uid", "size", "state", "events", "skip", "instead", "upto").mapInPandas(tell, "doc_id long, uid long, size int, end int, nxt int")
    w = Window.partitionBy("uid").orderBy("nxt", "end")
    # of boundaries with one next place the earliest end holds
    by_chunks = (
        cuts.groupBy("doc_id", "uid", "size", "nxt")
        .agg(F.min("end").alias("end"))
        .select("doc_id", F.col("nxt").alias("sent_start"), F.coalesce(F.lead("end").over(w), "size").alias("sent_end"))
        .where("sent_end > sent_start")
    )
    return done.unionByName(by_chunks)


def _compose(before: Column, after: Column) -> Column:
    return F.transform(before, lambda s: F.get(after, s))


def _prefix_scan(functions: DataFrame) -> DataFrame:
    """``uid, chunk, state``: the state each chunk begins in. Functions are composed over distances 1, 2, 4, ..."""
    most = functions.agg(F.max("chunk")).first()[0] or 0
    w = Window.partitionBy("uid").orderBy("chunk")
    step = 1
    while step <= most:
        earlier = F.lag("f", step).over(w)
        functions = functions.withColumn("g", earlier).withColumn("f", F.when(F.col("g").isNull(), F.col("f")).otherwise(_compose(F.col("g"), F.col("f")))).drop("g")
        step *= 2
    return functions.select("uid", "chunk", F.coalesce(F.get(F.lag("f").over(w), 0), F.lit(0)).alias("state"))
