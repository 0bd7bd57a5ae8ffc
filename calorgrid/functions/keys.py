"""Column builders for frame stems, panel names and class names.

All of them are built-in expressions; none needs a Python worker.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　 "
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + "  "
_INVISIBLE = "[​‌‍⁠﻿­]"

#: site+building in either order, then an optional panel token, then the rest of the stem
_HEAD = (
    r"^(?:.*[^A-Z0-9])?(?:([CE])0*([0-9]+)[-_. ]+B0*([0-9]+)|B0*([0-9]+)[-_. ]+([CE])0*([0-9]+))"
    r"(?:[-_. ]+P[- ]?0*([0-9]{1,2})(?![0-9])[^-_. /\\]*)?(?:[-_. ]+(.*))?$"
)
_TAIL = r"^([0-9OLI./ -]*?)[-_. ]*IR([0-9OLI]*)[-_. ]+#?([0-9OLI]+)(?:[^0-9A-Z].*)?$"


#: four digits that begin with 0: a frame number of five digits that lost one
_LOST = r"^0\d{3}$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row."""
    return F.get(F.transform(F.array(value), body), 0)


def plain_text(c: Column) -> Column:
    """Upper case, wide forms narrowed, invisible characters and outer space dropped."""
    return F.upper(F.trim(F.regexp_replace(F.translate(c, _WIDE, _NARROW), _INVISIBLE, "")))


def panel_key(c: Column) -> Column:
    """``P<n>`` of a panel as anyone writes it (``p9``, ``P-9``, ``P09``, ``P9-...``), else null."""
    n = F.regexp_extract(plain_text(c), r"^P[-_ ]*0*([0-9]+)(?![0-9])", 1)
    return F.when(c.rlike("^P[1-9][0-9]?$"), c).otherwise(let(n, lambda x: F.when(x != "", F.concat(F.lit("P"), x))))


def stem_struct(stem: Column, panel: Column) -> Column:
    """Struct ``cabinet, site, building, panel, day, camera, frame, text, valid`` of a frame stem.

    Differences of writing are undone: case, wide forms, separators, order of site and building, folders,
    file endings, copy marks, look-alike letters for digits, day and number formats.
    ``cabinet`` is null unless the stem names site and building; a panel named by neither stem nor column is left
    out of it. ``text`` is the plainly written stem, with its mistakes; ``valid`` tells that all six parts are given."""
    column = panel_key(panel)

    def of_head(head: Column) -> Column:
        pan = F.coalesce(F.when(head[3] != "", F.concat(F.lit("P"), head[3])), column)
        return let(
            F.array(
                F.concat_ws("_", F.concat(head[0], head[1]), F.concat(F.lit("B"), head[2]), pan),
                F.concat(head[0], head[1]),
                F.concat(F.lit("B"), head[2]),
                pan,
                head[4],
            ),
            lambda h: let(tail_of(h[4]), lambda t: parts(h, t)),
        )

    def tail_of(rest: Column) -> Column:
        return F.when(rest.rlike(_TAIL), F.split(F.translate(F.regexp_replace(rest, _TAIL, r"$1|$2|$3"), "OLI", "011"), r"\|", 3))

    def parts(h: Column, t: Column) -> Column:
        return let(
            F.array(_plain_day(F.regexp_replace(F.trim(t[0]), "[./ ]", "-")), _plain_frame(t[2])),
            lambda x: F.struct(
                h[0].alias("cabinet"),
                h[1].alias("site"),
                h[2].alias("building"),
                h[3].alias("panel"),
                x[0].alias("day"),
                t[1].alias("camera"),
                x[1].alias("frame"),
                F.concat(h[0], F.lit("_"), x[0], F.lit("_IR"), t[1], F.lit("_"), x[1]).alias("text"),
                F.coalesce(h[3].isNotNull() & x[0].rlike(r"^\d{4}-\d\d-\d\d$") & t[1].rlike(r"^\d$") & ~t[2].rlike(_LOST), F.lit(False)).alias("valid"),
            ),
        )

    return let(
        plain_text(stem),
        lambda s: F.when(s.rlike(_HEAD), let(F.split(F.regexp_replace(s, _HEAD, r"$1$5|$2$6|$3$4|$7|$8"), r"\|", 5), of_head)),
    )


def _plain_day(day: Column) -> Column:
    digits = F.regexp_replace(day, "-", "")
    return (
        F.when(day.rlike(r"^\d{4}-\d\d-\d\d$"), day)
        .when(day.rlike(r"^\d{8}$"), F.regexp_replace(day, r"^(\d{4})(\d\d)(\d\d)$", "$1-$2-$3"))
        .when(day.rlike(r"^\d{6}$"), F.regexp_replace(day, r"^(\d\d)(\d\d)(\d\d)$", "20$1-$2-$3"))
        .when(day.rlike(r"^20\d{5}$|^20\d{7}$"), F.regexp_replace(digits, r"^(\d{4})(\d\d)(\d+)$", "$1-$2-$3"))
        .otherwise(day)
    )


def _plain_frame(number: Column) -> Column:
    return let(
        F.regexp_replace(number, r"^0+(?=\d)", ""),
        lambda bare: F.when(number.rlike(_LOST), number).when(F.length(bare) < 5, F.lpad(bare, 5, "0")).otherwise(bare),
    )


def _squeeze(text: str) -> str:
    return "".join(unicodedata.normalize("NFC", text).lower().split())


def name_key(c: Column, names: list[str]) -> Column:
    """The one of ``names`` that ``c`` writes in other case, white space or Unicode form; a text that is none of them
    keeps its own spelling without outer white space; a blank one is null.

    Composed and decomposed forms are looked up first; only a text that mixes both is decomposed letter by letter."""
    forms: dict[str, str] = {}
    for name in names:
        for form in ("NFC", "NFD", "NFKC", "NFKD"):
            forms.setdefault(unicodedata.normalize(form, _squeeze(name)), name)
    if not forms:
        return F.when(F.trim(c) != "", F.trim(c))
    table = F.create_map(*[F.lit(x) for pair in forms.items() for x in pair])

    def apart(text: Column) -> Column:
        for letter in sorted({ch for name in names for ch in _squeeze(name)}):
            if (form := unicodedata.normalize("NFD", letter)) != letter:
                text = F.replace(text, F.lit(letter), F.lit(form))
        return text

    def found(pure: Column) -> Column:
        return F.when(pure != "", F.coalesce(F.try_element_at(table, pure), F.try_element_at(table, apart(pure)), F.trim(c)))

    pure = F.lower(F.regexp_replace(F.translate(c, _WIDE, _NARROW), r"(?U)\s|" + _INVISIBLE, ""))
    return F.when(c.isin(names), c).otherwise(let(pure, found))


def stem_token(stem: Column, i: int, default: str | None = None) -> Column:
    """Token ``i`` (from 0) of a plainly written stem; ``default`` where it is missing."""
    t = F.get(F.split(stem, "_"), i)
    return t if default is None else F.coalesce(t, F.lit(default))


def session_of(stem: Column) -> Column:
    """The first four tokens, which name one camera session."""
    return F.concat_ws("_", F.slice(F.split(stem, "_"), 1, 4))


def frame_number(stem: Column) -> Column:
    """Digits of the last token as a number; -1 where it holds none."""
    last = F.element_at(F.split(stem, "_"), -1)
    return F.coalesce(F.regexp_replace(last, "[^0-9]", "").try_cast("int"), F.lit(-1))


def panel_order(panel: Column) -> Column:
    """Sort key of ``P<n>``; anything else sorts as 99."""
    return F.coalesce(F.substring(panel, 2, 9).try_cast("int"), F.lit(99))
