"""Ladders and rule tables: values to ordered grades. Thresholds are data, given by the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = ("normal", "caution", "abnormal", "critical")


def ladder(value: Column, steps: Sequence[Column | float], levels: Sequence[str] = LEVELS) -> Column:
    """The highest level whose step (``steps`` rise, one for each level but the first) the value reaches; null has the first."""
    out = None
    for step, level in zip(reversed(list(steps)), reversed(list(levels[1:])), strict=True):
        cond = value >= step
        out = F.when(cond, F.lit(level)) if out is None else out.when(cond, F.lit(level))
    return out.otherwise(F.lit(levels[0]))


def ladder_with_fallback(first: Column, second: Column, first_steps: Sequence[float], second_steps: Sequence[float], levels: Sequence[str] = LEVELS) -> Column:
    """Grade by ``first``; where that gives the lowest level, or there is none, by ``second``."""
    grade = ladder(first, first_steps, levels)
    return F.when(grade != levels[0], grade).otherwise(ladder(second, second_steps, levels))


def rank(level: Column, levels: Sequence[str] = LEVELS) -> Column:
    """Place of a level in its order from 1; 0 for any other."""
    return F.coalesce(F.array_position(F.array(*[F.lit(x) for x in levels]), level).cast("int"), F.lit(0))


def with_rules(rows: DataFrame, rules: DataFrame, key: str, default: dict[str, object]) -> DataFrame:
    """``rows`` with the columns of the rule of their key, or of the default where there is none.

    ``rules`` has one row a key; it is small by nature (one row a class) and left to Spark's own size check."""
    out = rows.join(rules, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in default.items()})


def judged(value: Column, ambient: Column, peer: Column, method: Column, steps: Sequence[Column], fallback: Sequence[float], levels: Sequence[str] = LEVELS) -> list[Column]:
    """Grade and basis by a rule: ABS judges the value, AMB its rise over ambient, PHASE its rise over the peers, or over
    ambient by the ``fallback`` steps where there is no peer."""
    over_peer, over_ambient = value - peer, value - ambient
    alone = (method == "PHASE") & peer.isNull()
    grade = (
        F.when(method == "ABS", ladder(value, steps, levels))
        .when(alone, ladder(over_ambient, list(fallback), levels))
        .when(method == "PHASE", ladder(over_peer, steps, levels))
        .otherwise(ladder(over_ambient, steps, levels))
    )
    basis = F.when(method == "ABS", F.lit("value")).when(alone, F.lit("ambient, no peer")).when(method == "PHASE", F.lit("peer")).otherwise(F.lit("ambient"))
    return [grade, basis]
