"""Percentiles of very large columns: dyadic Count-sketches that are merged by addition.

A value is encoded into 32 ordered bits. Every binary resolution of the code has its counters: the 1,024 coarsest nodes
are counted exactly, every finer level by a signed Count-sketch. Sketches of parts, days or sources are added, and values
are deleted by adding them with a negative count. A percentile is found by descending the levels.
While a summary holds fewer distinct codes than it would have counters, it is kept as the list of updates (code, count);
the list is played into the counters before any answer, so the answer doesn't depend on how the data were parted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calorgrid.session import checkpointed

BITS = 32
TOP = 10
_LEVELS = BITS - TOP
_MOST_ROWS = 63
#: summaries that one task adds at most
FAN_IN = 32
_rng = np.random.default_rng(20240229)
_MUL = _rng.integers(1 << 62, (1 << 63) - 1, size=(2, _LEVELS, _MOST_ROWS), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, (1 << 63) - 1, size=(2, _LEVELS, _MOST_ROWS), dtype=np.int64).astype(np.uint64)


class Shape(NamedTuple):
    """Counters of the levels that are sketched: rows of 2**width_bits counters each."""

    rows: int
    width_bits: int

    @property
    def cells(self) -> int:
        return (1 << TOP) + (_LEVELS * self.rows << self.width_bits)


def shape_for(epsilon: float, delta: float) -> Shape:
    """Counters for a rank error of ``epsilon`` n with probability 1 - ``delta``.

    By the analysis of dyadic Count-sketches, up to its constant: sqrt(levels ln(levels / delta)) / epsilon counters a row,
    as the errors of the levels are independent and add up by their squares, and ln(levels / delta) rows (odd, for a
    median). Summaries are added only if they are of one shape."""
    if not 0 < epsilon < 1 or not 0 < delta < 1:
        raise ValueError("epsilon and delta must be between 0 and 1")
    more = np.log(_LEVELS / delta)
    rows = int(np.ceil(more)) | 1
    if rows > _MOST_ROWS:
        raise ValueError("delta is too small")
    return Shape(rows, max(4, int(np.ceil(np.log2(np.sqrt(_LEVELS * more) / epsilon)))))


EPSILON, DELTA = 0.02, 0.05
DEFAULT = shape_for(EPSILON, DELTA)
#: a list of updates of this length takes as many bytes as the counters
MOST_UPDATES = DEFAULT.cells // 2


def encode(values: np.ndarray) -> np.ndarray:
    """Codes of finite doubles, in their order: the upper 32 bits of the number; -0.0 is 0.0."""
    raw = (np.asarray(values, dtype=np.float64) + 0.0).view(np.int64)
    ordered = np.where(raw < 0, ~raw, raw | np.int64(-(1 << 63))).view(np.uint64)
    return (ordered >> np.uint64(64 - BITS)).astype(np.int64)


def decode(codes: np.ndarray) -> np.ndarray:
    """The middle of each code's values; it is off by at most 2**-21 of the value."""
    ordered = (np.asarray(codes, dtype=np.uint64) << np.uint64(64 - BITS)) | np.uint64(1 << (63 - BITS))
    raw = np.where(ordered >> np.uint64(63) == 1, ordered ^ np.uint64(1 << 63), ~ordered)
    return raw.view(np.float64)


def _places(nodes: np.ndarray, level: int, row: int, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    x = nodes.astype(np.uint64)
    with np.errstate(over="ignore"):
        place = (x * _MUL[0, level, row] + _ADD[0, level, row]) >> np.uint64(64 - shape.width_bits)
        sign = (x * _MUL[1, level, row] + _ADD[1, level, row]) >> np.uint64(63)
    return place.astype(np.int64), 1 - 2 * sign.astype(np.int64)


def counters(codes: np.ndarray, counts: np.ndarray, shape: Shape = DEFAULT) -> np.ndarray:
    """Counters of a list of updates."""
    out = np.zeros(shape.cells, dtype=np.int64)
    out[: 1 << TOP] = np.bincount(codes >> (BITS - TOP), weights=counts, minlength=1 << TOP).astype(np.int64)
    at, width = 1 << TOP, 1 << shape.width_bits
    for level in range(_LEVELS):
        nodes = codes >> level
        for row in range(shape.rows):
            place, sign = _places(nodes, level, row, shape)
            out[at : at + width] = np.bincount(place, weights=sign * counts, minlength=width).astype(np.int64)
            at += width
    return out


def _counted(cells: np.ndarray, shape: Shape) -> bytes:
    return b"c" + bytes(shape) + cells.astype("<i8").tobytes()


def pack(codes: np.ndarray, counts: np.ndarray, shape: Shape = DEFAULT, most_updates: int | None = None) -> bytes:
    """A summary as bytes: the list of updates while it is short, else the counters."""
    codes, where = np.unique(codes, return_inverse=True)
    counts = np.bincount(where, weights=counts, minlength=len(codes)).astype(np.int64)
    keep = counts != 0
    if keep.sum() <= (MOST_UPDATES if most_updates is None else most_updates):
        return b"u" + codes[keep].astype("<u4").tobytes() + counts[keep].astype("<i8").tobytes()
    return _counted(counters(codes[keep], counts[keep], shape), shape)


def _unpack(summary: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = (len(summary) - 1) // 12
    return np.frombuffer(summary, "<u4", n, 1).astype(np.int64), np.frombuffer(summary, "<i8", n, 1 + 4 * n)


def dense(summary: bytes, shape: Shape = DEFAULT) -> np.ndarray:
    """Counters of a summary."""
    if summary[:1] == b"u":
        return counters(*_unpack(summary), shape)
    if Shape(*summary[1:3]) != shape:
        raise ValueError("the summary's counters are of another shape")
    return np.frombuffer(summary, "<i8", shape.cells, 3)


def merge(summaries: Sequence[bytes], sign: int = 1, shape: Shape = DEFAULT, most_updates: int | None = None) -> bytes:
    """Sum of summaries; ``sign`` -1 turns a summary into its deletion."""
    lists = [_unpack(s) for s in summaries if s[:1] == b"u"]
    codes = np.concatenate([c for c, _ in lists]) if lists else np.zeros(0, np.int64)
    counts = sign * np.concatenate([n for _, n in lists]) if lists else np.zeros(0, np.int64)
    full = [s for s in summaries if s[:1] == b"c"]
    if not full:
        return pack(codes, counts, shape, most_updates)
    total = counters(codes, counts, shape)
    for s in full:
        total += sign * dense(s, shape)
    return _counted(total, shape)


def quantiles(summary: bytes, shares: Sequence[float], shape: Shape = DEFAULT) -> tuple[int, list[float | None]]:
    """Number of values and, for each share q, the value of rank ceil(q n) (the first for q = 0); null without values."""
    cells = dense(summary, shape)
    top = cells[: 1 << TOP]
    n = int(top.sum())
    if n <= 0:
        return 0, [None] * len(shares)
    upto = np.cumsum(top)
    out = []
    for q in shares:
        rank = min(max(int(np.ceil(q * n - 1e-9)) - 1, 0), n - 1)
        node = int(np.searchsorted(upto, rank, side="right"))
        rank -= int(upto[node] - top[node])
        here = int(top[node])
        for level in range(_LEVELS - 1, -1, -1):
            node *= 2
            guess = []
            for row in range(shape.rows):
                place, sign = _places(np.array([node]), level, row, shape)
                guess.append(int(sign[0]) * int(cells[(1 << TOP) + (level * shape.rows + row << shape.width_bits) + int(place[0])]))
            left = min(max(int(np.median(guess)), 0), here)
            if rank < left:
                here = left
            else:
                node, rank, here = node + 1, rank - left, here - left
                rank = min(rank, max(here - 1, 0))
        out.append(float(decode(np.array([node]))[0]))
    return n, out


def summarise(rows: DataFrame, keys: Sequence[str], value: str, shape: Shape = DEFAULT, most_updates: int | None = None, held_rows: int = 2_000_000) -> DataFrame:
    """``keys..., summary``, one row per key, of the finite values of ``value``.

    Nulls, NaN and infinities are no values; a key without values gives no row; null keys are keys. Each partition makes
    one summary of each key for every ``held_rows`` rows, so a hot key is pre-aggregated; the partial ones are ``merged``.
    ``most_updates`` is the length up to which a summary stays a list (by default while that takes fewer bytes)."""
    keys = list(keys)
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", summary binary"
    data = rows.select(*keys, F.col(value).cast("double").alias("value")).where(F.abs("value") < F.lit(float("inf")))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def out() -> Iterator[pd.DataFrame]:
            pdf = pd.concat(held, ignore_index=True)
            pdf["code"] = encode(pdf["value"].to_numpy())
            one: list[tuple] = []

            def frame() -> pd.DataFrame:
                made = pd.DataFrame(one, columns=[*keys, "summary"])
                for k in keys:
                    made[k] = made[k].astype(object).where(made[k].notna(), None)
                return made

            for k, g in pdf.groupby(keys, dropna=False, sort=False)["code"]:
                one.append((k if isinstance(k, tuple) else (k,)) + (pack(g.to_numpy(), np.ones(len(g), np.int64), shape, most_updates),))
                if len(one) >= FAN_IN:  # a frame of few summaries is of bounded size
                    yield frame()
                    one.clear()
            yield frame()

        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            if size >= held_rows:
                yield from out()
                held, size = [], 0
        if size:
            yield from out()

    return merged(data.mapInPandas(partial, schema), keys, shape, most_updates)


def merged(summaries: DataFrame, keys: Sequence[str], shape: Shape = DEFAULT, most_updates: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """``keys..., summary``: the sum of the summaries of each key, in a tree: no task adds more than ``fan_in`` at once.

    While a key has more summaries, those of each key are dealt into buckets by a hash, the buckets are counted, and dealt
    anew if one holds more than may be added; each level is written to the checkpoint folder."""
    keys = list(keys)

    @F.pandas_udf("binary")
    def add(s: pd.Series) -> bytes:
        if len(s) > fan_in:
            raise ValueError("more summaries than may be added at once")
        return merge([bytes(x) for x in s], 1, shape, most_updates)

    now = checkpointed(summaries.select(*keys, "summary"))
    most = lambda df, by: df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    while (n := most(now, keys)) > fan_in:
        buckets = -(-2 * n // fan_in)
        numbered = now.withColumn("_uid", F.monotonically_increasing_id())
        while most(dealt := numbered.withColumn("_slot", F.pmod(F.xxhash64("_uid", F.lit(buckets)), F.lit(buckets))), [*keys, "_slot"]) > fan_in:
            buckets += -(-buckets // 2)
        now = checkpointed(dealt.groupBy(*keys, "_slot").agg(add("summary").alias("summary")).select(*keys, "summary"))
    return now.groupBy(*keys).agg(add("summary").alias("summary"))


def answers(summaries: DataFrame, keys: Sequence[str], shares: dict[str, float], shape: Shape = DEFAULT) -> DataFrame:
    """``keys..., n`` and a column for each share: its percentile from the summary (one row per key, as of ``merged``)."""
    names, keys = list(shares), list(keys)
    kinds = dict(summaries.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n bigint, " + ", ".join(f"`{x}` double" for x in names)

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        n, found = quantiles(merge([bytes(x) for x in pdf["summary"]], 1, shape), list(shares.values()), shape)
        return pd.DataFrame([[*[pdf[k].iloc[0] for k in keys], n, *found]], columns=[*keys, "n", *names])

    # a group holds one summary: a batch of many of them would be as large as their number
    return summaries.groupBy(*keys).applyInPandas(ask, schema)
