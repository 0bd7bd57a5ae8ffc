"""Implausible readings per source: wavelet details for spikes, runs without detail for sticking, bounds for the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calorgrid.operators.exact import exact_medians
from calorgrid.session import by_range, checkpointed

_LEVELS = 3
_EPS = 1e-9
#: readings of one spot that a task holds at once; a longer stretch is cut and sewn like one that crosses partitions
HELD = 65_536
_COLUMNS = ("t_max", "t_p99")
_STAGE = "det_id long, kind string, spot_id long, at long, t_max double, t_p99 double, part long"


def haar_details(x: np.ndarray, levels: int = _LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """Undecimated Haar decomposition: details (levels x n) and the last approximation; together they add up to ``x``.

    A detail is half the difference of two approximations, so a finest detail is zero where, and only where, two
    successive values are equal."""
    details, a = [], x
    back = np.arange(len(x))
    for j in range(levels):
        b = a[np.maximum(back - (1 << j), 0)]
        details.append((a - b) / 2)
        a = (a + b) / 2
    return np.array(details), a


def candidates(x: np.ndarray, limit: float, middle: float | None = None, parts: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Mask of the values of one source, in time order, that may lie ``limit`` or more off its median.

    Each level's details are scaled robustly (by the median of their size) and held against one threshold for all
    levels: a part of ``limit`` (a half, or a quarter where the median isn't known), dealt out over the levels by their
    scale. A value none of whose details reaches it is quiet, and lies within that part of its approximation. Where the
    median lies follows from the approximations: if k values aren't quiet, it is between the approximations k ranks below
    and above their middle, give or take that part. So a median need not be known to tell what may be off it; no value
    that is can be missed."""
    n = len(x)
    details, rest = parts or haar_details(x)
    size = np.abs(details)
    scale = np.median(size, axis=1) + _EPS
    half = limit / (4 if middle is None else 2)
    quiet = (size < (half * scale / scale.sum())[:, None]).all(axis=0)
    if middle is None:
        k, order = n - int(quiet.sum()), np.sort(rest)
        low, high = (n - 1) // 2 - k, n // 2 + k
        lo = order[low] - half if low >= 0 else -np.inf
        hi = order[high] + half if high < n else np.inf
    else:
        lo = hi = middle
    return ~(quiet & (rest + half - lo < limit) & (hi - rest + half < limit))


def middle_and_spread(x: np.ndarray) -> tuple[float, float]:
    """Median, and median distance from it."""
    middle = float(np.median(x))
    return middle, float(np.median(np.abs(x - middle)))


def spikes(x: np.ndarray, known: tuple[float, float] | None, least: float, times: float) -> np.ndarray:
    """Mask of the values of one source, in time order, that lie at least ``least`` and ``times`` its spread off its middle.

    The decomposition names the candidates: a source that has none by ``least`` needs no exact medians (``known``, if they
    are there already); with them, only the candidates by the source's own limit are measured."""
    out = np.zeros(len(x), dtype=bool)
    parts = haar_details(x)
    if known is None:
        if not candidates(x, least - 2 * _EPS, None, parts).any():
            return out
        known = middle_and_spread(x)
    at = np.flatnonzero(candidates(x, max(least, times * known[1]) - 2 * _EPS, known[0], parts))
    off = np.abs(x[at] - known[0])
    out[at] = (off >= least - _EPS) & (off >= times * known[1] - _EPS)
    return out


def runs_without_detail(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the run of equal successive values each value is in, and each run's length: finest details of zero."""
    if not len(x):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    run = np.cumsum(haar_details(x, 1)[0][0] != 0)
    return run, np.bincount(run)


def impossible() -> Column:
    """True where a reading can't be: outside the bounds, p99 above the maximum, or a flag that disagrees."""
    bad = F.lit(False)
    for c in _COLUMNS:
        bad |= F.coalesce(F.isnan(c) | (F.col(c) < -60) | (F.col(c) > 650), F.lit(False))
    bad |= F.coalesce(F.col("t_p99") > F.col("t_max"), F.lit(False))
    return bad | F.coalesce(F.col("over_range") != (F.col("t_max") > 250), F.lit(False))


def _found(pdf: pd.DataFrame, mask: np.ndarray, kind: str, part: int) -> pd.DataFrame:
    out = pdf.loc[mask, ["det_id", "spot_id", "at", "t_max", "t_p99"]]
    return out.assign(kind=kind, part=part)[["det_id", "kind", "spot_id", "at", "t_max", "t_p99", "part"]]


def _spike_mask(columns: list[np.ndarray], stats: list[tuple[float, float]] | None, least: float, times: float) -> np.ndarray:
    """Spikes of one source by any of its columns (NaN where there is no reading); middles and spreads may be known."""
    mask = np.zeros(len(columns[0]), dtype=bool)
    for k, v in enumerate(columns):
        there = ~np.isnan(v)
        x = v[there]
        if len(x):
            mask[there] |= spikes(x, None if stats is None else stats[k], least, times)
    return mask


def _stuck_mask(v: np.ndarray, least: int) -> np.ndarray:
    there = ~np.isnan(v)
    run, length = runs_without_detail(v[there])
    mask = np.zeros(len(v), dtype=bool)
    if len(run):
        mask[there] = length[run] >= least
    return mask


def faulty_readings(dets: DataFrame, least: float = 8.0, times: float = 12.0, stuck_run: int = 6, held: int = HELD) -> DataFrame:
    """``det_id, kind``: one row per faulty detection and kind (``impossible``, ``spike``, ``stuck``).

    Readings are range-partitioned by (spot, time, id), so a spot of any size is spread over tasks. A spot that lies
    inside one partition is decided there. The first and last spot of each partition may go on in the next one, and a
    task holds at most ``held`` readings of a spot: such stretches are cut, the medians of their spots found by
    ``exact_medians``, and their runs sewn together at the seams (two runs a stretch).
    Null readings prove nothing and are passed over, a null spot has no normal behaviour and can only be impossible, a
    null time comes last, equal times go by id; repeated detections each count; no rows give no rows."""
    marked = dets.select(F.col("det_id").cast("long"), F.col("spot_id").cast("long"), F.unix_micros(F.col("captured_at").cast("timestamp")).alias("at"), *[F.col(c).cast("double") for c in _COLUMNS], "over_range").withColumn("bad", impossible())
    first = marked.where("bad").select("det_id", F.lit("impossible").alias("kind"))
    order = [F.asc("spot_id"), F.asc_nulls_last("at"), F.asc("det_id")]
    usable = marked.where("not bad and spot_id is not null and (t_max is not null or t_p99 is not null)").select("spot_id", "at", "det_id", *_COLUMNS)
    spread = by_range(usable, order).sortWithinPartitions(*order)

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId() << 24
        open_rows, open_spot, is_edge = None, None, True  # the spot that isn't over yet; the first one is an edge

        def edge(rows: pd.DataFrame) -> pd.DataFrame:
            nonlocal part
            part += 1
            return _found(rows, np.ones(len(rows), dtype=bool), "edge", part)

        for pdf in batches:
            if not len(pdf):
                continue
            rows = pdf if open_rows is None else pd.concat([open_rows, pdf], ignore_index=True)
            spot = rows["spot_id"].to_numpy()
            if open_spot is not None and spot[0] != open_spot:
                is_edge = False  # the open spot was given out to its last row
            cuts = np.concatenate([[0], np.flatnonzero(spot[1:] != spot[:-1]) + 1]).astype(int)
            columns = [rows[c].to_numpy(dtype=float) for c in _COLUMNS]
            spike, stuck = np.zeros(len(rows), dtype=bool), np.zeros(len(rows), dtype=bool)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if is_edge:
                    yield edge(rows.iloc[a:b])
                    is_edge = False
                    continue
                spike[a:b] = _spike_mask([v[a:b] for v in columns], None, least, times)
                stuck[a:b] = _stuck_mask(columns[0][a:b], stuck_run)
            yield _found(rows, spike, "spike", part)
            yield _found(rows, stuck, "stuck", part)
            open_rows, open_spot = rows.iloc[cuts[-1] :].reset_index(drop=True), spot[-1]
            if len(open_rows) >= held:
                yield edge(open_rows)
                open_rows, is_edge = None, True
        if open_rows is not None and len(open_rows):
            yield edge(open_rows)

    stage = checkpointed(spread.mapInPandas(local, _STAGE))
    edge = stage.where("kind = 'edge'")
    long = edge.select("spot_id", F.inline(F.array(*[F.struct(F.lit(k).alias("c"), F.col(c).alias("v")) for k, c in enumerate(_COLUMNS)])))
    middle = checkpointed(exact_medians(long, ["spot_id", "c"], "v").select("spot_id", "c", F.col("median").alias("middle")))
    # at most two spots a partition, and those of ``held`` readings or more, so the tables of spots may be broadcast
    off = long.join(F.broadcast(middle), ["spot_id", "c"]).select("spot_id", "c", F.abs(F.col("v") - F.col("middle")).alias("v"))
    spreads = exact_medians(off, ["spot_id", "c"], "v").select("spot_id", "c", F.col("median").alias("spread"))
    stats = middle.join(spreads, ["spot_id", "c"]).groupBy("spot_id").agg(
        *[F.max(F.when(F.col("c") == k, F.col(s))).alias(f"{s}{k}") for k in range(2) for s in ("middle", "spread")]
    )

    def seams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None
        for pdf in batches:
            left = pdf if left is None else pd.concat([left, pdf], ignore_index=True)
            ids = left["part"].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1]).astype(int)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield from segment(left.iloc[a:b])
            left = left.iloc[cuts[-1] :].reset_index(drop=True)
        if left is not None and len(left):
            yield from segment(left)

    def segment(one: pd.DataFrame) -> Iterator[pd.DataFrame]:
        part = int(one["part"].iloc[0])
        known = [(float(one[f"middle{k}"].iloc[0]), float(one[f"spread{k}"].iloc[0])) for k in range(2)]
        yield _found(one, _spike_mask([one[c].to_numpy(dtype=float) for c in _COLUMNS], known, least, times), "spike", part)
        v = one["t_max"].to_numpy(dtype=float)
        where = np.flatnonzero(~np.isnan(v))
        run, length = runs_without_detail(v[where])
        if len(run):
            inner = (run > 0) & (run < run[-1])
            for mask, kind in ((inner & (length[run] >= stuck_run), "stuck"), (run == 0, "first"), ((run == run[-1]) & (run > 0), "last")):
                full = np.zeros(len(one), dtype=bool)
                full[where[mask]] = True
                yield _found(one, full, kind, part)

    again = edge.join(F.broadcast(stats), "spot_id").select("part", "spot_id", "at", "det_id", *_COLUMNS, "middle0", "spread0", "middle1", "spread1")
    again = again.repartition("part").sortWithinPartitions("part", *order).mapInPandas(seams, _STAGE)
    again = checkpointed(again)
    ends = again.where("kind in ('first', 'last')")
    w = Window.partitionBy("spot_id").orderBy("part", "kind")
    sewn = (
        ends.groupBy("spot_id", "part", "kind")
        .agg(F.count("*").alias("n"), F.first("t_max").alias("v"))
        .withColumn("new", F.when((F.lag("v").over(w) == F.col("v")) & (F.col("kind") == "first"), 0).otherwise(1))
        .withColumn("island", F.sum("new").over(w))
        .withColumn("n", F.sum("n").over(Window.partitionBy("spot_id", "island")))
        .where(F.col("n") >= stuck_run)
        .select("spot_id", "part", "kind")
    )
    stuck = ends.join(F.broadcast(sewn), ["spot_id", "part", "kind"], "left_semi").select("det_id", F.lit("stuck").alias("kind"))
    kinds = "kind in ('spike', 'stuck')"
    return first.unionByName(stage.where(kinds).select("det_id", "kind")).unionByName(again.where(kinds).select("det_id", "kind")).unionByName(stuck)
