"""Group statistics: ambient estimates, profiles, rollups, exceedance, histograms, error measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calorgrid.operators.exact import quantiles
from calorgrid.operators.windows import numbered


def ambient_by_percentile(rows: DataFrame, by: Sequence[str], value: str, share: float = 0.1) -> DataFrame:
    """``by..., ambient``: mean of the values up to the (interpolated) percentile of their group."""
    cut = rows.groupBy(*by).agg(F.percentile(value, share).alias("_cut"))
    return rows.join(cut, list(by)).where(F.col(value) <= F.col("_cut")).groupBy(*by).agg(F.avg(value).alias("ambient"))


def ambient_by_rank(rows: DataFrame, by: Sequence[str], value: str, share: float = 0.1) -> DataFrame:
    """``by..., ambient``: mean of the lowest max(1, floor(share n)) values of the group; null values are left out.

    Places come from range partitions (``numbered``), so no group is sorted in one task."""
    there = rows.where(F.col(value).isNotNull()).withColumn("_v", F.col(value).cast("double"))
    n = there.groupBy(*by).agg(F.count("*").alias("_n"))
    k = F.greatest(F.lit(1), F.floor(F.col("_n") * share))
    placed = numbered(there.select(*by, "_v"), by, [F.col("_v")], "_i")
    low = beside(placed, n, by).where(F.col("_i") < k)
    return low.groupBy(*by).agg(F.avg("_v").alias("ambient"))


def quantile_columns(value: str, shares: dict[str, float], accuracy: int | None = None) -> list[Column]:
    """Exact interpolated percentiles; with ``accuracy`` ones of rank error 1/accuracy, in bounded memory, for groups whose
    distinct values are too many for one task."""
    if accuracy:
        return [F.percentile_approx(value, q, accuracy).cast("double").alias(name) for name, q in shares.items()]
    return [F.percentile(value, q).alias(name) for name, q in shares.items()]


def beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left`` with the other columns of ``right``, which has one row a key; null keys are equal."""
    on = F.lit(True)
    for k in keys:
        on &= F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return left.alias("l").join(right.alias("r"), on).select("l.*", *[f"r.{c}" for c in right.columns if c not in keys])


def frame_statistics(rows: DataFrame, by: Sequence[str], value: str, saturated: float = 250.0, near: float = 5.0) -> DataFrame:
    """Count, median, mean, p95, p99, p99.9, maximum, saturated values, and values near the maximum with their share."""
    top = rows.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("t_mean"), F.max(value).alias("t_max"), F.count_if(F.col(value) > saturated).alias("n_saturated"))
    top = beside(top, quantiles(rows, list(by), value, {"t_med": 0.5, "t_p95": 0.95, "t_p99": 0.99, "t_p999": 0.999}), by)
    hot = rows.join(top.select(*by, "t_max"), list(by)).groupBy(*by).agg(F.count_if(F.col(value) >= F.col("t_max") - near).alias("n_near"))
    return top.join(hot, list(by)).withColumn("near_pct", F.col("n_near") * 100 / F.col("n"))


def spread_profile(rows: DataFrame, frame: str, cls: str, value: str, over: Sequence[float] = (5, 15)) -> DataFrame:
    """Spread (max - min) of a class within a frame where it occurs twice or more, profiled per class."""
    each = rows.groupBy(frame, cls).agg(F.count(value).alias("k"), (F.max(value) - F.min(value)).alias("spread")).where("k >= 2")
    out = each.groupBy(cls).agg(F.count("*").alias("n"), F.max("spread").alias("most"), *[F.count_if(F.col("spread") > x).alias(f"over_{x:g}") for x in over])
    return beside(out, quantiles(each, [cls], "spread", {"med": 0.5, "p90": 0.9, "p99": 0.99}), [cls])


def with_all(rows: DataFrame, by: str) -> DataFrame:
    """Each row under its group (a null one is ``(none)``) and again under ``(all)``."""
    return rows.withColumn(by, F.explode(F.array(F.coalesce(F.col(by).cast("string"), F.lit("(none)")), F.lit("(all)"))))


def rolled_up(rows: DataFrame, by: str, aggregates: Sequence[Column]) -> DataFrame:
    """Aggregates per group and, under ``(all)``, of everything; a null group is ``(none)``."""
    plain = rows.withColumn("_g", F.coalesce(F.col(by).cast("string"), F.lit("(none)")))
    out = plain.rollup("_g").agg(F.grouping("_g").alias("_all"), *aggregates)
    return out.withColumn(by, F.when(F.col("_all") == 1, "(all)").otherwise(F.col("_g"))).drop("_g", "_all").select(by, *[c for c in out.columns if c not in ("_g", "_all")])


def exceedance(value: str, steps: Sequence[float]) -> list[Column]:
    return [F.count_if(F.col(value) >= s).alias(f"ge_{s:g}") for s in steps] + [(F.count_if(F.col(value) >= s) * 100 / F.greatest(F.count(value), F.lit(1))).alias(f"pct_{s:g}") for s in steps]


def histogram(rows: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    """``bin, n`` over half-open bins between the edges; the last bin has no upper end, values below the first have -1."""
    i = F.lit(-1)
    for k, e in enumerate(edges):
        i = F.when(F.col(value) >= e, k).otherwise(i)
    return rows.where(F.col(value).isNotNull()).groupBy(i.alias("bin")).agg(F.count("*").alias("n"))


def crosstab(rows: DataFrame, by: str, across: str, values: Sequence[str], bad: Sequence[str] = ()) -> DataFrame:
    """Counts of each value per group, with total and, if ``bad`` is given, the share of bad ones in percent."""
    out = rows.groupBy(by).agg(*[F.count_if(F.col(across) == v).alias(f"n_{v}") for v in values], F.count("*").alias("total"))
    if bad:
        out = out.withColumn("bad_pct", sum((F.col(f"n_{v}") for v in bad), F.lit(0)) * 100 / F.col("total"))
    return out


def linear_fit(rows: DataFrame, by: Sequence[str], y: str, x: str, least: int = 3) -> DataFrame:
    """Correlation, r squared and RMSE of the least-squares line, null under ``least`` pairs."""
    pairs = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    out = pairs.groupBy(*by).agg(F.count("*").alias("n"), F.corr(y, x).alias("r"), F.regr_r2(y, x).alias("r2"), F.regr_syy(y, x).alias("_s"))
    enough = F.col("n") >= least
    return out.select(*by, "n", F.when(enough, F.col("r")).alias("r"), F.when(enough, F.col("r2")).alias("r2"), F.when(enough, F.sqrt(F.greatest(F.lit(0.0), F.col("_s") * (1 - F.col("r2")) / F.col("n")))).alias("rmse"))


def window_sweep(rows: DataFrame, value: str, windows: Sequence[tuple[float, float]]) -> DataFrame:
    """For each 8-bit window (lo, hi): share outside, RMSE, p95 and maximum of the quantisation error."""
    from calorgrid.functions.numeric import quantise

    x = F.col(value)
    parts = F.array(*[F.struct(F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"), F.abs(x - quantise(x, lo, hi)).alias("e"), ((x < lo) | (x > hi)).alias("out")) for lo, hi in windows])
    each = rows.where(x.isNotNull()).select(F.inline(parts))
    out = each.groupBy("lo", "hi").agg(F.count("*").alias("n"), (F.count_if("out") * 100 / F.count("*")).alias("outside_pct"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"), F.max("e").alias("most"))
    return beside(out, quantiles(each, ["lo", "hi"], "e", {"p95": 0.95}), ["lo", "hi"])


def quality_gated(rows: DataFrame, quality: str, least: float, least_rows: int) -> DataFrame:
    """Rows of at least that quality if there are ``least_rows`` of them, else all rows."""
    enough = rows.agg((F.count_if(F.col(quality) >= least) >= least_rows).alias("_enough"))  # one row
    return rows.join(F.broadcast(enough), F.coalesce(F.col(quality) >= least, F.lit(False)) | ~F.col("_enough")).drop("_enough")
