"""Statistics of boxes on rasters: which pixels lie in a box, and their percentile, maximum and mean, in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calorgrid.functions.geometry import pixel_window
from calorgrid.functions.keys import let


def box_pixels(raster: Column, window: Sequence[Column], width: int, rectangles: Sequence[tuple] = (), finite_only: bool = True) -> Column:
    """Values of a row-major raster inside an integer window (x1, y1, x2, y2; half-open), row by row, but for those under
    ``rectangles`` (on-screen display) and, unless told otherwise, NaN and infinities. Null values are never valid."""
    x1, y1, x2, y2 = window

    def row(y: Column) -> Column:
        part = F.slice(raster, y * width + x1 + 1, x2 - x1)
        if rectangles:
            part = F.transform(part, lambda v, i: F.when(_shown(x1 + i, y, rectangles), v))
        return F.filter(part, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))) if finite_only else v.isNotNull())

    rows = F.flatten(F.transform(F.sequence(y1, y2 - 1), row))
    return F.when((x2 > x1) & (y2 > y1), rows).otherwise(F.array().cast("array<double>")).cast("array<double>")


def _shown(x: Column, y: Column, rectangles: Sequence[tuple]) -> Column:
    hidden = F.lit(False)
    for a, b, c, d in rectangles:
        hidden |= (x >= a) & (x < c) & (y >= b) & (y < d)
    return ~hidden


def array_percentile(ordered: Column, share: float) -> Column:
    """Interpolated percentile of a sorted array; null of an empty one."""
    place = (F.size(ordered) - 1) * F.lit(float(share))
    low = F.floor(place).cast("int")
    a, b = F.get(ordered, low), F.get(ordered, F.ceil(place).cast("int"))
    return F.when(F.size(ordered) > 0, a + (b - a) * (place - low))


def array_mean(v: Column) -> Column:
    return F.when(F.size(v) > 0, F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.size(v))


def summary(pixels: Column, least_px: int = 4, few: int = 200, saturated: float = 250.0) -> Column:
    """Struct ``t_p99, t_max, t_mean, n_px, low_confidence, over_range`` of an array of values; null under ``least_px``."""
    return let(
        F.array_sort(pixels),
        lambda v: F.when(
            F.size(v) >= least_px,
            F.struct(
                array_percentile(v, 0.99).alias("t_p99"), F.element_at(v, -1).alias("t_max"), array_mean(v).alias("t_mean"), F.size(v).alias("n_px"),
                (F.size(v) < few).alias("low_confidence"), (F.element_at(v, -1) > saturated).alias("over_range"),
            ),
        ),
    )


def box_statistics(
    frames: DataFrame,
    boxes: DataFrame,
    frame: str,
    raster: str,
    width: int,
    height: int,
    rounding: str = "half_even",
    least_side: int = 2,
    least_px: int = 4,
    rectangles: Sequence[tuple] = (),
    unmasked_fallback: bool = False,
    finite_only: bool = True,
    few: int = 200,
) -> DataFrame:
    """``boxes`` (frame, x1, y1, x2, y2 in pixels, and others) with the statistics of their pixels on the frame's raster.

    A box's window is rounded (``half_even`` or ``truncate``) and clipped; statistics are null if it then has a side under
    ``least_side``, fewer than ``least_px`` valid pixels, or its frame no raster of that size. With ``unmasked_fallback``
    pixels under rectangles count where a box has no others. Boxes of no frame are kept, frames without boxes give no row.
    The raster is read where it is joined and goes no further."""
    window = pixel_window([F.col(c) for c in ("x1", "y1", "x2", "y2")], width, height, rounding)
    own = boxes.withColumn("_w", F.struct(*[c.alias(n) for c, n in zip(window, ("a", "b", "c", "d"), strict=True)]))
    there = frames.where(F.size(raster) == width * height).select(F.col(frame).alias("_frame"), F.col(raster).alias("_raster"))
    both = own.join(there, F.col(frame) == F.col("_frame"), "left")
    w = [F.col(f"_w.{n}") for n in ("a", "b", "c", "d")]
    pixels = box_pixels(F.col("_raster"), w, width, rectangles, finite_only)
    if unmasked_fallback and rectangles:
        pixels = let(pixels, lambda p: F.when(F.size(p) > 0, p).otherwise(box_pixels(F.col("_raster"), w, width, (), finite_only)))
    fits = (w[2] - w[0] >= least_side) & (w[3] - w[1] >= least_side) & F.col("_raster").isNotNull()
    out = both.withColumn("_s", F.when(fits, summary(pixels, least_px, few)))
    return out.select(*boxes.columns, "_s.*")
