"""Column builders for boxes: conversions, pixel windows, overlaps."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: on-screen-display rectangles of a 320 x 240 frame, half-open (x0, y0, x1, y1)
OSD = ((302, 0, 318, 240), (276, 2, 318, 27), (276, 212, 318, 237), (2, 2, 100, 27), (2, 217, 58, 237))
#: fixed values: registration of the visual to the infrared picture
SCALE, X0, Y0 = 1.53, 44, 46


def corners(cx: Column, cy: Column, w: Column, h: Column, width: float, height: float) -> list[Column]:
    """x1, y1, x2, y2 in pixels of a box given by centre and size as shares of the frame."""
    return [(cx - w / 2) * width, (cy - h / 2) * height, (cx + w / 2) * width, (cy + h / 2) * height]


def shares(x1: Column, y1: Column, x2: Column, y2: Column, width: float, height: float) -> list[Column]:
    """Inverse of ``corners``."""
    return [(x1 + x2) / 2 / width, (y1 + y2) / 2 / height, (x2 - x1) / width, (y2 - y1) / height]


def pixel_window(box: Sequence[Column], width: int, height: int, rounding: str = "half_even") -> list[Column]:
    """Integer window inside the frame; ``rounding`` is ``half_even`` (then clip) or ``truncate`` (then clip)."""
    whole = (lambda c: F.bround(c).cast("int")) if rounding == "half_even" else (lambda c: c.cast("int"))
    x1, y1, x2, y2 = map(whole, box)
    return [F.greatest(F.lit(0), x1), F.greatest(F.lit(0), y1), F.least(F.lit(width), x2), F.least(F.lit(height), y2)]


def calibration(text: str) -> tuple[float, float, float]:
    """Scale and shift (x, y) of a calibration file (JSON with ``scale``, ``x0`` and ``y0``); what it lacks is as registered."""
    given = json.loads(text)
    return tuple(float(given.get(k, v)) for k, v in (("scale", SCALE), ("x0", X0), ("y0", Y0)))


def visual_to_ir(x: Column, y: Column, by: tuple[float, float, float] = (SCALE, X0, Y0)) -> list[Column]:
    return [x / by[0] - by[1], y / by[0] - by[2]]


def ir_to_visual(x: Column, y: Column, by: tuple[float, float, float] = (SCALE, X0, Y0)) -> list[Column]:
    return [(x + by[1]) * by[0], (y + by[2]) * by[0]]


def visual_box_to_ir(box: Sequence[Column], width: int = 320, height: int = 240, least_side: float = 2, least_share: float = 0.35, by: tuple[float, float, float] = (SCALE, X0, Y0)) -> Column:
    """Struct x1, y1, x2, y2 of a box moved to the infrared frame and clipped.

    Null if a side is then under ``least_side`` or less than ``least_share`` of the area is left."""
    x1, y1 = visual_to_ir(box[0], box[1], by)
    x2, y2 = visual_to_ir(box[2], box[3], by)
    a, b = F.greatest(F.lit(0.0), x1), F.greatest(F.lit(0.0), y1)
    c, d = F.least(F.lit(float(width)), x2), F.least(F.lit(float(height)), y2)
    kept = (c - a >= least_side) & (d - b >= least_side) & ((c - a) * (d - b) >= least_share * (x2 - x1) * (y2 - y1))
    return F.when(kept, F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2")))


def intersection(a: Sequence[Column], b: Sequence[Column]) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def area(b: Sequence[Column]) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def iou(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Intersection over union; 0 where the boxes are apart."""
    common = intersection(a, b)
    return common / F.greatest(area(a) + area(b) - common, F.lit(1e-9))


def osd_overlap(box: Sequence[Column], width: float = 320, height: float = 240, rectangles: Sequence[tuple] = OSD) -> Column:
    """Share of a box that on-screen-display rectangles cover; where they overlap, they count twice."""
    sx, sy = width / 320, height / 240
    covered = F.lit(0.0)
    for x0, y0, x1, y1 in rectangles:
        covered = covered + intersection(box, [F.lit(float(x0 * sx)), F.lit(float(y0 * sy)), F.lit(float(x1 * sx)), F.lit(float(y1 * sy))])
    return covered / F.greatest(area(box), F.lit(1e-9))


def shape(box: Sequence[Column], width: float = 320, height: float = 240) -> list[Column]:
    """Width, height, share of the frame in percent, ratio of width to height."""
    w, h = box[2] - box[0], box[3] - box[1]
    return [w, h, w * h / (width * height) * 100, w / F.greatest(h, F.lit(1e-9))]
