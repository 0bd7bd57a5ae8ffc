"""Numeric column builders: quantisation, stretching, vectors, radiometry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from calorgrid.functions.keys import let


def finite(c: Column) -> Column:
    """The value, or null if it is NaN or infinite; -0.0 is 0.0."""
    return F.when(F.abs(c) < F.lit(float("inf")), c + F.lit(0.0))


def filled(c: Column, instead: Column) -> Column:
    """The value, or ``instead`` where it is null, NaN or infinite."""
    return F.coalesce(finite(c), instead)


def to_byte(x: Column, lo: Column, hi: Column) -> Column:
    """Scaled to 0..255, clipped, truncated."""
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), (x - lo) / F.greatest(hi - lo, F.lit(1e-6)) * 255))).cast("int")


def quantise(x: Column, lo: float, hi: float, steps: int = 255) -> Column:
    """The value as an n-step code gives it back, rounded half to even."""
    code = F.greatest(F.lit(0.0), F.least(F.lit(float(steps)), F.rint((x - lo) / (hi - lo) * steps)))
    return code / steps * (hi - lo) + lo


def standardised(v: Column) -> Column:
    """(v - mean) / (population deviation + 1e-6) of an array."""
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double")) / F.size(a)
    return let(
        F.struct(v.alias("v"), mean(v).alias("m")),
        lambda s: let(
            F.struct(s["v"].alias("v"), s["m"].alias("m"), F.sqrt(mean(F.transform(s["v"], lambda x: (x - s["m"]) * (x - s["m"])))).alias("d")),
            lambda t: F.transform(t["v"], lambda x: (x - t["m"]) / (t["d"] + 1e-6)),
        ),
    )


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def celsius_of_centikelvin(raw: Column) -> Column:
    return raw / 100 - 273.15


def planck_celsius(raw: Column, r1: Column, r2: Column, b: Column, f: Column, o: Column, emissivity: Column, reflected: Column) -> Column:
    """Temperature of a raw radiometric reading: reflected radiation is taken off, then Planck's law is inverted."""
    back = r1 / (r2 * (F.exp(b / (reflected + 273.15)) - f)) - o
    own = (raw - (1 - emissivity) * back) / emissivity
    inside = r1 / (r2 * (own + o)) + f
    return F.when(inside > 1, b / F.log(inside) - 273.15)


def bar(n: Column, most: Column, width: int = 46) -> Column:
    return F.repeat(F.lit("#"), F.floor(n / F.greatest(most, F.lit(1)) * width).cast("int"))


def nearest(value: Sequence[Column], palette: Sequence[tuple[float, ...]]) -> Column:
    """Index of the nearest palette entry by squared distance; the first of equal ones."""
    spot = F.array(*[F.struct(sum(((v - F.lit(float(p))) * (v - F.lit(float(p))) for v, p in zip(value, entry, strict=True)), F.lit(0.0)).alias("d"), F.lit(i).alias("i")) for i, entry in enumerate(palette)])
    return F.array_min(spot)["i"]
