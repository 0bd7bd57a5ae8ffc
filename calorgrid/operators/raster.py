"""Raster kernels in numpy, and their use over array columns by Arrow batches. One row is one frame."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calorgrid.functions.geometry import OSD


def osd_mask(width: int = 320, height: int = 240) -> np.ndarray:
    """True where no on-screen display lies."""
    mask = np.ones((height, width), dtype=bool)
    for x0, y0, x1, y1 in OSD:
        mask[y0:y1, x0:x1] = False
    return mask


def label_components(hot: np.ndarray, neighbours: int = 4) -> np.ndarray:
    """Component number of each true pixel (0 elsewhere), numbered by their first pixel, for 4 or 8 neighbours.

    Labels spread to the least of the neighbourhood until nothing changes, in whole-array steps."""
    big = hot.size + 1
    lab = np.where(hot, np.arange(1, hot.size + 1).reshape(hot.shape), big)
    h, w = hot.shape
    shifts = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if neighbours == 8 else [])
    while True:
        new = np.pad(lab, 1, constant_values=big)
        best = lab
        for dy, dx in shifts:
            for s in (1, -1):
                best = np.minimum(best, new[1 + s * dy : 1 + s * dy + h, 1 + s * dx : 1 + s * dx + w])
        best = np.where(hot, best, big)
        flat = np.append(np.append(0, best.ravel()), 0)  # jump to the label of the label
        best = np.where(hot, np.minimum(best, flat[np.where(hot, best, 0)]), big)
        if (best == lab).all():
            break
        lab = best
    out = np.zeros(hot.shape, dtype=int)
    if hot.any():
        out[hot] = np.unique(lab[hot], return_inverse=True)[1] + 1
    return out


def blobs(temp: np.ndarray, mask: np.ndarray, rise: float, least: int = 12, neighbours: int = 4) -> tuple[float, list[tuple]]:
    """Reference (median of valid pixels) and (x1, y1, x2, y2, px, peak, mean, rise) of each region that far above it,
    the hottest first."""
    valid = mask & np.isfinite(temp)
    if not valid.any():
        return float("nan"), []
    ref = float(np.median(temp[valid]))
    lab = label_components(valid & (temp - ref >= rise), neighbours)
    out = []
    for k in range(1, lab.max() + 1):
        ys, xs = np.nonzero(lab == k)
        if len(ys) >= least:
            t = temp[ys, xs]
            out.append((int(xs.min()), int(ys.min()), int(xs.max()) + 1, int(ys.max()) + 1, len(ys), float(t.max()), float(t.mean()), float(t.max()) - ref))
    return ref, sorted(out, key=lambda b: -b[7])


def median_filter(a: np.ndarray, size: int = 5) -> np.ndarray:
    """Median of each pixel's neighbourhood, the rim repeated."""
    p = np.pad(a, size // 2, mode="edge")
    return np.median(np.lib.stride_tricks.sliding_window_view(p, (size, size)), axis=(2, 3))


def area_resize(a: np.ndarray, width: int, height: int) -> np.ndarray:
    """Area-average resampling to any smaller size."""

    def weights(n: int, m: int) -> np.ndarray:
        edges = np.arange(m + 1) * n / m
        lo, hi = edges[:-1, None], edges[1:, None]
        cover = np.clip(np.minimum(hi, np.arange(1, n + 1)) - np.maximum(lo, np.arange(n)), 0, None)
        return cover / cover.sum(axis=1, keepdims=True)

    return weights(a.shape[0], height) @ a @ weights(a.shape[1], width).T


def nearest_resize(a: np.ndarray, width: int, height: int) -> np.ndarray:
    return a[(np.arange(height) * a.shape[0] // height)[:, None], np.arange(width) * a.shape[1] // width]


def blur(a: np.ndarray, sigma: float) -> np.ndarray:
    r = max(1, int(3 * sigma + 0.5))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    k /= k.sum()
    for axis in (0, 1):
        a = np.apply_along_axis(lambda v: np.convolve(np.pad(v, r, mode="edge"), k, mode="valid"), axis, a)
    return a


def degrade(a: np.ndarray, width: int, height: int, seed: int, sigma: float = 0.6, noise: float = 0.05) -> np.ndarray:
    """A coarser camera's view: area resampling, blur and seeded noise."""
    return blur(area_resize(a, width, height), sigma) + np.random.default_rng(seed).normal(0, noise, (height, width))


def edges(a: np.ndarray) -> np.ndarray:
    """Response of the 3x3 edge kernel (8 in the middle, -1 around), rim of two pixels zeroed."""
    p = np.pad(a.astype(float), 1, mode="edge")
    s = np.lib.stride_tricks.sliding_window_view(p, (3, 3)).sum(axis=(2, 3))
    out = np.zeros(a.shape)
    inner = (slice(2, -2), slice(2, -2))
    out[inner] = np.clip(9 * a - s, 0, 255)[inner]
    return out


def masked_ncc(template: np.ndarray, mask: np.ndarray, image: np.ndarray) -> tuple[float, int, int]:
    """Best normalised cross-correlation of a masked template over all its places in an image, and that place (x, y).

    All places at once by Fourier transform; a place without contrast scores 0."""
    th, tw = template.shape
    ih, iw = image.shape
    m = mask.astype(float)
    n = m.sum()
    if n < 2 or th > ih or tw > iw:
        return 0.0, 0, 0
    t = (template - (template * m).sum() / n) * m
    size = (ih + th - 1, iw + tw - 1)
    transform = lambda x: np.fft.rfft2(x, size)
    fm, fi, fii, ft = transform(m[::-1, ::-1]), transform(image), transform(image * image), transform(t[::-1, ::-1])
    back = lambda f: np.fft.irfft2(f, size)[th - 1 : ih, tw - 1 : iw]
    s, ss, cross = back(fi * fm), back(fii * fm), back(fi * ft)
    spread = np.maximum(ss - s * s / n, 0)
    norm = np.sqrt(spread * (t * t).sum())
    score = np.where(norm > 1e-9, cross / np.maximum(norm, 1e-9), 0)
    y, x = np.unravel_index(int(score.argmax()), score.shape)
    return float(score[y, x]), int(x), int(y)


def best_scale(template: np.ndarray, mask: np.ndarray, image: np.ndarray, scales: np.ndarray) -> tuple[float, float, int, int]:
    """(ncc, scale, x, y) of the scale at which the template fits best; the first of equal ones."""
    best = (-2.0, 0.0, 0, 0)
    for s in scales:
        h, w = int(round(template.shape[0] * s)), int(round(template.shape[1] * s))
        ncc, x, y = masked_ncc(nearest_resize(template, w, h), nearest_resize(mask, w, h), image)
        if ncc > best[0]:
            best = (ncc, float(s), x, y)
    return best


def registered(pairs: DataFrame, ident: str, template: str, template_size: tuple[int, int], image: str, image_size: tuple[int, int], scales: Sequence[float], rectangles: Sequence[tuple] = ()) -> DataFrame:
    """``ident, ncc, scale, x, y``: where, and at which scale, the template of each row fits its image best (see ``best_scale``).

    Sizes are (width, height) of row-major arrays; template pixels under ``rectangles`` don't count. A row with an array of
    another size, or null, has nulls."""
    kind = dict(pairs.dtypes)[ident]
    (tw, th), (iw, ih) = template_size, image_size
    mask = np.ones((th, tw), dtype=bool)
    for a, b, c, d in rectangles:
        mask[b:d, a:c] = False

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, t, im in zip(pdf[ident], pdf[template], pdf[image], strict=True):
                if t is None or im is None or len(t) != tw * th or len(im) != iw * ih:
                    out.append((i, None, None, None, None))
                    continue
                ncc, scale, x, y = best_scale(np.asarray(t, dtype=float).reshape(th, tw), mask, np.asarray(im, dtype=float).reshape(ih, iw), np.asarray(scales))
                out.append((i, ncc, scale, x, y))
            yield pd.DataFrame(out, columns=[ident, "ncc", "scale", "x", "y"]).astype({"x": "Int32", "y": "Int32"})

    return pairs.select(ident, template, image).mapInPandas(run, f"`{ident}` {kind}, ncc double, scale double, x int, y int")


def frame_blobs(frames: DataFrame, ident: str, raster: str, width: int, height: int, rise: float, least: int, neighbours: int = 4, masked: bool = False) -> DataFrame:
    """``ident, blob, x1, y1, x2, y2, px, peak, mean, rise`` of each hot region of each frame (row-major array of height x width).

    A null raster, or one of another size, has no regions."""
    mask = osd_mask(width, height) if masked else np.ones((height, width), dtype=bool)
    kind = dict(frames.dtypes)[ident]
    cols = [ident, "blob", "x1", "y1", "x2", "y2", "px", "peak", "mean", "rise"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, v in zip(pdf[ident], pdf[raster], strict=True):
                if v is not None and len(v) == width * height:
                    found = blobs(np.asarray(v, dtype=float).reshape(height, width), mask, rise, least, neighbours)[1]
                    out += [(i, k, *b) for k, b in enumerate(found)]
            yield pd.DataFrame(out, columns=cols)

    return frames.select(ident, raster).mapInPandas(run, f"`{ident}` {kind}, blob int, x1 int, y1 int, x2 int, y2 int, px int, peak double, mean double, rise double")


def mapped(frames: DataFrame, raster: str, width: int, height: int, kernel, name: str) -> DataFrame:
    """``frames`` with ``kernel`` of each raster (2-d array in, array out) as a flat array column; null where there is none."""

    @F.pandas_udf("array<double>")
    def run(v: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or len(x) != width * height else kernel(np.asarray(x, dtype=float).reshape(height, width)).ravel() for x in v], dtype=object)

    return frames.withColumn(name, run(F.col(raster)))


def hot_share(v: Column, near: float = 5.0) -> Column:
    """Percent of an array's values within ``near`` of its maximum."""
    top = F.array_max(v)
    return F.size(F.filter(v, lambda x: x >= top - near)) * 100 / F.size(v)
