"""Radiometric pictures: JPEG application segments, the record directory inside them, camera parameters, raw values."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_META = "model string, serial string, lens string, fov float, emissivity float, distance float, refl_temp float, r1 float, b float, f float, o int, r2 float, real2ir float, offset_x short, offset_y short"
SCHEMA = f"path string, error string, meta struct<{_META.replace(' ', ': ').replace(',: ', ', ')}>, height int, width int, temp array<float>, visual binary"
#: fixed values: byte offsets of the camera-parameter record, little-endian
_FLOATS = {"emissivity": 0x20, "distance": 0x24, "refl_temp": 0x28, "r1": 0x58, "b": 0x5C, "f": 0x60, "fov": 0x1B4, "r2": 0x30C}
_TEXTS = {"model": (0xD4, 32), "serial": (0x104, 16), "lens": (0x170, 32)}
RAW, EMBEDDED, CAMERA, PIP = 1, 14, 32, 42


def segments(blob: bytes) -> bytes:
    """Payload of the numbered ``FLIR`` application segments of a JPEG, in order of their numbers."""
    if blob[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at, parts = 2, {}
    while at + 4 <= len(blob) and blob[at] == 0xFF and blob[at + 1] != 0xDA:
        size = struct.unpack_from(">H", blob, at + 2)[0]
        body = blob[at + 4 : at + 2 + size]
        if blob[at + 1] == 0xE1 and body[:5] == b"FLIR\0":
            parts[body[6]] = body[8:]
        at += 2 + size
    if not parts:
        raise ValueError("no FLIR segment")
    return b"".join(parts[k] for k in sorted(parts))


def records(fff: bytes) -> dict[int, bytes]:
    """First record of each type in the directory; empty ones are passed over."""
    if fff[:4] != b"FFF\0":
        raise ValueError("not a record container")
    offset, count = struct.unpack_from(">II", fff, 0x18)
    out: dict[int, bytes] = {}
    for k in range(count):
        kind, = struct.unpack_from(">H", fff, offset + 32 * k)
        at, size = struct.unpack_from(">II", fff, offset + 32 * k + 12)
        if size and kind not in out:
            out[kind] = fff[at : at + size]
    return out


def camera(record: bytes, pip: bytes = b"") -> dict:
    """Camera parameters; temperatures in the record are kelvin, distances metres."""
    meta = {k: struct.unpack_from("<f", record, at)[0] if len(record) >= at + 4 else None for k, at in _FLOATS.items()}
    meta["refl_temp"] = None if meta["refl_temp"] is None else meta["refl_temp"] - 273.15
    meta["o"] = struct.unpack_from("<i", record, 0x308)[0] if len(record) >= 0x30C else None
    meta |= {k: record[at : at + n].split(b"\0")[0].decode("latin-1") for k, (at, n) in _TEXTS.items()}
    small = len(pip) >= 8
    meta["real2ir"], meta["offset_x"], meta["offset_y"] = struct.unpack_from("<fhh", pip, 0) if small else (None, None, None)
    return meta


def png16(blob: bytes) -> np.ndarray:
    """Samples of a grey 16-bit PNG without interlace."""
    if blob[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, data, head = 8, b"", None
    while at + 8 <= len(blob):
        size, = struct.unpack_from(">I", blob, at)
        name, body = blob[at + 4 : at + 8], blob[at + 8 : at + 8 + size]
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif name == b"IDAT":
            data += body
        at += 12 + size
    if head is None or head[2:4] != (16, 0) or head[6]:
        raise ValueError("not a grey 16-bit PNG")
    width, height = head[:2]
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(height, 1 + 2 * width)
    out = np.zeros((height, 2 * width), dtype=np.uint8)
    before = np.zeros(2 * width, dtype=np.uint8)
    for y in range(height):
        kind, line = int(raw[y, 0]), raw[y, 1:]
        if kind == 0:
            before = line
        elif kind == 1:  # sums along each of the two bytes of a sample
            before = np.cumsum(line.reshape(width, 2), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            before = line + before
        else:
            before = np.array(_along(kind, line.tolist(), before.tolist()), dtype=np.uint8)
        out[y] = before
    return out.reshape(height, width, 2).astype(np.uint16) @ np.array([256, 1], dtype=np.uint16)


def _along(kind: int, line: list[int], above: list[int]) -> list[int]:
    """Bytes of a row whose guesses need its own earlier bytes: the mean of left and above, or the nearest neighbour."""
    now: list[int] = [0, 0]  # two bytes to the left of the row
    above = [0, 0, *above]
    for x, v in enumerate(line):
        a, b, c = now[x], above[x + 2], above[x]
        if kind == 3:
            guess = (a + b) >> 1
        else:
            pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = a if pa <= pb and pa <= pc else b if pb <= pc else c
        now.append((v + guess) & 255)
    return now[2:]


def tiff16(blob: bytes) -> np.ndarray:
    """Samples of the first image of a grey 16-bit TIFF: whole, deflated or byte-run strips, with or without differences."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(blob[:4])
    if order is None:
        raise ValueError("not a TIFF")
    at, = struct.unpack_from(order + "I", blob, 4)
    tags: dict[int, list[int]] = {}
    for k in range(struct.unpack_from(order + "H", blob, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", blob, at + 2 + 12 * k)
        form = {1: "B", 3: "H", 4: "I"}.get(kind)
        if form is None:
            continue
        size = n * struct.calcsize(form)
        where = at + 10 + 12 * k if size <= 4 else struct.unpack_from(order + "I", blob, at + 10 + 12 * k)[0]
        tags[tag] = list(struct.unpack_from(f"{order}{n}{form}", blob, where))
    one = lambda tag, default: tags.get(tag, [default])[0]
    width, height, packed = one(256, 0), one(257, 0), one(259, 1)
    if not width or not height or one(258, 1) != 16 or one(277, 1) != 1 or packed not in (1, 8, 32946, 32773) or 273 not in tags:
        raise ValueError("not a grey 16-bit TIFF of a known packing")
    counts = tags.get(279) or [len(blob) - tags[273][0]]
    parts = [blob[o : o + n] for o, n in zip(tags[273], counts, strict=True)]
    if packed == 32773:
        parts = [_runs(p) for p in parts]
    elif packed != 1:
        parts = [zlib.decompress(p) for p in parts]
    data = np.frombuffer(b"".join(parts)[: 2 * width * height], dtype=order + "u2")
    if len(data) != width * height:
        raise ValueError("the image is cut off")
    image = data.reshape(height, width).astype(np.uint16)
    return np.cumsum(image, axis=1, dtype=np.uint16) if one(317, 1) == 2 else image


def _runs(packed: bytes) -> bytes:
    out, at = bytearray(), 0
    while at < len(packed):
        n = packed[at]
        if n < 128:
            out += packed[at + 1 : at + 2 + n]
            at += 2 + n
        else:
            out += packed[at + 1 : at + 2] * (257 - n if n > 128 else 0)
            at += 2 if n > 128 else 1
    return bytes(out)


def celsius(raw: np.ndarray, meta: dict) -> np.ndarray:
    """Temperatures of raw values; NaN where the formula has none. Values stored in the other byte order are swapped."""
    if raw.max(initial=0) > 30000:
        raw = raw.byteswap()
    e, r1, b, f, o, r2 = (float(meta[k]) for k in ("emissivity", "r1", "b", "f", "o", "r2"))
    with np.errstate(all="ignore"):
        back = r1 / (r2 * (np.exp(b / (meta["refl_temp"] + 273.15)) - f)) - o
        own = (raw.astype(float) - (1 - e) * back) / e
        return (b / np.log(r1 / (r2 * (own + o)) + f) - 273.15).astype(np.float32)


def centikelvin(raw: np.ndarray) -> np.ndarray:
    return raw.astype(float) / 100 - 273.15


def decode(blob: bytes) -> tuple[dict, np.ndarray, bytes | None]:
    """Camera parameters, temperatures and the embedded visual picture (a JPEG, as it is; null without one)."""
    rec = records(segments(blob))
    meta = camera(rec[CAMERA], rec.get(PIP, b""))
    image = rec[RAW]
    inner = rec.get(EMBEDDED, b"")
    start = inner.find(b"\xff\xd8\xff")
    return meta, celsius(png16(image[image.index(b"\x89PNG") :]), meta), inner[start:] if start >= 0 else None


def decoded(files: DataFrame, name: str, content: str) -> DataFrame:
    """``path, error, meta, height, width, temp, visual`` of radiometric pictures in a table; a picture that can't be read has its
    error and nulls, a null one too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, blob in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    meta, temp, visual = decode(bytes(blob))
                    row = (path, None, meta, *temp.shape, temp.ravel(), visual)
                except (ValueError, KeyError, struct.error, zlib.error, TypeError) as e:
                    row = (path, f"{type(e).__name__}: {e}", None, None, None, None, None)
                # one picture a frame: ten thousand of them would not fit
                yield pd.DataFrame([row], columns=["path", "error", "meta", "height", "width", "temp", "visual"]).astype({"height": "Int32", "width": "Int32"})

    return files.select(F.col(name).cast("string").alias("path"), F.col(content).alias("content")).mapInPandas(run, SCHEMA)


def decoded_centikelvin(files: DataFrame, name: str, content: str) -> DataFrame:
    """``path, error, height, width, temp`` of TIFF images in a table, as ``decoded``; samples are hundredths of a kelvin."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, blob in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    temp = centikelvin(tiff16(bytes(blob))).astype(np.float32)
                    row = (path, None, *temp.shape, temp.ravel())
                except (ValueError, struct.error, zlib.error, TypeError) as e:
                    row = (path, f"{type(e).__name__}: {e}", None, None, None)
                yield pd.DataFrame([row], columns=["path", "error", "height", "width", "temp"]).astype({"height": "Int32", "width": "Int32"})

    return files.select(F.col(name).cast("string").alias("path"), F.col(content).alias("content")).mapInPandas(run, "path string, error string, height int, width int, temp array<float>")


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def read_pictures(spark: SparkSession, path: str, pattern: str = "*.jpg") -> DataFrame:
    """``decoded`` pictures of a folder, one row a file (Spark passes over empty files)."""
    return decoded(_files(spark, path, pattern), "path", "content")


def read_centikelvin(spark: SparkSession, path: str, pattern: str = "*.tif*") -> DataFrame:
    """``decoded_centikelvin`` images of a folder, one row a file (Spark passes over empty files)."""
    return decoded_centikelvin(_files(spark, path, pattern), "path", "content")
