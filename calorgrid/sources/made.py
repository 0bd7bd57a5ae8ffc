"""Made-up pictures in the formats that ``flir`` reads, as input of trial runs and round trips."""

from __future__ import annotations

import struct
import zlib

import numpy as np

from calorgrid.sources import flir


def png16(raw: np.ndarray) -> bytes:
    """A grey 16-bit PNG; rows are stored plainly, as differences to the left and as differences to the row above, in turn."""
    height, width = raw.shape
    rows = raw.astype(">u2").view(np.uint8).reshape(height, 2 * width)
    left, above = rows.copy(), rows.copy()
    left[:, 2:] -= rows[:, :-2]
    above[1:] -= rows[:-1]
    lines = b"".join(bytes([y % 3]) + (rows, left, above)[y % 3][y].tobytes() for y in range(height))
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    head = struct.pack(">IIBBBBB", width, height, 16, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def picture(raw: np.ndarray, meta: dict, visual: bytes = b"", segment: int = 60_000) -> bytes:
    """A radiometric JPEG whose numbered segments hold raw values, camera parameters and a visual picture; no image data."""
    record = bytearray(0x320)
    for name, at in flir._FLOATS.items():
        value = meta.get(name, 0.0)
        struct.pack_into("<f", record, at, value + 273.15 if name == "refl_temp" else value)
    struct.pack_into("<i", record, 0x308, int(meta.get("o", 0)))
    for name, (at, size) in flir._TEXTS.items():
        record[at : at + size] = meta.get(name, "").encode("latin-1")[: size - 1].ljust(size, b"\0")
    pip = struct.pack("<fhh", meta.get("real2ir", 1.0), int(meta.get("offset_x", 0)), int(meta.get("offset_y", 0)))
    parts = [(flir.RAW, b"\0" * 32 + png16(raw)), (flir.CAMERA, bytes(record)), (flir.PIP, pip), (flir.EMBEDDED, visual)]
    table, body = b"", b""
    first = 0x40 + 32 * len(parts)
    for kind, data in parts:
        table += struct.pack(">H10xII12x", kind, first + len(body), len(data))
        body += data
    whole = (b"FFF\0".ljust(0x18, b"\0") + struct.pack(">II", 0x40, len(parts))).ljust(0x40, b"\0") + table + body
    pieces = [whole[k : k + segment] for k in range(0, len(whole), segment)]
    segments = b"".join(b"\xff\xe1" + struct.pack(">H", len(p) + 10) + b"FLIR\0\x01" + bytes([k, len(pieces) - 1]) + p for k, p in enumerate(pieces))
    return b"\xff\xd8" + segments + b"\xff\xda"


def tiff16(raw: np.ndarray) -> bytes:
    """A grey 16-bit TIFF of one deflated strip."""
    height, width = raw.shape
    strip = zlib.compress(raw.astype("<u2").tobytes())
    tags = ((256, 3, width), (257, 3, height), (258, 3, 16), (259, 3, 8), (262, 3, 1), (273, 4, 8), (277, 3, 1), (278, 3, height), (279, 4, len(strip)))
    entries = b"".join(struct.pack("<HHII" if kind == 4 else "<HHIHxx", tag, kind, 1, value) for tag, kind, value in tags)
    return b"II*\0" + struct.pack("<I", 8 + len(strip)) + strip + struct.pack("<H", len(tags)) + entries + b"\0" * 4
