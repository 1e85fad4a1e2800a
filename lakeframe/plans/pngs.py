"""PNG files for the image queries and tests: fixture code, not part of the library's operators."""

from __future__ import annotations

import struct
import zlib

import numpy as np

PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(tag: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)


def encode_png(pixels: np.ndarray) -> bytes:
    """8-bit PNG from an ``(h, w)`` gray or ``(h, w, 3)`` RGB uint8 array."""
    px = np.ascontiguousarray(pixels, dtype=np.uint8)
    h, w = px.shape[:2]
    color = 0 if px.ndim == 2 else 2
    rows = px.reshape(h, -1)
    raw = b"".join(b"\x00" + rows[r].tobytes() for r in range(h))
    header = struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0)
    return PNG_SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(raw)) + _chunk(b"IEND", b"")
