"""Fixture stamps: the stand-in alerts' images as gzip-compressed single-HDU FITS bytes."""

from __future__ import annotations

import functools
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLOCK, _CARD = 2880, 80
_STORED = 65_535  # most bytes of a stored deflate block
_NAN = struct.pack(">f", np.nan)


def _deflated(data: bytes, end: int) -> bytes:
    press = zlib.compressobj(1, zlib.DEFLATED, -15)
    return press.compress(data) + press.flush(end)


@functools.lru_cache(maxsize=64)
def _frame(h: int, w: int) -> tuple[bytes, int, bytes, bytes, int]:
    """What all stamps of a shape share: packed header and its checksum, padding plain and packed, size."""
    cards = ["SIMPLE  =                    T", "BITPIX  =                  -32", "NAXIS   =                    2",
             f"NAXIS1  = {w:20d}", f"NAXIS2  = {h:20d}", "END"]
    head = "".join(c.ljust(_CARD) for c in cards).encode("ascii")
    head += b" " * (-len(head) % _BLOCK)
    pad = b"\0" * (-(h * w * 4) % _BLOCK)
    magic = b"\x1f\x8b\x08\0\0\0\0\0\x04\xff"
    return magic + _deflated(head, zlib.Z_FULL_FLUSH), zlib.crc32(head), pad, _deflated(pad, zlib.Z_FINISH), len(head) + h * w * 4 + len(pad)


def encode_stamp(pixels: np.ndarray) -> bytes:
    """float32 image -> gzip-compressed single-HDU FITS."""
    img = np.asarray(pixels, dtype=np.float32)
    return _framed(img.astype(">f4").tobytes(), *img.shape)


def _framed(body: bytes, h: int, w: int) -> bytes:
    """Stamp of big-endian pixels: they hardly shrink and lie in stored blocks, between header and padding packed once a shape."""
    head, crc, pad, tail, size = _frame(h, w)
    parts = [body[a:a + _STORED] for a in range(0, len(body), _STORED)]
    stored = [x for p in parts for x in (struct.pack("<BHH", 0, len(p), len(p) ^ 0xFFFF), p)]
    return b"".join([head, *stored, tail, struct.pack("<II", zlib.crc32(pad, zlib.crc32(body, crc)), size)])


@F.arrow_udf(T.BinaryType())
def stamp_bytes(arr: pa.Array, kind: pa.Array, factor: pa.Array, shift: pa.Array) -> pa.Array:
    """8x8 float image times ``factor`` plus ``shift`` (float32), or a defect (``broken``, ``short``, ``nan``), as stamp bytes."""
    at, values = arr.offsets.to_pylist(), arr.values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
    each = np.diff(at)
    scaled = values[at[0]:at[-1]] * np.repeat(factor.to_numpy(zero_copy_only=False), each) + np.repeat(shift.to_numpy(zero_copy_only=False), each)
    body = scaled.astype(">f4").tobytes()
    out = []
    for i, (k, n) in enumerate(zip(kind.to_pylist(), each.tolist())):
        start = 4 * (at[i] - at[0])
        if k == "broken":
            out.append(b"\x1f\x8bnot-a-gzip")
        elif k == "short" and n >= 56:
            out.append(_framed(body[start:start + 4 * 56], 7, 8))
        elif n != 64:
            raise ValueError(f"an image of {n} pixels")
        elif k == "nan":
            out.append(_framed(body[start:start + 4 * 27] + _NAN + body[start + 4 * 28:start + 256], 8, 8))
        else:
            out.append(_framed(body[start:start + 256], 8, 8))
    return pa.array(out, pa.binary())
