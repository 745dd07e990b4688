"""Media columns: Netpbm and BMP images, area-resized thumbnails as NPY tiles, difference hashes.

encode_images stores a payload losslessly as the 8-bit samples of a small image: P5
(grey), P6 (colour) or BMP (24 bits), chosen by the payload itself. decode_image reads
any binary P5, P6 or uncompressed 24-bit or 8-bit grey BMP into a numpy array. Thumbnails
are exact area averages from integral images; a difference hash has one bit for each pair
of neighbours of a 9 x 8 thumbnail.

Defined cases: null and empty payloads are one padded unit; equal payloads give equal
bytes; bytes that are no such image give a null array, tile and hash; repeated rows are
encoded alike; very long payloads are one tall image; an empty table gives no rows. Other
columns stay, but for those named like an output, which the output replaces.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import others

#: Payloads are padded with 255 to a multiple of this: 24 rows of 24 bytes.
UNIT = 576
ROW = 24


def pad(payload: bytes) -> bytes:
    return payload + b"\xff" * (-len(payload) % UNIT if payload else UNIT)


def encode_image(payload: bytes) -> bytes:
    """A Netpbm or BMP file whose samples are the padded payload; it also notes the unpadded length."""
    padded = pad(payload)
    rows, kind = len(padded) // ROW, zlib.crc32(padded) % 3
    if kind == 0:
        return b"P5\n# %d\n%d %d\n255\n" % (len(payload), ROW, rows) + padded
    if kind == 1:
        return b"P6\n# %d\n%d %d\n255\n" % (len(payload), ROW // 3, rows) + padded
    # a negative height means rows from top to bottom; rows of 24 bytes need no filling
    return b"BM" + struct.pack("<IIIIiiHHIIiiII", 54 + len(padded), len(payload), 54, 40, ROW // 3, -rows, 1, 24, 0, len(padded), 2835, 2835, 0, 0) + padded


_NETPBM = re.compile(rb"P([56])\s(?:\s*#[^\n]*\n)*\s*(\d+)\s+(\d+)\s+(\d+)\s")
_NOTE = re.compile(rb"P[56]\s#\s(\d+)\n")


def decode_image(data: bytes) -> tuple[np.ndarray, int] | None:
    """Samples as (height, width, channels) in file order, and the length that the file notes (-1: none)."""
    if m := _NETPBM.match(data):
        channels, width, height, top = (3 if m[1] == b"6" else 1), int(m[2]), int(m[3]), int(m[4])
        size = width * height * channels
        if top > 255 or len(data) - m.end() < size:
            return None
        note = _NOTE.match(data)
        return np.frombuffer(data, np.uint8, size, m.end()).reshape(height, width, channels), int(note[1]) if note else -1
    if data[:2] == b"BM" and len(data) >= 54:
        note, at, _, width, height, _, bits, packed = struct.unpack_from("<IIIiiHHI", data, 6)
        channels = {24: 3, 8: 1}.get(bits)
        if channels is None or packed or width <= 0:
            return None
        stride = (width * channels + 3) // 4 * 4
        if len(data) < at + stride * abs(height):
            return None
        rows = np.frombuffer(data, np.uint8, stride * abs(height), at).reshape(abs(height), stride)[:, : width * channels]
        return (rows if height < 0 else rows[::-1]).reshape(abs(height), width, channels), note
    return None


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the area under each output sample, edges counted in part, from an integral image."""
    h, w = image.shape[:2]
    table = np.zeros((h + 1, w + 1, image.shape[2]))
    np.cumsum(np.cumsum(image, 0, dtype=np.float64), 1, out=table[1:, 1:])

    def at(axis: int, size: int, n: int, t: np.ndarray) -> np.ndarray:
        places = np.arange(n + 1) * (size / n)
        low = np.minimum(places.astype(np.int64), size - 1)
        part = (places - low).reshape([-1 if k == axis else 1 for k in range(3)])
        return np.take(t, low, axis) * (1 - part) + np.take(t, low + 1, axis) * part

    sums = at(1, w, width, at(0, h, height, table))
    return (sums[1:, 1:] - sums[:-1, 1:] - sums[1:, :-1] + sums[:-1, :-1]) / ((h / height) * (w / width))


def difference_hash(image: np.ndarray) -> str:
    small = area_resize(image.mean(2, keepdims=True), 8, 9)[:, :, 0]
    return np.packbits(small[:, 1:] > small[:, :-1] + 1e-9).tobytes().hex()


def tile(image: np.ndarray, side: int) -> bytes:
    """An NPY file with the side x side thumbnail as 8-bit samples."""
    out = io.BytesIO()
    np.save(out, np.floor(area_resize(image, side, side) + 0.5).clip(0, 255).astype(np.uint8))
    return out.getvalue()


def encode_images(df: DataFrame, payload: str, out: str = "media") -> DataFrame:
    """Replace the column payload (text or binary) by the stored images."""
    names = others(df, payload, out)
    df = df.select(*names, F.col(payload).cast("binary").alias("_payload"))
    schema = df.select(*names, F.col("_payload").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stored = [encode_image(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(stored, pa.binary())], names=[*names, out])

    return df.mapInArrow(tx.giving_back(run), schema)


def describe_images(df: DataFrame, media: str = "media", side: int = 16, tiles: bool = True) -> DataFrame:
    """Read the stored bytes back and add note (the length the file notes), payload_bytes, payload_sha256,
    tail_crc32, media_bytes, media_sha256, dhash, and tile (NPY bytes) if asked for."""
    added = "note long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, dhash string, tile binary"
    of = [c.split()[0] for c in added.split(", ")]
    df = df.select(*others(df, media, *of), F.col(media).alias(media))
    names, at = df.columns, len(df.columns) - 1
    schema = df.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in added.split(", ")]).schema

    def one(data: bytes | None) -> tuple:
        if data is None or (got := decode_image(data)) is None:
            return (None,) * 8
        image, note = got
        payload = image.tobytes()
        return (note, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), difference_hash(image) if image.size else None, tile(image, side) if tiles and image.size else None)

    types = [schema[c.split()[0]].dataType.simpleString() for c in added.split(", ")]
    arrow = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(x.as_py()) for x in batch.column(at)]
            columns = zip(*rows, strict=True) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(list(c), arrow[t]) for c, t in zip(columns, types, strict=True)]], names=[*names, *[c.split()[0] for c in added.split(", ")]])

    return df.mapInArrow(tx.giving_back(run), schema)
