"""Media columns: Netpbm and BMP images to numpy arrays, area-resized by integral images, stored as NPY tiles.

Each tile also carries the difference hash of its image: 64 bits, whether each of 8 x 8 cells of the grey
image reduced to 8 rows of 9 is brighter than its right neighbour.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import col, map_rows, read

_NUMBER = re.compile(rb"(?:\s|#[^\n]*\n)*(\d+)")


def decode(data: bytes) -> tuple[str, np.ndarray]:
    """Format and samples (rows, columns, channels) of a Netpbm (P1 to P6) or an uncompressed BMP (8, 24, 32 bits)."""
    if data[:2] == b"BM":
        return "bmp", _bmp(data)
    if re.match(rb"P[1-6]", data):
        return f"P{data[1:2].decode()}", _netpbm(data)
    raise ValueError("neither Netpbm nor BMP")


def _netpbm(data: bytes) -> np.ndarray:
    kind, at, head = int(data[1:2]), 2, []
    for _ in range(2 if kind in (1, 4) else 3):
        m = _NUMBER.match(data, at)
        if not m:
            raise ValueError("header cut short")
        head.append(int(m[1]))
        at = m.end()
    width, height, most = (*head, 1)[:3]
    channels = 3 if kind in (3, 6) else 1
    n = width * height * channels
    if not n or not 0 < most < 65536:
        raise ValueError("no samples or maximum out of range")
    kind_of = np.uint8 if most < 256 else np.dtype(">u2")
    if kind == 1:
        bits = re.findall(rb"[01]", re.sub(rb"#[^\n]*", b"", data[at:]))[:n]
        flat = np.array([1 - int(b) for b in bits], dtype=np.uint8)
    elif kind in (2, 3):
        flat = np.array(re.sub(rb"#[^\n]*", b"", data[at:]).split()[:n], dtype=np.int64)
    elif kind == 4:
        row = -(-width // 8)
        packed = np.frombuffer(data, np.uint8, count=min(row * height, len(data) - at - 1), offset=at + 1)
        if len(packed) < row * height:
            raise ValueError("samples cut short")
        flat = 1 - np.unpackbits(packed.reshape(height, row), axis=1)[:, :width].ravel()
    else:
        size = np.dtype(kind_of).itemsize
        if len(data) - at - 1 < n * size:
            raise ValueError("samples cut short")
        flat = np.frombuffer(data, kind_of, count=n, offset=at + 1)
    if len(flat) < n:
        raise ValueError("samples cut short")
    if flat.min() < 0 or flat.max() > most:
        raise ValueError("sample out of range")
    return flat.astype(np.uint8 if most < 256 else np.uint16).reshape(height, width, channels)


def _bmp(data: bytes) -> np.ndarray:
    if len(data) < 54:
        raise ValueError("header cut short")
    start, head, width, height, _, bits, packing, _, _, _, used = struct.unpack_from("<IIiiHHIIiiI", data, 10)
    if packing or bits not in (8, 24, 32) or width <= 0 or not height:
        raise ValueError("compressed BMP or unknown depth")
    row = (width * bits // 8 + 3) // 4 * 4
    if len(data) < start + row * abs(height):
        raise ValueError("samples cut short")
    rows = np.frombuffer(data, np.uint8, count=row * abs(height), offset=start).reshape(abs(height), row)[:, : width * bits // 8]
    if bits == 8:
        palette = np.frombuffer(data, np.uint8, count=4 * (used or 256), offset=14 + head).reshape(-1, 4)[:, 2::-1]
        out = palette[rows]
    else:
        out = rows.reshape(abs(height), width, bits // 8)[:, :, 2::-1]
    return np.ascontiguousarray(out[::-1] if height > 0 else out)


def encode_bmp(samples: np.ndarray) -> bytes:
    """A 24-bit BMP of (rows, columns, 3) samples."""
    height, width, _ = samples.shape
    row = (width * 3 + 3) // 4 * 4
    body = np.zeros((height, row), np.uint8)
    body[:, : width * 3] = samples[::-1, :, ::-1].reshape(height, -1)
    return struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 54 + body.size, 0, 0, 54, 40, width, height, 1, 24, 0, body.size, 2835, 2835, 0, 0) + body.tobytes()


def _shrink(samples: np.ndarray, n: int, axis: int) -> np.ndarray:
    """Area means along an axis: differences of its running sums at n + 1 even places, between entries by proportion."""
    size = samples.shape[axis]
    sums = np.cumsum(samples, axis=axis, dtype=np.float64)
    sums = np.concatenate([np.zeros_like(np.take(sums, [0], axis=axis)), sums], axis=axis)
    at = np.arange(n + 1) * size / n
    low = np.minimum(at.astype(np.int64), size)
    part = (at - low).reshape([-1 if i == axis else 1 for i in range(samples.ndim)])
    here = np.take(sums, low, axis=axis)
    edge = here + part * (np.take(sums, np.minimum(low + 1, size), axis=axis) - here)
    return np.diff(edge, axis=axis) * n / size


def area_resize(samples: np.ndarray, height: int, width: int, band: int = 1 << 15) -> np.ndarray:
    """Area means as float64; the integral image is built for `band` rows at a time, first across, then down."""
    across = np.concatenate([_shrink(samples[i : i + band], width, 1) for i in range(0, samples.shape[0], band)])
    return _shrink(across, height, 0)


def difference_hash(samples: np.ndarray) -> str:
    """16 hex digits; channels are averaged."""
    small = area_resize(samples, 8, 9).mean(axis=2)
    return f"{int(''.join('1' if b else '0' for b in (small[:, :-1] > small[:, 1:] + 1e-9).ravel()), 2):016x}"


def to_npy(samples: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(samples), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def from_npy(data: bytes) -> np.ndarray:
    return np.lib.format.read_array(io.BytesIO(data), allow_pickle=False)


def media_tiles(df: DataFrame, id_col: str, media_col: str, size: tuple[int, int] | None = None, tile: tuple[int, int] | None = None, keep: dict[str, Column] | None = None) -> DataFrame:
    """A row (id, keep..., format, height, width, channels, tile_row, tile_col, npy, dhash, error) for each tile.

    size: rows and columns to resize to (none: lossless). tile: largest rows and columns of a tile (none: one
    tile). Null, empty and malformed media give one row that has only id, keep and error. keep: long columns to
    carry along. Repeated rows stay repeated; equal media give equal tiles.
    """
    keep = keep or {}

    def rows(incoming):
        for key, *kept, data in incoming:
            try:
                kind, samples = decode(data or b"")
                if size:
                    samples = np.rint(area_resize(samples, *size)).astype(samples.dtype)
                mark = difference_hash(samples)
            except (ValueError, struct.error, IndexError, OverflowError) as e:
                yield key, *kept, None, None, None, None, None, None, None, None, str(e)
                continue
            height, width, channels = samples.shape
            th, tw = tile or (height, width)
            for y in range(0, height, th):
                for x in range(0, width, tw):
                    part = samples[y : y + th, x : x + tw]
                    yield key, *kept, kind, height, width, channels, y // th, x // tw, to_npy(part), mark, None

    fields = [("id", "long"), *((k, "long") for k in keep), ("format", "string"), ("height", "long"), ("width", "long"), ("channels", "int"), ("tile_row", "int"), ("tile_col", "int"), ("npy", "binary"), ("dhash", "string"), ("error", "string")]
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
    return map_rows(df.select(col(id_col).cast("long"), *(c.alias(k) for k, c in keep.items()), col(media_col).cast("binary").alias("_media")), rows, pa.schema([(n, kinds[k]) for n, k in fields]), ", ".join(f"{n} {k}" for n, k in fields))


def text_as_graymap(text: Column) -> Column:
    """UTF-8 bytes, padded with 0 to a positive multiple of 64, as a binary Netpbm graymap 64 columns wide."""
    data = F.coalesce(text.cast("string"), F.lit("")).cast("binary")
    rows = F.greatest(F.ceil(F.octet_length(data) / 64), F.lit(1)).cast("int")
    head = F.concat(F.lit("P5\n64 "), rows.cast("string"), F.lit("\n255\n")).cast("binary")
    return F.concat(head, F.rpad(data, rows * 64, F.lit(bytes(1))))


def op6_media_columns(spark, sf_dir: str) -> DataFrame:
    """Each text as a graymap, stored by media_tiles as one lossless NPY tile; the digests are of what is read back."""
    docs = read(spark, sf_dir, "documents")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    tiles = media_tiles(docs.withColumn("_media", text_as_graymap(F.col("text"))), "doc_id", "_media", keep={"n_bytes": n_bytes})

    def rows(incoming):
        for key, n, stored, mark in incoming:
            payload = from_npy(stored).tobytes()
            yield key, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), mark

    ddl = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (x.split() for x in ddl.split(", "))])
    return map_rows(tiles.select("id", "n_bytes", "npy", "dhash"), rows, schema, ddl)
