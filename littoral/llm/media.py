"""Media columns: Netpbm and BMP images decoded to numpy arrays.

Images are area-resized by integral images and cut into NPY tiles with difference hashes.
Texts can be stored as images without loss: bytes become the 8-bit RGB samples of a binary
Netpbm file of width 64, so that a row of the picture holds 192 bytes.

Defined cases: a null or empty text is stored as one row of spaces; null or undecodable media
give a null array, no tiles and a null hash; very long texts give tall pictures, one at a time;
equal bytes give equal results; an empty table gives no rows; input columns that bear the name
of an output column are replaced.
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
from pyspark.sql import DataFrame, SparkSession

from littoral.llm.common import Kept, documents, giving_back, small_batches

WIDTH = 64
UNIT = WIDTH * 3
TILE = 64


def _fields(data: bytes, at: int, wanted: int) -> tuple[list[int], int] | None:
    """The numbers of a Netpbm header and the place after them."""
    out = []
    while len(out) < wanted:
        found = re.compile(rb"(?:\s|#[^\n]*\n)*(\d{1,9})(?!\d)").match(data, at)
        if not found:
            return None
        out.append(int(found[1]))
        at = found.end()
    return out, at


def decode_netpbm(data: bytes) -> np.ndarray | None:
    """PBM, PGM and PPM in text or binary form, as (height, width, channels) of uint8; None for anything else."""
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        return None
    bits = kind in (b"P1", b"P4")
    head = _fields(data, 2, 2 if bits else 3)
    if head is None:
        return None
    (width, height, *rest), at = head
    top, channels = (rest or [1])[0], 3 if kind in (b"P3", b"P6") else 1
    if not width or not height or not 0 < top < 65536:
        return None
    count, samples = width * height * channels, max(0, len(data) - at - 1)
    if kind in (b"P1", b"P2", b"P3"):
        if count > len(data):  # a sample takes a character at least
            return None
        body = re.sub(rb"#[^\n]*", b"", data[at:])
        tokens = [bytes([x]) for x in body.translate(None, b" \t\r\n\v\f")[:count]] if bits else body.split()[:count]
        if not all(x.isdigit() and len(x) < 6 for x in tokens):
            return None
        values = np.array([int(x) for x in tokens], np.int64)
    elif bits:
        stride = (width + 7) // 8
        if samples < stride * height:
            return None
        raw = np.frombuffer(data, np.uint8, offset=at + 1, count=stride * height)
        values = np.unpackbits(raw.reshape(height, stride), axis=1)[:, :width].reshape(-1).astype(np.int64)
    else:
        wide = 1 if top < 256 else 2
        if samples < count * wide:
            return None
        values = np.frombuffer(data, np.uint8 if wide == 1 else ">u2", offset=at + 1, count=count)
    if values.size < count or values.max() > top:
        return None
    if bits:
        values = (1 - values) * 255
    elif top != 255:
        values = values.astype(np.int64) * 255 // top
    return values.astype(np.uint8, copy=False).reshape(height, width, channels)


def decode_bmp(data: bytes) -> np.ndarray | None:
    """Uncompressed BMP of 8 (palette), 24 or 32 bits, as (height, width, 3) of uint8; None for anything else."""
    if data[:2] != b"BM" or len(data) < 54:
        return None
    start, head, width, height, _, bits, packed = struct.unpack_from("<I4xI", data, 10)[:1] + struct.unpack_from("<IiiHHI", data, 14)
    if packed or head < 40 or bits not in (8, 24, 32) or width <= 0 or not height:
        return None
    rows, stride = abs(height), (width * bits // 8 + 3) // 4 * 4
    if start < 14 + head or len(data) - start < rows * stride:
        return None
    raw = np.frombuffer(data, np.uint8, offset=start, count=rows * stride).reshape(rows, stride)[:, : width * bits // 8]
    if bits == 8:
        colours = min(256, (start - 14 - head) // 4)
        if raw.max() >= colours:
            return None
        table = np.frombuffer(data, np.uint8, offset=14 + head, count=colours * 4).reshape(-1, 4)
        picture = table[raw][:, :, 2::-1]
    else:
        picture = raw.reshape(rows, width, bits // 8)[:, :, 2::-1]
    return np.ascontiguousarray(picture[::-1] if height > 0 else picture)


def decode(data: bytes | None) -> np.ndarray | None:
    return None if not data else decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def encode_ppm(payload: bytes, width: int = WIDTH) -> bytes:
    return b"P6\n%d %d\n255\n" % (width, len(payload) // (3 * width)) + payload


def area_resize(grey: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over each target cell, whose edges may cut pixels, from one integral image."""
    whole = np.zeros((grey.shape[0] + 1, grey.shape[1] + 1))
    whole[1:, 1:] = grey.astype(np.float64).cumsum(0).cumsum(1)

    def at_edges(table: np.ndarray, n: int) -> np.ndarray:
        edge = np.arange(n + 1) * (table.shape[0] - 1) / n
        low = np.minimum(edge.astype(np.int64), table.shape[0] - 2)
        part = (edge - low)[:, None]
        return table[low] * (1 - part) + table[low + 1] * part

    cells = np.diff(np.diff(at_edges(at_edges(whole, height).T, width).T, axis=0), axis=1)
    return cells * (height * width) / (grey.shape[0] * grey.shape[1])


def grey_of(picture: np.ndarray) -> np.ndarray:
    return picture[:, :, 0].astype(np.float64) if picture.shape[2] == 1 else picture @ np.array([0.299, 0.587, 0.114])


def difference_hash(picture: np.ndarray) -> str:
    """64 bits: whether each cell of an 8 by 9 thumbnail is darker than its right neighbour."""
    small = area_resize(grey_of(picture), 8, 9).round(6)
    return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()


def npy_bytes(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array, allow_pickle=False)
    return out.getvalue()


def npy_tiles(picture: np.ndarray, side: int = TILE) -> list[tuple[int, int, bytes, str]]:
    """(row, column, NPY bytes, difference hash) of each tile, in row-major order."""
    return [
        (y // side, x // side, npy_bytes(tile := np.ascontiguousarray(picture[y : y + side, x : x + side])), difference_hash(tile))
        for y in range(0, picture.shape[0], side) for x in range(0, picture.shape[1], side)
    ]


def media_tiles(media: DataFrame, column: str = "media", side: int = TILE) -> DataFrame:
    """One row per tile: the other columns of ``media`` and tile_row, tile_col, npy, dhash."""
    small_batches(media.sparkSession)
    kept = Kept(media, column)
    keep = [c for c in kept.inside if c != column]
    schema = ", ".join([f"`{c}` {kept.frame.schema[c].dataType.simpleString()}" for c in keep] + ["tile_row int", "tile_col int", "npy binary", "dhash string"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(len(keep))
            for i in range(batch.num_rows):  # a document's tiles at a time
                picture = decode(blobs[i].as_py())
                if picture is None:
                    continue
                row, col, data, mark = zip(*npy_tiles(picture, side), strict=True)
                index = pa.array(np.full(len(row), i))
                rest = [batch.column(k).take(index) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(row, pa.int32()), pa.array(col, pa.int32()), pa.array(data, pa.binary()), pa.array(mark)], names=[*keep, "tile_row", "tile_col", "npy", "dhash"])

    return kept.back(kept.frame.select(*keep, column).mapInArrow(giving_back(cut), schema), "tile_row", "tile_col", "npy", "dhash", without=(column,))


def store_texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, media): each text as a binary Netpbm file, padded with spaces."""
    small_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # a bounded number of files at once
                part = batch.slice(at, 64)
                raw = [(x or "").encode() for x in part.column(1).to_pylist()]
                files = [encode_ppm(x + b" " * (-len(x) % UNIT or (UNIT if not x else 0))) for x in raw]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(files, pa.binary())], names=[key, "n_bytes", "media"])

    return docs.select(key, text).mapInArrow(giving_back(encode), f"`{key}` {docs.schema[key].dataType.simpleString()}, n_bytes long, media binary")


_FEATURES = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def read_back(stored: DataFrame, key: str = "doc_id") -> DataFrame:
    """Decode the stored pictures and describe the samples read: digests, and a feature of the size, the difference
    hash and the first 16 digits of a digest over all NPY tiles and their difference hashes. All null but the media's own
    size and digest where media do not decode."""
    small_batches(stored.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for size, blob in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = blob.as_py()
                picture = decode(data)
                if picture is None:
                    rows.append((size, *[None] * 3, None if data is None else len(data), None if data is None else hashlib.sha256(data).hexdigest(), None))
                    continue
                payload = picture.tobytes()
                tiles = hashlib.sha256()
                for y, x, tile, mark in npy_tiles(picture):
                    tiles.update(b"%d,%d," % (y, x) + tile + mark.encode())
                feature = f"{picture.shape[1]}x{picture.shape[0]}:{difference_hash(picture)}:{tiles.hexdigest()[:16]}"
                rows.append((size, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature))
            if rows:
                names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=[key, *names])

    return stored.select(key, "n_bytes", "media").mapInArrow(giving_back(describe), f"`{key}` {stored.schema[key].dataType.simpleString()}, {_FEATURES}")


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(store_texts(documents(spark, sf_dir)))
