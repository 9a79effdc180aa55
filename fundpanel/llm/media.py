"""Media columns: Netpbm and BMP images held as binary values.

decode() gives (height, width, 3) uint8 arrays; area_resize() averages exact areas through an
integral image; tiles are written as NPY bytes; difference_hash() compares neighbours in a
9 x 8 grey reduction.  Everything works on Arrow batches, image by image; an image must fit
a worker's memory, a table of images need not.
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

from .sparkops import materialize, own_columns

#: Bytes in a row of a payload image: 64 pixels of three samples.
ROW = 192
TILE = 16


def encode_ppm(image: np.ndarray) -> bytes:
    """Binary PPM (P6) of an (h, w, 3) uint8 array."""
    return b"P6\n%d %d\n255\n" % (image.shape[1], image.shape[0]) + image.tobytes()


def encode_bmp(image: np.ndarray) -> bytes:
    """Uncompressed 24-bit BMP of an (h, w, 3) uint8 array: rows from the bottom, blue first, each padded to 4 bytes."""
    h, w, _ = image.shape
    rows = image[::-1, :, ::-1].reshape(h, w * 3)
    body = np.pad(rows, ((0, 0), (0, -w * 3 % 4))).tobytes()
    return struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 2835, 2835, 0, 0) + body


_TOKEN = re.compile(rb"(?:\s|#[^\n]*\n)*([^\s#]+)")


def _netpbm(raw: bytes) -> np.ndarray:
    kind, at, fields = raw[1] - 48, 2, []
    for _ in range(2 if kind in (1, 4) else 3):
        m = _TOKEN.match(raw, at)
        fields.append(int(m[1]))
        at = m.end()
    w, h, top = (*fields, 1)[:3]
    if not 0 < top < 65536:
        raise ValueError("bad largest value")
    depth = 3 if kind in (3, 6) else 1
    if kind == 4:
        line = -(-w // 8)
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, h * line, at + 1).reshape(h, line), axis=1)[:, :w]
        samples = 1 - bits
    elif kind in (5, 6):
        samples = np.frombuffer(raw, np.uint8 if top < 256 else ">u2", h * w * depth, at + 1)
    else:
        text = re.sub(rb"#[^\n]*", b"", raw[at:])
        samples = 1 - np.array([c - 48 for c in text if c in b"01"][: h * w]) if kind == 1 else np.array(text.split()[: h * w * depth], dtype=np.int64)
    if samples.size != h * w * depth:
        raise ValueError("too few samples")
    if top != 255:
        samples = (samples.astype(np.int64) * 255 + top // 2) // top
    out = samples.astype(np.uint8).reshape(h, w, depth)
    return out if depth == 3 else np.repeat(out, 3, axis=2)


def _bmp(raw: bytes) -> np.ndarray:
    start, size, w, h, _, bits, packed = struct.unpack_from("<IIiiHHI", raw, 10)
    if packed not in (0, 3) or bits not in (8, 24, 32) or w <= 0 or not h:
        raise ValueError("an unsupported BMP")
    rows, line = abs(h), -(-w * bits // 32) * 4
    body = np.frombuffer(raw, np.uint8, rows * line, start).reshape(rows, line)
    if bits == 8:
        colours = np.frombuffer(raw, np.uint8, offset=14 + size, count=min(1024, start - 14 - size) // 4 * 4).reshape(-1, 4)
        out = colours[body[:, :w]][:, :, 2::-1]
    else:
        out = body[:, : w * bits // 8].reshape(rows, w, bits // 8)[:, :, 2::-1]
    return out if h < 0 else out[::-1]


def decode(raw: bytes) -> np.ndarray:
    """An image file as an (h, w, 3) uint8 array; raises ValueError for anything else."""
    try:
        if raw[:1] == b"P" and raw[1:2] in b"123456" and len(raw) > 2:
            return _netpbm(raw)
        if raw[:2] == b"BM":
            return _bmp(raw)
    except (struct.error, TypeError, IndexError) as e:
        raise ValueError("a broken image") from e
    raise ValueError("neither Netpbm nor BMP")


def area_resize(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """Means over an h x w grid of equal areas, also fractional ones, from the integral image (float64)."""
    total = np.zeros((image.shape[0] + 1, image.shape[1] + 1, image.shape[2]))
    np.cumsum(np.cumsum(image, axis=0, dtype=np.float64), axis=1, out=total[1:, 1:])

    def at(n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        edge = np.arange(n + 1) * (size / n)
        low = np.minimum(edge.astype(np.int64), size - 1)
        return low, edge - low

    y, fy = at(h, image.shape[0])
    x, fx = at(w, image.shape[1])
    rows = total[y] * (1 - fy)[:, None, None] + total[y + 1] * fy[:, None, None]
    grid = rows[:, x] * (1 - fx)[None, :, None] + rows[:, x + 1] * fx[None, :, None]
    area = (image.shape[0] / h) * (image.shape[1] / w)
    return (grid[1:, 1:] - grid[:-1, 1:] - grid[1:, :-1] + grid[:-1, :-1]) / area


def npy_tile(image: np.ndarray, side: int = TILE) -> bytes:
    """The image area-resized to side x side, as the bytes of an NPY file."""
    out = io.BytesIO()
    np.lib.format.write_array(out, np.clip(np.rint(area_resize(image, side, side)), 0, 255).astype(np.uint8), version=(1, 0))
    return out.getvalue()


def difference_hash(image: np.ndarray) -> str:
    """64 bits, as hexadecimal: is a cell of the 8 x 9 grey reduction brighter than the next of its row?"""
    grey = np.rint(area_resize(image, 8, 9) @ np.array([299.0, 587.0, 114.0]))
    return np.packbits(grey[:, :-1] > grey[:, 1:]).tobytes().hex()


def image_features(images: DataFrame, id_col: str = "id", media_col: str = "media") -> DataFrame:
    """(id, height, width, dhash, tile, error) for a column of image bytes.

    A null, empty or unreadable value has nulls and its reason in error; repeated rows and null ids stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for raw in batch.column(1):
                try:
                    image = decode(raw.as_py() or b"")
                    out.append((*image.shape[:2], difference_hash(image), npy_tile(image), None))
                except ValueError as e:
                    out.append((None, None, None, None, str(e)))
            cols = zip(*out, strict=True) if out else [()] * 5
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["id", "height", "width", "dhash", "tile", "error"])

    kind = images.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    return own_columns(images, id=id_col, media=media_col).mapInArrow(run, f"id {kind}, height int, width int, dhash string, tile binary, error string")


def payload_image(payload: bytes) -> bytes:
    """Bytes, a multiple of ROW long, as the samples of an image 64 pixels wide: PPM or BMP, by the payload's checksum."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, ROW // 3, 3)
    return encode_bmp(image) if zlib.crc32(payload) & 1 else encode_ppm(image)


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each text's UTF-8, padded with spaces to a positive multiple of ROW, as an image."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sizes, media = [], []
                for text in part.column(1):
                    raw = (text.as_py() or "").encode()
                    sizes.append(len(raw))
                    media.append(payload_image(raw.ljust(max(ROW, -(-len(raw) // ROW) * ROW))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    docs = own_columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, "doc_id long, n_bytes long, media binary")


_DIGESTS = {
    "doc_id": pa.int64(), "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(),
    "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(),
}


def texts_as_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores every text as an image in a table of the shared folder, reads it again and digests what it read.

    Returns one row per input row: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32 (of the payload's
    last 16 bytes), media_bytes, media_sha256, feature (difference hash and digest of the NPY tile).
    A null or empty text is one row of spaces; equal texts have equal values; repeated rows and null ids
    stay; an empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, n, media in zip(*(batch.column(i) for i in range(3)), strict=True):
                raw = media.as_py()
                image = decode(raw)
                payload = image.tobytes()
                feature = f"{difference_hash(image)}:{hashlib.sha256(npy_tile(image)).hexdigest()[:32]}"
                out.append((doc_id.as_py(), n.as_py(), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(raw), hashlib.sha256(raw).hexdigest(), feature))
            cols = zip(*out, strict=True) if out else [()] * len(_DIGESTS)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _DIGESTS.values(), strict=True)], list(_DIGESTS))

    stored = materialize(store_texts(docs, id_col, text_col), "media")
    return stored.mapInArrow(run, ", ".join(f"{c} {'long' if k == pa.int64() else 'string'}" for c, k in _DIGESTS.items()))
