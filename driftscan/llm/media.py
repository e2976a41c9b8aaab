"""Media columns: Netpbm and BMP decoding, integral-image resizing, NPY tiles and difference hashes.

`media_features` maps a binary column of image files to one row each: the
decoded geometry, an area-resized thumbnail as an NPY file, the difference hash
of that thumbnail, and NPY tiles. Undecodable, empty or null files give a row
with `error` set and nulls elsewhere; the job never fails on a file.
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

_PNM_HEAD = re.compile(rb"P([1-6])(?:\s|#[^\r\n]*[\r\n])+")
_PNM_NUMBER = re.compile(rb"(?:\s|#[^\r\n]*[\r\n])*(\d+)")


def decode_netpbm(data: bytes) -> np.ndarray:
    """PBM, PGM and PPM, plain or raw, to an H x W x C array of uint8 or uint16 (bitmaps: 0 black, 255 white)."""
    head = _PNM_HEAD.match(data)
    if not head:
        raise ValueError("not a Netpbm file")
    kind, at, sizes = int(head[1]), head.end(), []
    for _ in range(2 if kind in (1, 4) else 3):
        m = _PNM_NUMBER.match(data, at)
        if not m:
            raise ValueError("Netpbm header ends early")
        sizes.append(int(m[1]))
        at = m.end()
    width, height, top = sizes[0], sizes[1], sizes[2] if len(sizes) > 2 else 1
    if not (width and height and 0 < top < 65536):
        raise ValueError("Netpbm header has an impossible size")
    channels = 3 if kind in (3, 6) else 1
    n, left = width * height * channels, len(data) - at - 1
    least = {1: n, 2: 2 * n - 1, 3: 2 * n - 1, 4: (width + 7) // 8 * height}.get(kind, n * (1 if top < 256 else 2))
    if least > left + (kind < 4):  # told by the length, before anything of that size is made
        raise ValueError("Netpbm samples end early")
    if kind == 1:
        a = np.frombuffer(re.sub(rb"#[^\r\n]*|\s", b"", data[at:])[:n], np.uint8) - np.uint8(48)
    elif kind in (2, 3):
        a = np.array([int(x) for x in re.sub(rb"#[^\r\n]*", b"", data[at:]).split()[:n]], np.int64)
    elif kind == 4:
        row = (width + 7) // 8
        raw = np.frombuffer(data, np.uint8, row * height, at + 1).reshape(height, row)
        a = np.unpackbits(raw, axis=1)[:, :width].ravel()
    else:
        a = np.frombuffer(data, np.uint8 if top < 256 else ">u2", n, at + 1)
    if a.size != n:
        raise ValueError("Netpbm samples end early")
    if a.min() < 0 or a.max() > top:
        raise ValueError("Netpbm sample out of range")
    if kind in (1, 4):
        a = (1 - a) * np.uint8(255)
    out = np.uint8 if top < 256 else np.uint16
    return a.astype(out).reshape(height, width, channels)


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 24 or 32 bits a pixel to an H x W x 3 array of uint8 in RGB order."""
    if data[:2] != b"BM" or len(data) < 54:
        raise ValueError("not a BMP file")
    start, head, width, height, _, bits, packed, _, _, _, used = struct.unpack_from("<I I i i H H I I i i I", data, 10)
    if packed not in (0, 3) or bits not in (1, 4, 8, 24, 32) or width <= 0 or height == 0:
        raise ValueError(f"BMP form not supported: {bits} bits, compression {packed}")
    rows, stride = abs(height), (width * bits + 31) // 32 * 4
    if start + rows * stride > len(data):
        raise ValueError("BMP rows end early")
    raw = np.frombuffer(data, np.uint8, stride * rows, start).reshape(rows, stride)
    if height > 0:
        raw = raw[::-1]
    if bits >= 24:
        step = bits // 8
        return np.ascontiguousarray(raw[:, : width * step].reshape(rows, width, step)[:, :, 2::-1])
    entries = used or 1 << bits
    palette = np.frombuffer(data, np.uint8, entries * 4, 14 + head).reshape(entries, 4)[:, 2::-1]
    if bits == 8:
        index = raw
    elif bits == 4:
        index = np.stack([raw >> 4, raw & 15], axis=2).reshape(rows, -1)
    else:
        index = np.unpackbits(raw, axis=1)
    return palette[index[:, :width]]


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def encode_ppm(a: np.ndarray) -> bytes:
    h, w, c = a.shape
    return b"P%d\n%d %d\n255\n" % (6 if c == 3 else 5, w, h) + a.tobytes()


def encode_bmp(a: np.ndarray) -> bytes:
    """24-bit bottom-up BMP of an H x W x 3 uint8 array."""
    h, w, _ = a.shape
    stride = (w * 3 + 3) // 4 * 4
    body = np.zeros((h, stride), np.uint8)
    body[:, : w * 3] = a[::-1, :, ::-1].reshape(h, w * 3)
    head = struct.pack("<2s I H H I", b"BM", 54 + body.size, 0, 0, 54)
    return head + struct.pack("<I i i H H I I i i I I", 40, w, h, 1, 24, 0, body.size, 2835, 2835, 0, 0) + body.tobytes()


def integral_rows(a: np.ndarray, rows: np.ndarray, block: int = 4096) -> np.ndarray:
    """Rows of the summed-area table of a, each of which sums so many first rows; the table is never held whole."""
    out, total = np.zeros((len(rows), a.shape[1] + 1, a.shape[2])), np.zeros(a.shape[1:])
    for lo in range(0, a.shape[0], block):
        part = np.cumsum(a[lo : lo + block], axis=0, dtype=np.float64) + total
        here = np.flatnonzero((rows > lo) & (rows <= lo + len(part)))
        out[here, 1:] = np.cumsum(part[rows[here] - lo - 1], axis=1)
        total = part[-1]
    return out


def area_resize(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over each target cell's exact area, by a summed-area table read at fractional corners; float64."""
    h, w = a.shape[:2]

    def corners(size: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        edge = np.arange(parts + 1) * (size / parts)
        low = np.minimum(edge.astype(np.int64), size)
        return low, np.minimum(low + 1, size), (edge - low)[:, None, None]

    low, high, part = corners(h, height)
    table = integral_rows(a, low) * (1 - part) + integral_rows(a, high) * part
    low, high, part = corners(w, width)
    part = part.reshape(1, -1, 1)
    table = table[:, low] * (1 - part) + table[:, high] * part
    return np.diff(np.diff(table, axis=0), axis=1) / ((h / height) * (w / width))


def difference_hash(a: np.ndarray, size: int = 8) -> str:
    """Bits tell whether each cell of the size x (size+1) grey thumbnail is darker than its right neighbour; hex."""
    grey = np.round(area_resize(a, size, size + 1).mean(axis=2), 6)
    return np.packbits(grey[:, :-1] < grey[:, 1:]).tobytes().hex()


def npy(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, np.ascontiguousarray(a), allow_pickle=False)
    return out.getvalue()


def tiles(a: np.ndarray, tile: int) -> Iterator[tuple[int, int, bytes]]:
    """NPY tiles in row order; those at the right and lower edge keep their true size."""
    for y in range(0, a.shape[0], tile):
        for x in range(0, a.shape[1], tile):
            yield y // tile, x // tile, npy(a[y : y + tile, x : x + tile])


FEATURE_SCHEMA = "height int, width int, channels int, dtype string, thumbnail binary, dhash string, samples binary, tiles array<struct<ty:int,tx:int,npy:binary>>, error string"


def _describe(data: bytes | None, side: int, tile: int, keep_samples: bool) -> tuple:
    if not data:
        return (*[None] * 8, "empty")
    try:
        a = decode(data)
        thumb = np.clip(np.rint(area_resize(a, side, side)), 0, np.iinfo(a.dtype).max).astype(a.dtype)
        cut = [{"ty": y, "tx": x, "npy": b} for y, x, b in tiles(a, tile)] if tile else None
        return (*a.shape, a.dtype.name, npy(thumb), difference_hash(a), a.tobytes() if keep_samples else None, cut, None)
    except (ValueError, OverflowError, MemoryError, struct.error, IndexError) as e:
        return (*[None] * 8, str(e)[:200] or "undecodable")


_FEATURES = pa.struct(
    [("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("dtype", pa.string()), ("thumbnail", pa.binary()), ("dhash", pa.string()), ("samples", pa.binary())]
    + [("tiles", pa.list_(pa.struct([("ty", pa.int32()), ("tx", pa.int32()), ("npy", pa.binary())]))), ("error", pa.string())]
)


def media_features(df: DataFrame, media: str = "media", side: int = 16, tile: int = 256, keep_samples: bool = False, out: str = "features") -> DataFrame:
    """Adds one struct column `out` (see FEATURE_SCHEMA) computed from the files in column media.

    One row in, one row out, repeated rows too; other columns pass unchanged,
    whatever their names, and one of the name `out` is an error. tile=0 leaves
    the tiles out. Equal files give equal features; null, empty and damaged ones
    a struct that has only `error`.
    """
    if out in df.columns:
        raise ValueError(f"there is a column {out} already")

    def describe(files: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in files:
            rows = [_describe(x.as_py(), side, tile, keep_samples) for x in array]
            yield pa.array([dict(zip((f.name for f in _FEATURES), r, strict=True)) for r in rows], _FEATURES)

    return df.withColumn(out, F.arrow_udf(describe, FEATURE_SCHEMA)(F.col(media)))


def text_to_media(payload: bytes) -> bytes:
    """A payload of a multiple of 192 bytes as a lossless 8-bit RGB file, 64 pixels wide: BMP for an even number of rows, PPM for an odd one."""
    a = np.frombuffer(payload, np.uint8).reshape(-1, 64, 3)
    return encode_ppm(a) if a.shape[0] % 2 else encode_bmp(a)


DIGEST_SCHEMA = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, media_format string, height int, width int, thumbnail_sha256 string, tiles_sha256 string, n_tiles int"


def _digest(text: bytes | None, tile: int) -> tuple:
    text = text or b""
    payload = text + b" " * ((-len(text)) % 192 or (0 if text else 192))
    media = text_to_media(payload)
    a = decode(media)
    back = a.tobytes()
    thumb = np.clip(np.rint(area_resize(a, 16, 16)), 0, 255).astype(np.uint8)
    all_tiles, n = hashlib.sha256(), 0
    for _, _, b in tiles(a, tile):
        all_tiles.update(b)
        n += 1
    return (
        len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(),
        difference_hash(a), "bmp" if media[:2] == b"BM" else "ppm", a.shape[0], a.shape[1], hashlib.sha256(npy(thumb)).hexdigest(), all_tiles.hexdigest(), n,
    )


def text_media_digest(documents: DataFrame, tile: int = 256) -> DataFrame:
    """Every text (null: empty) stored as an image file, read back and described; one row per document (DIGEST_SCHEMA).

    The files live only inside the task: a column of them would double the
    corpus. Null doc_ids stay null; repeated rows give repeated results.
    """
    names = [x.split()[0] for x in DIGEST_SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo in range(0, batch.num_rows, 256):
                rows = [_digest(t.as_py(), tile) for t in texts[lo : lo + 256]]
                if rows:
                    yield pa.RecordBatch.from_arrays([ids[lo : lo + 256], *(pa.array(c, type=_ARROW[k]) for k, c in zip(names[1:], zip(*rows, strict=True), strict=True))], names)

    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(run, DIGEST_SCHEMA)


_ARROW = {k: {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[t] for k, t in (x.split() for x in DIGEST_SCHEMA.split(", "))}
