"""Decoders for baseline TIFF (uncompressed, PackBits, Deflate), PNG and BMP, and EXIF positions, without an imaging library."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}


class Unsupported(ValueError):
    """A valid file of a form that is not decoded."""


def tiff_tags(data: bytes, at: int | None = None) -> dict[int, tuple]:
    """Tags of an image file directory, the first by default: number to values."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at = struct.unpack_from(order + "I", data, 4)[0] if at is None else at
    tags = {}
    for k in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
        size = _SIZES.get(kind, 1) * n
        place = at + 10 + 12 * k if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * k)[0]
        if kind == 2:
            tags[tag] = (data[place : place + n].rstrip(b"\0").decode("latin-1"),)
        elif kind in (5, 10):
            v = struct.unpack_from(order + ("I" if kind == 5 else "i") * 1 + ("I" if kind == 5 else "i") * (2 * n - 1), data, place)
            tags[tag] = tuple(a / b if b else 0.0 for a, b in zip(v[::2], v[1::2], strict=True))
        else:
            tags[tag] = struct.unpack_from(order + {1: "B", 3: "H", 4: "I", 6: "b", 7: "B", 8: "h", 9: "i", 11: "f", 12: "d"}.get(kind, "B") * n, data, place)
    return tags


def _unpack_bits(data: bytes) -> bytes:
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += 2 + n
        elif n > 128:
            out += data[at + 1 : at + 2] * (257 - n)
            at += 2
        else:
            at += 1
    return bytes(out)


def decode_tiff(data: bytes) -> np.ndarray:
    t = tiff_tags(data)
    order = "<" if data[:2] == b"II" else ">"
    width, height, bits, packed, channels = t[256][0], t[257][0], t.get(258, (1,))[0], t.get(259, (1,))[0], t.get(277, (1,))[0]
    if 322 in t or bits not in (8, 16, 32) or t.get(284, (1,))[0] != 1 or t.get(317, (1,))[0] not in (1, 2):
        raise Unsupported("TIFF layout")
    unpack = {1: bytes, 32773: _unpack_bits, 8: zlib.decompress, 32946: zlib.decompress}.get(packed)
    if unpack is None:
        raise Unsupported(f"TIFF compression {packed}")
    raw = b"".join(unpack(data[a : a + n]) for a, n in zip(t[273], t[279], strict=True))
    kind = {1: "u", 2: "i", 3: "f"}[t.get(339, (1,))[0]]
    a = np.frombuffer(raw, np.dtype(f"{order}{kind}{bits // 8}"), height * width * channels).reshape(height, width, channels)
    if t.get(317, (1,))[0] == 2:
        a = np.cumsum(a, axis=1, dtype=a.dtype)
    if t.get(262, (1,))[0] == 0 and kind == "u":
        a = np.iinfo(a.dtype).max - a
    a = a.astype(a.dtype.newbyteorder("="))
    return a[:, :, 0] if channels == 1 else a


def decode_png(data: bytes) -> np.ndarray:
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG file")
    at, body, palette, head = 8, bytearray(), None, None
    while at < len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        chunk = data[at + 8 : at + 8 + n]
        if zlib.crc32(kind + chunk) != struct.unpack_from(">I", data, at + 8 + n)[0]:
            raise ValueError("PNG chunk is damaged")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body += chunk
        at += 12 + n
        if kind == b"IEND":
            break
    if head is None:
        raise ValueError("PNG without a header")
    width, height, bits, colour, _, _, interlaced = head
    if interlaced or bits < 8:
        raise Unsupported("PNG layout")
    channels, wide = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour], bits // 8
    step, row = channels * wide, width * channels * wide
    raw = np.frombuffer(zlib.decompress(bytes(body)), np.uint8).reshape(height, row + 1)
    out, above = np.zeros((height, row), np.uint8), np.zeros(row, np.uint8)
    for y in range(height):
        how, line = raw[y, 0], raw[y, 1:].copy()
        if how == 1:
            line = np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
        elif how == 2:
            line += above
        elif how in (3, 4):
            for x in range(row):
                left, up, corner = int(line[x - step]) if x >= step else 0, int(above[x]), int(above[x - step]) if x >= step else 0
                if how == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    guess = min(((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner)))[2]
                line[x] = (int(line[x]) + guess) & 255
        out[y] = above = line
    a = out.view(">u2").astype(np.uint16) if wide == 2 else out
    a = a.reshape(height, width, channels)
    if colour == 3:
        return palette[a[:, :, 0]]
    return a[:, :, 0] if channels == 1 else a


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed 24- and 32-bit bitmaps, as RGB."""
    if data[:2] != b"BM" or len(data) < 54:
        raise ValueError("not a BMP file")
    start, _, width, height, _, bits, packed = struct.unpack_from("<IIiiHHI", data, 10)
    if bits not in (24, 32) or packed not in (0, 3):
        raise Unsupported("BMP layout")
    if packed == 3 and struct.unpack_from("<III", data, 54) != (0xFF0000, 0xFF00, 0xFF):
        raise Unsupported("BMP colour masks")
    stride = (width * bits // 8 + 3) // 4 * 4
    a = np.frombuffer(data, np.uint8, stride * abs(height), start).reshape(abs(height), stride)
    a = a[:, : width * bits // 8].reshape(abs(height), width, bits // 8)[:, :, 2::-1]
    return np.ascontiguousarray(a[::-1] if height > 0 else a)


def decode(data: bytes) -> np.ndarray:
    """An H x W or H x W x C array of the file's own dtype; ValueError if damaged, Unsupported if of another form."""
    try:
        if data[:2] in (b"II", b"MM"):
            return decode_tiff(data)
        if data[:4] == b"\x89PNG":
            return decode_png(data)
        if data[:2] == b"BM":
            return decode_bmp(data)
    except (struct.error, KeyError, IndexError, zlib.error, TypeError) as e:
        raise ValueError(f"damaged image: {e}") from e
    raise Unsupported("unknown image format")


def _verify_tiff(data: bytes) -> None:
    t = tiff_tags(data)
    if any(k not in t for k in (256, 257)) or not (273 in t or 324 in t):
        raise ValueError("TIFF without sizes or data")
    at, sizes = (t[273], t.get(279)) if 273 in t else (t[324], t.get(325))
    if sizes is None or any(a + n > len(data) for a, n in zip(at, sizes, strict=True)):
        raise ValueError("TIFF data are missing")


def _verify_png(data: bytes) -> None:
    at, kinds = 8, []
    while at < len(data) and b"IEND" not in kinds:
        n, kind = struct.unpack_from(">I4s", data, at)
        if zlib.crc32(data[at + 4 : at + 8 + n]) != struct.unpack_from(">I", data, at + 8 + n)[0]:
            raise ValueError("PNG chunk is damaged")
        kinds.append(kind)
        at += 12 + n
    if not kinds or kinds[0] != b"IHDR" or kinds[-1] != b"IEND":
        raise ValueError("PNG is cut off")


def verify(data: bytes) -> None:
    """ValueError for a file of no known image format, or whose structure is damaged or cut off; pixels are not decoded."""
    try:
        if data[:2] in (b"II", b"MM"):
            _verify_tiff(data)
        elif data[:8] == b"\x89PNG\r\n\x1a\n":
            _verify_png(data)
        elif data[:2] == b"BM":
            if len(data) < 54 or struct.unpack_from("<I", data, 10)[0] >= len(data):
                raise ValueError("BMP is cut off")
        elif data[:3] == b"\xff\xd8\xff":
            if not data.rstrip(b"\0").endswith(b"\xff\xd9"):
                raise ValueError("JPEG is cut off")
        elif data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            if struct.unpack_from("<I", data, 4)[0] + 8 > len(data):
                raise ValueError("WebP is cut off")
        else:
            raise ValueError("no known image format")
    except (struct.error, KeyError, IndexError, TypeError) as e:
        raise ValueError(f"damaged image: {e}") from e


def gps(data: bytes) -> tuple[float, float] | tuple[None, None]:
    """Decimal latitude and longitude of a TIFF's GPS directory; nulls where there is none, or at (0, 0)."""
    try:
        tags = tiff_tags(data)
        own = tiff_tags(data, tags[0x8825][0])
        lat, lon = (d + m / 60 + s / 3600 for d, m, s in (own[2], own[4]))
    except (ValueError, KeyError, struct.error, IndexError):
        return None, None
    lat, lon = -lat if own.get(1, ("N",))[0] in ("S", "W") else lat, -lon if own.get(3, ("E",))[0] in ("S", "W") else lon
    return (None, None) if lat == 0 and lon == 0 else (lat, lon)


def convert(a: np.ndarray, mode: str | None) -> np.ndarray:
    """To L (ITU-R 601 luma) or RGB; None leaves it."""
    if mode is None:
        return a
    if mode == "RGB":
        return np.repeat(a[:, :, None], 3, axis=2) if a.ndim == 2 else a[:, :, :3] if a.shape[2] >= 3 else np.repeat(a[:, :, :1], 3, axis=2)
    if mode == "L":
        if a.ndim == 2 or a.shape[2] < 3:
            return a if a.ndim == 2 else a[:, :, 0]
        return (a[:, :, :3].astype(np.float64) @ [0.299, 0.587, 0.114] + (0.5 if a.dtype.kind == "u" else 0)).astype(a.dtype)
    raise ValueError(f"mode {mode}")
