"""Padding, promotion, pyramids and tiles."""

from __future__ import annotations

import numpy as np


def harmonise(a: np.ndarray, channels: int) -> np.ndarray:
    """One channel count: grey is repeated, missing channels are 0, a single one is the first."""
    if channels == 1:
        return a if a.ndim == 2 else a[:, :, 0]
    if a.ndim == 2:
        return np.repeat(a[:, :, None], channels, axis=2)
    short = channels - a.shape[2]
    return np.pad(a, ((0, 0), (0, 0), (0, short))) if short > 0 else a[:, :, :channels]


def pad_to(a: np.ndarray, height: int, width: int, on_oversize: str = "error") -> np.ndarray:
    """Zeros below and to the right; a larger image is an error, or cropped."""
    if a.shape[0] > height or a.shape[1] > width:
        if on_oversize != "crop":
            raise ValueError("image larger than its bucket")
        a = a[:height, :width]
    return np.pad(a, ((0, height - a.shape[0]), (0, width - a.shape[1]), *[(0, 0)] * (a.ndim - 2)))


def gray(a: np.ndarray, percentiles: tuple[float, float] | None = None) -> np.ndarray:
    """Mean over channels in the image's dtype; with percentiles, stretched between them to 0..1 in float32."""
    g = a if a.ndim == 2 else a[:, :, 0] if a.shape[2] == 1 else a.mean(axis=2).astype(a.dtype)
    if percentiles is None:
        return g
    lo, hi = np.percentile(g, percentiles)
    return np.clip((g.astype(np.float32) - lo) / max(hi - lo, 1e-6), 0, 1).astype(np.float32)


def halve(a: np.ndarray, factor: int = 2) -> np.ndarray:
    """Block means in the image's dtype; sizes that do not divide are padded with zeros."""
    h, w = -(-a.shape[0] // factor), -(-a.shape[1] // factor)
    p = pad_to(a, h * factor, w * factor)
    return p.reshape(h, factor, w, factor, *p.shape[2:]).mean(axis=(1, 3)).astype(a.dtype)


def pyramid(a: np.ndarray, levels: int, factor: int = 2) -> list[np.ndarray]:
    out = [a]
    for _ in range(levels - 1):
        out.append(halve(out[-1], factor))
    return out


def tiles(a: np.ndarray, size: int):
    """(ty, tx, tile), edge tiles filled up with zeros, as chunk files need them."""
    for y in range(0, a.shape[0], size):
        for x in range(0, a.shape[1], size):
            yield y // size, x // size, pad_to(a[y : y + size, x : x + size], size, size)
