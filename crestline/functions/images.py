"""Pixels to hashes (I1-I7, F18) in numpy, for decoded images in the byte order of Spark's image source (BGR, BGRA or grey)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crestline.functions import fixed_values as V
from crestline.functions.svg import render_ready

HASHES = "path string, p long, d long, a long"


def to_rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Height x width x 3; transparency over neutral grey."""
    x = np.frombuffer(data, "uint8").reshape(height, width, channels)
    if channels == 1:
        return np.repeat(x, 3, axis=2)
    rgb = x[:, :, 2::-1]
    if channels == 4:
        alpha = x[:, :, 3:].astype("float64") / 255
        rgb = np.rint(rgb * alpha + V.GREY * (1 - alpha)).astype("uint8")
    return rgb


def is_low_contrast(rgb: np.ndarray) -> bool:
    return int((rgb.max((0, 1)).astype(int) - rgb.min((0, 1))).max()) < V.LEAST_CONTRAST


def grey(rgb: np.ndarray) -> np.ndarray:
    """Luma in integer arithmetic."""
    x = rgb.astype("int64")
    return ((x[..., 0] * 19595 + x[..., 1] * 38470 + x[..., 2] * 7471 + 0x8000) >> 16).astype("uint8")


def crop_to_content(rgb: np.ndarray) -> np.ndarray:
    """Without the even border; the background is the most frequent corner, of equals the first (top left, top right, bottom left, bottom right)."""
    h, w = rgb.shape[:2]
    if w < V.CROP_LEAST or h < V.CROP_LEAST:
        return rgb
    corners = [tuple(rgb[y, x].tolist()) for y, x in ((0, 0), (0, w - 1), (h - 1, 0), (h - 1, w - 1))]
    back = np.array(max(corners, key=lambda c: (corners.count(c), -corners.index(c))))
    mask = grey(np.abs(rgb.astype(int) - back).astype("uint8")) > V.CROP_THRESHOLD
    rows, cols = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    if not len(rows):
        return rgb
    pad = max(4, min(w, h) // 12)
    out = rgb[max(0, rows[0] - pad) : min(h, rows[-1] + 1 + pad), max(0, cols[0] - pad) : min(w, cols[-1] + 1 + pad)]
    return out if min(out.shape[:2]) >= V.LEAST_SIDE else rgb


def _lanczos(size: int, to: int) -> np.ndarray:
    """to x size weights of a three-lobed Lanczos window, widened when shrinking."""
    scale = size / to
    wide = max(1.0, scale)
    centre = (np.arange(to) + 0.5) * scale
    x = (np.arange(size) + 0.5 - centre[:, None]) / wide
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0)
    return w / w.sum(1, keepdims=True)


def resize(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """8-bit result after each direction."""
    x = x.astype("float64")
    across = np.clip(np.rint(np.tensordot(x, _lanczos(x.shape[1], width), axes=(1, 1))), 0, 255)
    across = np.moveaxis(across, -1, 1)
    down = np.clip(np.rint(np.tensordot(_lanczos(x.shape[0], height), across, axes=(1, 0))), 0, 255)
    return down.astype("uint8")


def _dct_matrix(n: int) -> np.ndarray:
    k = np.arange(n)
    return 2 * np.cos(np.pi * k[:, None] * (2 * k[None, :] + 1) / (2 * n))


def _pack(bits: np.ndarray) -> int:
    return int(np.packbits(bits.ravel(), bitorder="little").view("<i8")[0])


def hash_pixels(rgb: np.ndarray) -> tuple[int, int, int]:
    """(p, d, a) of an image, bit i of row-major order at 2^i."""
    square = resize(crop_to_content(rgb), V.NORM_SIDE, V.NORM_SIDE)
    g, s = grey(square), V.HASH_SIDE
    m = _dct_matrix(4 * s)
    low = (m @ resize(g, 4 * s, 4 * s).astype("float64") @ m.T)[:s, :s]
    wide = resize(g, s, s + 1)
    small = resize(g, s, s)
    return _pack(low > np.median(low)), _pack(wide[:, 1:] > wide[:, :-1]), _pack(small > small.mean())


def hash_image(data: bytes, height: int, width: int, channels: int) -> tuple[int | None, int | None, int | None]:
    """Nulls for images that are too small, of low contrast or unreadable."""
    try:
        if height < V.LEAST_SIDE or width < V.LEAST_SIDE:
            return None, None, None
        rgb = to_rgb(data, height, width, channels)
        return (None, None, None) if is_low_contrast(rgb) else hash_pixels(rgb)
    except (ValueError, TypeError, IndexError):
        return None, None, None


def hash_images(images: DataFrame) -> DataFrame:
    """(path, p, d, a) of decoded images; every image is read by one task only."""
    def run(batches):
        for pdf in batches:
            rows = [(p, *hash_image(x, h, w, c)) for p, x, h, w, c in zip(pdf["path"], pdf["data"], pdf["height"], pdf["width"], pdf["channels"])]
            yield pd.DataFrame(rows, columns=["path", "p", "d", "a"]).astype({c: "Int64" for c in "pda"})

    return images.select("path", "data", "height", "width", "channels").mapInPandas(run, HASHES)


def hash_drawings(files: DataFrame, render) -> DataFrame:
    """(path, p, d, a) of vector images (path, content) by a renderer that is handed in, as none is at hand here.

    ``render(markup) -> (data, height, width, channels)`` or None, with bytes in the order of the image source. It gets the markup
    made ready for it (P10) and, if it fails on that, the markup as it was. What can't be drawn has null hashes.
    """
    def drawn(*markups):
        for m in markups:
            try:
                got = render(m) if m is not None else None
            except Exception:
                continue
            if got is not None:
                return hash_image(*got)
        return None, None, None

    def run(batches):
        for pdf in batches:
            rows = [(p, *drawn(r, s)) for p, r, s in zip(pdf["path"], pdf["ready"], pdf["markup"])]
            yield pd.DataFrame(rows, columns=["path", "p", "d", "a"]).astype({c: "Int64" for c in "pda"})

    text = files.select("path", F.try_validate_utf8(F.col("content").cast("string")).alias("markup"))
    return text.select("path", render_ready(F.col("markup")).alias("ready"), "markup").mapInPandas(run, HASHES)
