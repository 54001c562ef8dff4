"""Figures and filters of images (arrays of rows, grey or blue-green-red) for batch functions: sharpness, brightness, text bands, hashes, contrast."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def laplacian_variance(g: np.ndarray) -> float:
    g = np.pad(g.astype(np.float64), 1, mode="reflect")
    return float((g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]).var())


def grey(img: np.ndarray) -> np.ndarray:
    """Luminance of a blue-green-red image; a grey one stays."""
    if img.ndim == 2:
        return img
    b, g, r = (img[:, :, k].astype(np.int64) for k in range(3))
    return ((b * 3735 + g * 19235 + r * 9798 + (1 << 14)) >> 15).astype(np.uint8)


def row_energy(g: np.ndarray) -> np.ndarray:
    """Mean strength of horizontal change (3 x 3 Sobel, edges mirrored) in each row."""
    g = np.pad(g.astype(np.float32), 1, mode="reflect")
    x = g[:, 2:] - g[:, :-2]
    return np.abs(x[:-2] + 2 * x[1:-1] + x[2:]).mean(axis=1)


def text_bands(g: np.ndarray, top: float = 0.12, bottom: float = 0.28, ratio: float = 2.0) -> list[slice]:
    """Rows of the top and bottom strip of a grey image, as far as their energy is ``ratio`` times the middle's at least."""
    h = g.shape[0]
    energy = row_energy(g)
    end, start = max(1, int(h * top)), min(h - 1, int(h * (1.0 - bottom)))
    if start <= end:
        return []
    middle = float(energy[end:start].mean()) + 1e-6
    return [x for x in (slice(0, end), slice(start, h)) if float(energy[x].mean()) / middle >= ratio]


def crop_news_bands(img: np.ndarray, top: float = 0.12, bottom: float = 0.28, ratio: float = 2.0) -> np.ndarray:
    """The strips where text stands, one below the other; the whole image if there is none."""
    bands = text_bands(grey(img), top, bottom, ratio)
    return np.concatenate([img[x] for x in bands]) if bands else img


def band_signature(img: np.ndarray, top: float = 0.12, bottom: float = 0.28, ratio: float = 2.0) -> int | None:
    """Difference hash of the strips where text stands; None if there is none."""
    g = grey(img)
    bands = text_bands(g, top, bottom, ratio)
    return difference_hash(np.concatenate([g[x] for x in bands])) if bands else None


def _area(n: int, to: int, shrinks: bool) -> np.ndarray:
    """(to, n) weights of area resampling; if it doesn't shrink in both directions, of two neighbours."""
    w = np.zeros((to, n))
    scale = n / to
    for k in range(to):
        if shrinks:
            at = np.arange(n)
            w[k] = np.clip(np.minimum(at + 1, (k + 1) * scale) - np.maximum(at, k * scale), 0, None)
            w[k] /= w[k].sum()
        else:
            at = int(np.floor(k * scale))
            f = (k + 1) - (at + 1) / scale
            f = f - np.floor(f) if f > 0 else 0.0
            w[k, min(at, n - 1)] += 1 - f
            w[k, min(at + 1, n - 1)] += f
    return w


def difference_hash(g: np.ndarray, size: int = 8) -> int:
    """size x size bits: is each cell of a small image (area resampling) brighter than its left neighbour?"""
    h, w = g.shape
    shrinks = h >= size and w >= size + 1
    # The small image has whole values; the first rounding keeps sums that are equal but for their order equal.
    small = np.rint(np.round(_area(h, size, shrinks) @ g.astype(np.float64) @ _area(w, size + 1, shrinks).T, 6)).astype(int)
    bits = (small[:, 1:] > small[:, :-1]).ravel()
    return int(np.packbits(bits).view(">u8")[0].astype(np.int64)) if size == 8 else int("".join("1" if x else "0" for x in bits), 2)


def clahe(g: np.ndarray, clip: float = 2.0, tiles: int = 8) -> np.ndarray:
    """Histograms of tiles x tiles parts equalised with limited contrast, blended between the parts' centres."""
    h, w = g.shape
    src = g
    if h % tiles or w % tiles:
        src = np.pad(g, ((0, tiles - h % tiles), (0, tiles - w % tiles)), mode="reflect")
    th, tw = src.shape[0] // tiles, src.shape[1] // tiles
    limit = max(1, int(clip * th * tw / 256))
    luts = np.zeros((tiles, tiles, 256), np.float32)
    for i in range(tiles):
        for j in range(tiles):
            hist = np.bincount(src[i * th : (i + 1) * th, j * tw : (j + 1) * tw].ravel(), minlength=256)
            more = int(np.maximum(hist - limit, 0).sum())
            hist = np.minimum(hist, limit) + more // 256
            if rest := more % 256:
                hist[: rest * max(256 // rest, 1) : max(256 // rest, 1)] += 1
            luts[i, j] = np.clip(np.rint(np.cumsum(hist).astype(np.float32) * np.float32(255 / (th * tw))), 0, 255)

    def between(n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.arange(n, dtype=np.float32) * np.float32(1 / size) - np.float32(0.5)
        low = np.floor(x).astype(int)
        return np.maximum(low, 0), np.minimum(low + 1, tiles - 1), x - low.astype(np.float32)

    (y1, y2, fy), (x1, x2, fx) = between(h, th), between(w, tw)
    fy, y1, y2 = fy[:, None], y1[:, None], y2[:, None]
    upper = luts[y1, x1, g] * (1 - fx) + luts[y1, x2, g] * fx
    lower = luts[y2, x1, g] * (1 - fx) + luts[y2, x2, g] * fx
    return np.clip(np.rint(upper * (1 - fy) + lower * fy), 0, 255).astype(np.uint8)


def apply_clahe(img: np.ndarray, clip: float = 2.0, tiles: int = 8) -> np.ndarray:
    """``clahe`` of the luminance; the colours stay."""
    if img.ndim == 2:
        return clahe(img, clip, tiles)
    half = 1 << 13
    b, g, r = (img[:, :, k].astype(np.int64) for k in range(3))
    y = (b * 1868 + g * 9617 + r * 4899 + half) >> 14
    cr = np.clip(((r - y) * 11682 + (128 << 14) + half) >> 14, 0, 255) - 128
    cb = np.clip(((b - y) * 9241 + (128 << 14) + half) >> 14, 0, 255) - 128
    y = clahe(y.astype(np.uint8), clip, tiles).astype(np.int64)
    out = [y + ((cb * 29049 + half) >> 14), y + ((cb * -5636 + cr * -11698 + half) >> 14), y + ((cr * 22987 + half) >> 14)]
    return np.clip(np.stack(out, axis=2), 0, 255).astype(np.uint8)


def preprocess(img: np.ndarray) -> np.ndarray:
    """An image as text recognition gets it: contrast first, then the bands."""
    return crop_news_bands(apply_clahe(img))


def shrink(g: np.ndarray, longest: int) -> np.ndarray:
    """Every n-th row and column, so that the longer side is at most ``longest``."""
    n = max(1, -(-max(g.shape) // longest))
    return g[::n, ::n]


def frame_figures(df: DataFrame) -> DataFrame:
    """df(key, height, width, grey binary) with lap_var, brightness, sign (of the text bands; null without any)."""

    def run(batches):
        for b in batches:
            imgs = [np.frombuffer(x, np.uint8).reshape(h, w) for x, h, w in zip(b["grey"], b["height"], b["width"])]
            yield pd.DataFrame({"key": b["key"], "lap_var": [laplacian_variance(i) for i in imgs], "brightness": [float(i.mean()) for i in imgs], "sign": pd.array([band_signature(i) for i in imgs], dtype="Int64")})

    return df.select("key", "height", "width", "grey").mapInPandas(run, "key string, lap_var double, brightness double, sign long")
