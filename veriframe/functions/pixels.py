"""Pixel statistics of decoded images, computed batch-wise in NumPy; verdicts on them stay in column expressions.

Images are BGR bytes with height and width, as Spark's ``image`` source gives them. The kernels are our own
definitions from the published formulas (HSV value, ITU-601 luma and chroma, 3x3 Sobel, tile-wise histogram equalisation).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def frame(data: bytes | None, height: int, width: int) -> np.ndarray | None:
    if data is None or not height or not width or len(data) < height * width * 3:
        return None
    return np.frombuffer(data, np.uint8)[: height * width * 3].reshape(height, width, 3)


def crop(image: np.ndarray, box: tuple[int, int, int, int] | None, margin: float) -> np.ndarray:
    """The box less a margin on each side, within the image; the whole image without a box."""
    h, w = image.shape[:2]
    x, y, bw, bh = box or (0, 0, w, h)
    dx, dy = int(bw * margin), int(bh * margin)
    x0, y0, x1, y1 = max(0, x + dx), max(0, y + dy), min(w, x + bw - dx), min(h, y + bh - dy)
    return image[y0:y1, x0:x1] if x1 > x0 and y1 > y0 else image[:0, :0]


def luma(image: np.ndarray) -> np.ndarray:
    return image @ np.array([0.114, 0.587, 0.299])


def mean_value(image: np.ndarray) -> float | None:
    """Mean of HSV's V: the largest channel."""
    return float(image.max(axis=2).mean()) if image.size else None


def equalised(y: np.ndarray, clip: float = 2.0, tiles: int = 8) -> np.ndarray:
    """Contrast-limited histogram equalisation by tiles, with the mappings interpolated between tile centres."""
    h, w = y.shape
    y = np.clip(np.rint(y), 0, 255).astype(np.int64)
    rows, cols = np.minimum(np.arange(h) * tiles // max(h, 1), tiles - 1), np.minimum(np.arange(w) * tiles // max(w, 1), tiles - 1)
    tile = rows[:, None] * tiles + cols[None, :]
    counts = np.bincount((tile * 256 + y).ravel(), minlength=tiles * tiles * 256).reshape(-1, 256).astype(float)
    size = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    limit = np.maximum(clip * size / 256, 1)
    spare = np.maximum(counts - limit, 0).sum(axis=1, keepdims=True)
    maps = (np.cumsum(np.minimum(counts, limit) + spare / 256, axis=1) / size * 255).reshape(tiles, tiles, 256)
    fy, fx = np.clip((np.arange(h) + 0.5) * tiles / h - 0.5, 0, tiles - 1), np.clip((np.arange(w) + 0.5) * tiles / w - 0.5, 0, tiles - 1)
    y0, x0 = fy.astype(int), fx.astype(int)
    y1, x1 = np.minimum(y0 + 1, tiles - 1), np.minimum(x0 + 1, tiles - 1)
    wy, wx = (fy - y0)[:, None], (fx - x0)[None, :]
    at = lambda a, b: maps[a[:, None], b[None, :], y]
    return (1 - wy) * ((1 - wx) * at(y0, x0) + wx * at(y0, x1)) + wy * ((1 - wx) * at(y1, x0) + wx * at(y1, x1))


def gradient_energy(y: np.ndarray, *, border: bool = True) -> float:
    """Root mean square of the 3x3 Sobel gradient, with edges mirrored, or of the inner pixels alone."""
    p = y if not border else np.pad(y, 1, mode="reflect") if min(y.shape) > 1 else np.pad(y, 1, mode="edge")
    gx = (p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2])
    gy = (p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:])
    return float(np.sqrt((gx * gx + gy * gy).mean()))


def sharpness(image: np.ndarray, *, min_luma: float = 35, min_contrast: float = 4, equalise: bool = True) -> float | None:
    """None where the image is too dark or too flat to tell."""
    if not image.size:
        return None
    y = luma(image)
    if y.mean() < min_luma or y.std() < min_contrast:
        return None
    return gradient_energy(equalised(y) if equalise else y)


def skin_share(image: np.ndarray, cr: tuple[int, int] = (133, 173), cb: tuple[int, int] = (77, 127)) -> float | None:
    if not image.size:
        return None
    y = luma(image)
    red, blue = (image[..., 2] - y) * 0.713 + 128, (image[..., 0] - y) * 0.564 + 128
    return float(((red >= cr[0]) & (red <= cr[1]) & (blue >= cb[0]) & (blue <= cb[1])).mean())


def is_color(image: np.ndarray, *, stride: int = 4, tolerance: int = 8, share: float = 0.02) -> bool:
    """Whether enough sampled pixels have channels that differ."""
    some = image[::stride, ::stride].astype(np.int16)
    return bool(some.size) and float(((some.max(axis=2) - some.min(axis=2)) > tolerance).mean()) >= share


def channels_differ(image: np.ndarray) -> bool:
    """The rule for stills: whether any pixel has channels that differ at all."""
    return bool((image != image[..., :1]).any())


def statistic(kernel: Callable[[np.ndarray], float | bool | None], kind: str = "double") -> Callable[..., Column]:
    """A column function (data, height, width) of a kernel; undecodable images give null."""

    @F.pandas_udf(kind)
    def run(data: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
        images = (frame(d, int(h or 0), int(w or 0)) for d, h, w in zip(data, height, width, strict=True))
        return pd.Series([None if i is None else kernel(i) for i in images], dtype=object)

    return run
