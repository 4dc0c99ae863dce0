"""Frozen feature extraction over decoded images (runs once per snapshot).

``featurise`` is a ``mapInPandas`` body applied to Arrow batches of decoded
images: fix channels (BGR -> RGB, gray -> 3 channels, drop alpha), resize
bilinearly to the model input size, scale pixels to [-1, 1], then pool.  The
default featuriser is a block-mean grid (``grid`` x ``grid`` cells per
channel); ``grid=1`` is global average pooling.  Any callable mapping an
(n, H, W, 3) float array to (n, D) can be plugged in instead (a pretrained
network where one is available).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame


def to_rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Image-source bytes (BGR / BGRA / gray) -> (h, w, 3) uint8 RGB."""
    a = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(a, 3, axis=2)
    return a[:, :, 2::-1] if channels >= 3 else np.repeat(a[:, :, :1], 3, axis=2)


def resize_bilinear(img: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize with half-pixel centres (no antialiasing)."""
    h, w = img.shape[:2]
    if (h, w) == (height, width):
        return img.astype(np.float64)
    ys = np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1)
    xs = np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1)
    y0 = np.floor(ys).astype(int)
    x0 = np.floor(xs).astype(int)
    y1 = np.minimum(y0 + 1, h - 1)
    x1 = np.minimum(x0 + 1, w - 1)
    wy = (ys - y0)[:, None, None]
    wx = (xs - x0)[None, :, None]
    f = img.astype(np.float64)
    top = f[y0][:, x0] * (1 - wx) + f[y0][:, x1] * wx
    bot = f[y1][:, x0] * (1 - wx) + f[y1][:, x1] * wx
    return top * (1 - wy) + bot * wy


def scale_pixels(x: np.ndarray) -> np.ndarray:
    """[0, 255] -> [-1, 1]."""
    return x / 127.5 - 1.0


def block_mean(x: np.ndarray, grid: int) -> np.ndarray:
    """(H, W, C) -> grid*grid*C block means (row-major cells, channel last)."""
    H, W, Cn = x.shape
    ys = np.linspace(0, H, grid + 1).astype(int)
    xs = np.linspace(0, W, grid + 1).astype(int)
    out = np.empty((grid, grid, Cn))
    for i in range(grid):
        for j in range(grid):
            out[i, j] = x[ys[i]:ys[i + 1], xs[j]:xs[j + 1]].mean(axis=(0, 1))
    return out.ravel()


def featurise(images: DataFrame, height: int = 224, width: int = 224, grid: int = 4,
              scale: bool = True, keep=("path",), extractor=None, sub_batch: int = 64) -> DataFrame:
    """Decoded images -> (keep..., features array<float>).  ``extractor``
    (optional) maps an (n, H, W, 3) batch to (n, D) and is fed ``sub_batch``
    images at a time; the default pools each image as soon as it is resized,
    so memory stays at one image (a 224x224x3 float image is ~1.2 MB)."""
    keep = list(keep)

    def prep(data, h, w, c):
        x = resize_bilinear(to_rgb(bytes(data), int(h), int(w), int(c)), height, width)
        return scale_pixels(x) if scale else x

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            rows = list(zip(pdf["data"], pdf["height"], pdf["width"], pdf["nChannels"]))
            if extractor is None:
                feats = [block_mean(prep(*r), grid).astype(np.float32) for r in rows]
            else:
                feats = []
                for i in range(0, len(rows), sub_batch):
                    chunk = np.stack([prep(*r) for r in rows[i:i + sub_batch]])
                    feats += list(np.asarray(extractor(chunk), dtype=np.float32))
            out = pdf[keep].copy()
            out["features"] = feats
            yield out

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in images.schema if f.name in keep)
    return images.select(*keep, "height", "width", "nChannels", "data") \
                 .mapInPandas(run, f"{schema}, features array<float>")


def channel_means(images: DataFrame, keep=("path",)) -> DataFrame:
    """Global average pooling of raw RGB pixels (no resize, no scaling)."""
    keep = list(keep)

    def run(batches):
        for pdf in batches:
            rows = [to_rgb(bytes(d), int(h), int(w), int(c)).reshape(-1, 3).mean(axis=0)
                    for d, h, w, c in zip(pdf["data"], pdf["height"], pdf["width"], pdf["nChannels"])]
            if not rows:
                continue
            m = np.stack(rows)
            out = pdf[keep].copy()
            out["r_mean"], out["g_mean"], out["b_mean"] = m[:, 0], m[:, 1], m[:, 2]
            yield out

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in images.schema if f.name in keep)
    return images.select(*keep, "height", "width", "nChannels", "data") \
                 .mapInPandas(run, f"{schema}, r_mean double, g_mean double, b_mean double")

