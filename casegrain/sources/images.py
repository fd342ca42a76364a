"""Measures and canonical forms of images, with decoder, encoder and reader of text given by the caller.

No image library is assumed: ``decode`` turns bytes into an array of gray (h, w), RGB (h, w, 3) or RGBA (h, w, 4) values of one byte,
``encode`` an RGB array into bytes, ``read_text`` bytes into the text seen. Whatever they raise becomes the problem of that row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrain.operators.constraints import DiagramError, IntegrityError
from casegrain.sources.artifacts import file_digest

MOST_PIXELS = 200_000_000
SIDE, WHITE = 384, 250
# Weights of red, green and blue in gray.
LUMA = np.array([0.299, 0.587, 0.114])


def flattened(a: np.ndarray, most_pixels: int = MOST_PIXELS) -> np.ndarray:
    """RGB or gray values of an image with its transparency laid on white."""
    if a.ndim not in (2, 3) or not a.size or (a.ndim == 3 and a.shape[2] not in (3, 4)):
        raise DiagramError(f"not an image of gray, RGB or RGBA: {a.shape}")
    if a.shape[0] * a.shape[1] > most_pixels:
        raise DiagramError(f"more than {most_pixels} pixels")
    if a.ndim == 3 and a.shape[2] == 4:
        alpha = a[:, :, 3:].astype(float) / 255
        return a[:, :, :3] * alpha + 255 * (1 - alpha)
    return a.astype(float)


def _averaged(a: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``a`` averaged over ``size`` boxes of equal height; a box takes its share of a row it cuts."""
    n = len(a)
    sums = np.concatenate([np.zeros((1, *a.shape[1:])), np.cumsum(a, axis=0)])
    edges = np.linspace(0, n, size + 1)
    low = np.minimum(np.floor(edges).astype(int), n - 1)
    at = sums[low] + (edges - low).reshape(-1, *[1] * (a.ndim - 1)) * a[low]
    return np.diff(at, axis=0) * size / n


def white_ratio(a: np.ndarray, side: int = SIDE, white: int = WHITE) -> float:
    """The share of nearly white pixels after the longer side was reduced to ``side`` by box averages."""
    g = flattened(a)
    g = np.rint(g @ LUMA if g.ndim == 3 else g)
    scale = max(g.shape) / side
    if scale > 1:
        h, w = (max(1, round(x / scale)) for x in g.shape)
        g = np.rint(_averaged(_averaged(g, h).T, w).T)
    return float((g >= white).mean())


def image_measures(images: DataFrame, decode: Callable[[bytes], np.ndarray], read_text: Callable[[bytes], str] | None = None) -> DataFrame:
    """(image_path, white_ratio, ocr_text_length, problem) of images (image_path, content); null content is a problem."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, data in zip(b["image_path"], b["content"], strict=True):
                ratio = letters = problem = None
                try:
                    if data is None:
                        raise DiagramError("no content")
                    ratio = white_ratio(decode(bytes(data)))
                    letters = len(read_text(bytes(data))) if read_text else None
                except Exception as e:  # noqa: BLE001  decoders raise what they like
                    problem = f"{type(e).__name__}: {e}"[:200]
                rows.append((path, ratio, letters, problem))
            yield pd.DataFrame(rows, columns=["image_path", "white_ratio", "ocr_text_length", "problem"]).astype({"ocr_text_length": "Int64"})

    return images.select("image_path", "content").mapInPandas(scan, "image_path string, white_ratio double, ocr_text_length long, problem string")


def canonical_images(images: DataFrame, decode: Callable[[bytes], np.ndarray], encode: Callable[[np.ndarray], bytes]) -> DataFrame:
    """(image_path, image, image_sha256, problem): every image on white, in RGB, encoded again."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, data in zip(b["image_path"], b["content"], strict=True):
                try:
                    a = flattened(decode(bytes(data)))
                    a = np.repeat(a[:, :, None], 3, axis=2) if a.ndim == 2 else a
                    rows.append((path, encode(np.rint(a).astype(np.uint8)), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((path, None, f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(rows, columns=["image_path", "image", "problem"])

    out = images.select("image_path", "content").mapInPandas(scan, "image_path string, image binary, problem string")
    return out.select("image_path", "image", F.sha2("image", 256).alias("image_sha256"), "problem")


def reader_contract(version: Callable[[], str], files: dict[str, str]) -> dict:
    """What a reader of text is: its version and the digests of its files, to be kept with what it read."""
    return {"version": version().strip(), "files": {name: file_digest(path).hex() for name, path in sorted(files.items())}}


def verify_contract(said: dict, version: Callable[[], str], files: dict[str, str]) -> None:
    now = reader_contract(version, files)
    if now != said:
        raise IntegrityError(f"the reader changed: {sorted(k for k in ('version', 'files') if now.get(k) != said.get(k))}")
