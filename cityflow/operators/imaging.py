"""Camera images to model scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.operators.slices import lay_out

# Offset (row, column), height and width of the crop, and the model's input size.
CROP = (80, 80, 160, 220)
INPUT_SIZE = (160, 160)
UNCROPPED_SIZE = (240, 240)
# A label is scaled by this before training.
LABEL_SCALE = 16

Model = Callable[[np.ndarray], np.ndarray]


def decode_pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Spark's image bytes (BGR or grey, row by row) to an RGB float array."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        pixels = np.repeat(pixels, 3, axis=2)
    else:
        pixels = pixels[:, :, [2, 1, 0]]
    return pixels.astype(np.float32)


def resize_bilinear(image: np.ndarray, size: tuple[int, int], half_pixel: bool = False):
    """Bilinear resize; target pixel ``i`` samples source position ``i * in / out``."""

    def axis(n_in: int, n_out: int):
        at = np.arange(n_out, dtype=np.float64)
        scale = n_in / n_out
        at = (at + 0.5) * scale - 0.5 if half_pixel else at * scale
        at = np.clip(at, 0, n_in - 1)
        low = np.floor(at).astype(int)
        high = np.minimum(low + 1, n_in - 1)
        return low, high, (at - low).astype(np.float32)

    r0, r1, fr = axis(image.shape[0], size[0])
    c0, c1, fc = axis(image.shape[1], size[1])
    fr, fc = fr[:, None, None], fc[None, :, None]
    top = image[r0][:, c0] * (1 - fc) + image[r0][:, c1] * fc
    bottom = image[r1][:, c0] * (1 - fc) + image[r1][:, c1] * fc
    return (top * (1 - fr) + bottom * fr).astype(np.float32)


def model_input(image: np.ndarray, crop=CROP, size=INPUT_SIZE) -> np.ndarray:
    """Crop, resize and scale to [0, 1]; ``crop=None`` keeps the whole image."""
    if crop is not None:
        top, left, height, width = crop
        if top + height > image.shape[0] or left + width > image.shape[1]:
            raise ValueError(f"image of {image.shape[:2]} is too small for crop {crop}")
        image = image[top : top + height, left : left + width]
    return resize_bilinear(image, size) / np.float32(255)


def score_images(
    images: DataFrame,
    load_model: Callable[[], Model],
    crop=CROP,
    size=INPUT_SIZE,
    batch_size: int = 32,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Add a model's score to image rows (``image`` struct or its fields as columns).

    ``load_model`` runs once per task and returns ``batch -> scores``. Arrow
    batches are bounded in bytes by the session, and ``batch_size`` bounds the
    float tensors built from them.
    """
    if "image" in images.columns:
        flat = images.select(
            *keep,
            *[F.col(f"image.{c}").alias(c)
              for c in ("origin", "height", "width", "nChannels", "data")],
        )
    else:
        flat = images.select(*keep, "origin", "height", "width", "nChannels", "data")
    kept_types = dict(flat.dtypes)
    schema = ", ".join([f"{c} {kept_types[c]}" for c in keep] + ["origin STRING", "predict DOUBLE"])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start : start + batch_size]
                tensors = np.stack([
                    model_input(decode_pixels(d, h, w, c), crop, size)
                    for d, h, w, c in zip(part.data, part.height, part.width, part.nChannels)
                ])
                scores = np.asarray(model(tensors), dtype=np.float64).reshape(len(part))
                yield part[[*keep, "origin"]].assign(predict=scores)

    return flat.mapInPandas(score, schema)


def sorted_slice(
    df: DataFrame, keys: list[str], first: int | None = None, last: int | None = None
) -> DataFrame:
    """Rows ``first`` to ``last`` (exclusive) in the order of ``keys``; an open end means all."""
    return lay_out(df, keys).slice(first, last)


def label_value(vehicles="vehicles", people="people"):
    """Training target: everything that moves, on the model's scale."""
    return (F.col(vehicles) + F.col(people)) / F.lit(float(LABEL_SCALE))


def train_test_split(df: DataFrame, key: str, test_share: float = 0.1, seed: int = 7):
    """Training and test rows, drawn by a hash of ``key``: one pass, the same rows on every run.

    Rows of one key stay together; a null key counts as one key.
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    return df.where(draw >= test_share), df.where(draw < test_share)


def model_error(df: DataFrame, predict: str = "predict", label: str = "label") -> DataFrame:
    """Mean absolute and mean squared error."""
    miss = F.col(predict) - F.col(label)
    return df.agg(F.avg(F.abs(miss)).alias("mae"), F.avg(miss * miss).alias("mse"))
