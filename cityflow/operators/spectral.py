"""Power spectrum of IQ frames."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The four-term Blackman-Harris window, and the floor below which power is clipped.
BLACKMAN_HARRIS = (0.35875, 0.48829, 0.14128, 0.01168)
POWER_FLOOR = 1e-18


@lru_cache(maxsize=8)
def blackman_harris(n: int) -> np.ndarray:
    if n == 1:
        return np.ones(1)
    angle = 2 * np.pi * np.arange(n) / (n - 1)
    a0, a1, a2, a3 = BLACKMAN_HARRIS
    return a0 - a1 * np.cos(angle) + a2 * np.cos(2 * angle) - a3 * np.cos(3 * angle)


def power_db(frames: np.ndarray) -> np.ndarray:
    """Frames (one per row) to 10*log10 of the squared magnitude, zero frequency centred."""
    spectrum = np.fft.fftshift(np.fft.fft(frames * blackman_harris(frames.shape[1])), axes=1)
    power = spectrum.real**2 + spectrum.imag**2
    return 10 * np.log10(np.maximum(power, POWER_FLOOR))


def power_spectrum(frames: DataFrame, re: Column | str = "re", im: Column | str | None = "im"):
    """Add ``power``, the spectrum of each frame in decibels; ``im=None`` means real frames.

    Frames of one length are transformed together, one Arrow batch at a time.
    """

    @F.pandas_udf("array<double>")
    def spectrum(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for re_part, im_part in batches:
            out: list = [None] * len(re_part)
            lengths = re_part.map(lambda x: -1 if x is None else len(x)).to_numpy()
            for n in np.unique(lengths[lengths > 0]):
                rows = np.flatnonzero(lengths == n)
                frame = np.stack(re_part.iloc[rows].to_list()).astype(np.float64)
                # each frame by itself: one without an imaginary part is real
                imag = [np.zeros(n) if x is None else x for x in im_part.iloc[rows]]
                frame = frame + 1j * np.stack(imag).astype(np.float64)
                for row, power in zip(rows, power_db(frame)):
                    out[row] = power
            yield pd.Series(out)

    imaginary = F.lit(None).cast("array<double>") if im is None else im
    return frames.withColumn("power", spectrum(re, imaginary))
