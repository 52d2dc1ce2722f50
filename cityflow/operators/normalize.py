"""Scaling feature points by fixed or fitted bounds, and by the maximum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.options import FEATURES, Bounds, NormalizerBounds


def _scaled(x: Column, low: float, high: float) -> Column:
    return (x - F.lit(low)) / F.lit(high - low)


def normalise_points(points: DataFrame, bounds: NormalizerBounds | None = None) -> DataFrame:
    """Feature points to normalised coordinates, without clamping."""
    b = bounds or NormalizerBounds()
    low, high = b.tweets.low, b.tweets.high
    if b.invert:
        low, high = high, low
    per_bucket = F.col("tweets") * F.lit(b.bucket_minutes) / F.lit(b.window_minutes)
    scaled = {"tweets": _scaled(per_bucket, low, high)}
    for name in FEATURES[1:]:
        bound: Bounds = getattr(b, name)
        scaled[name] = _scaled(F.col(name), bound.low, bound.high)
    return points.withColumns(scaled)


def fit_bounds(training: DataFrame) -> DataFrame:
    """One row: smallest and largest value per feature over the complete training rows."""
    complete = training.dropna(subset=[f for f in FEATURES])
    aggs = [agg(f).alias(f"{label}_{f}") for f in FEATURES for label, agg in
            (("min", F.min), ("max", F.max))]
    return complete.agg(*aggs)


def bounds_from_row(row, defaults: NormalizerBounds | None = None) -> NormalizerBounds:
    """The row of `fit_bounds` as parameters; precipitation keeps its 0..1 scale."""
    d = defaults or NormalizerBounds()
    fitted = {f: Bounds(float(row[f"min_{f}"]), float(row[f"max_{f}"])) for f in FEATURES}
    fitted["precip"] = d.precip
    return NormalizerBounds(
        **fitted,
        bucket_minutes=d.bucket_minutes,
        window_minutes=d.window_minutes,
        invert=d.invert,
    )


def max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column divided by its global maximum (null where that is zero).

    The maxima are a one-row scalar subquery: one pass for all columns, and no join.
    """
    top = df.agg(F.struct(*[F.max(c).cast("double").alias(c) for c in columns])).scalar()
    return df.withColumns({c: F.try_divide(F.col(c).cast("double"), top[c]) for c in columns})
