"""Distances from a point (one double column per coordinate) to a few centres."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(point: Sequence[Column], center: Sequence[float | Column]) -> Column:
    """Unrolled over the coordinates, so it stays inside generated code."""
    terms = []
    for x, c in zip(point, center, strict=True):
        diff = x - (c if isinstance(c, Column) else F.lit(float(c)))
        terms.append(diff * diff)
    return reduce(add, terms)


def distances(point: Sequence[Column], centers: Sequence[Sequence[float]]) -> Column:
    """Array of Euclidean distances, one per centre."""
    return F.array(*[F.sqrt(squared_distance(point, c)) for c in centers])


def positions_of_min(values: Column) -> Column:
    """0-based positions of every minimum of an array."""
    low = F.array_min(values)
    tagged = F.transform(values, lambda v, i: F.when(v == low, i))
    return F.filter(tagged, lambda i: i.isNotNull())
