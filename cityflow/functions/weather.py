"""Weather category to precipitation level."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The level of each category the feed reports.
RAIN_LEVELS = {
    "Clear": 0.0,
    "Partly Cloudy": 0.1,
    "Mostly Cloudy": 0.1,
    "Breezy and Mostly Cloudy": 0.1,
    "Overcast": 0.2,
    "Breezy and Overcast": 0.2,
    "Drizzle": 0.4,
    "Light Rain": 0.6,
    "Rain": 0.8,
    "Heavy Rain": 1.0,
}


def rain_level(summary: Column, strict: bool = False) -> Column:
    """Level of a category; an unknown one is null, or an error when ``strict``."""
    levels = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in RAIN_LEVELS.items()))
    level = levels[summary]
    if not strict:
        return level
    unknown = F.raise_error(F.concat(F.lit("unknown weather category: "), summary)).cast("double")
    return F.when(summary.isNotNull() & level.isNull(), unknown).otherwise(level)
