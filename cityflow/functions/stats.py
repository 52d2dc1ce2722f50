"""Averages, and user-defined aggregates that combine before they shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_or_nan(value: Column) -> Column:
    """Average that is NaN, not null, over nothing."""
    return F.coalesce(F.avg(value), F.lit(float("nan")))


def combine_per_key(
    df: DataFrame,
    keys: Sequence[str],
    accumulate: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    merge: Mapping[str, Column],
    extract: Mapping[str, Column],
) -> DataFrame:
    """A custom combiner in three steps, none of which sees a whole group at once.

    ``accumulate`` turns one Arrow batch into partial rows (``keys`` plus the
    accumulator columns of ``schema``), ``merge`` names the built-in aggregates
    that fold accumulators, and ``extract`` computes the outputs from them.
    """

    def partials(batches):
        for batch in batches:
            yield accumulate(batch)

    folded = df.mapInPandas(partials, schema).groupBy(*keys).agg(
        *[expr.alias(name) for name, expr in merge.items()]
    )
    return folded.select(*keys, *[expr.alias(name) for name, expr in extract.items()])


def mean_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """`mean_or_nan` per key, written as a custom combiner: the pattern to copy.

    For a plain mean prefer `mean_or_nan`, which never leaves the JVM.
    """
    key_type = dict(df.dtypes)[key]

    def sums(batch: pd.DataFrame) -> pd.DataFrame:
        grouped = batch.groupby(key, dropna=False)[value]
        return grouped.agg(total="sum", n="count").reset_index()[[key, "total", "n"]]

    total, n = F.sum("total"), F.sum("n")
    return combine_per_key(
        df.select(key, F.col(value).cast("double").alias(value)),
        [key],
        sums,
        f"{key} {key_type}, total DOUBLE, n LONG",
        {"total": total, "n": n},
        {"mean": F.when(F.col("n") > 0, F.col("total") / F.col("n")).otherwise(float("nan"))},
    )
