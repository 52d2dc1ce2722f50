"""Quantiles with a bounded relative error from sketches that merge by adding up.

Values are counted in buckets whose borders grow by a constant factor, so the
middle of a value's bucket is off by ``accuracy`` of the value at most, whatever the
range. Tasks count their Arrow batches in numpy and pass on a row per key and
bucket; adding such rows merges sketches of tasks, of days or of tables alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def growth(accuracy: float) -> float:
    """The factor between the borders of a bucket."""
    if not 0 < accuracy < 1:
        raise ValueError(f"accuracy must be in (0, 1), not {accuracy}")
    return (1 + accuracy) / (1 - accuracy)


def quantile_sketch(df: DataFrame, keys: Sequence[str], value: str, accuracy: float = 0.01) -> DataFrame:
    """``keys, sign, bucket, n``: how many values of each key lie in each bucket.

    Zero is a bucket of its own, negative values mirror positive ones. Nulls and
    NaN count nowhere; infinities have the outermost buckets.
    """
    keys = list(keys)
    step = math.log(growth(accuracy))
    types = dict(df.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + ["sign INT", "bucket INT", "n LONG"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(len(keys)).to_numpy(zero_copy_only=False).astype(np.float64)
            known = ~np.isnan(x)
            sign = np.sign(np.where(known, x, 0.0)).astype(np.int32)
            size = np.abs(np.where(known & (x != 0), x, 1.0))
            bucket = np.ceil(np.log(np.minimum(size, np.finfo(float).max)) / step).astype(np.int32)
            table = pa.table(
                [*(batch.column(i) for i in range(len(keys))), pa.array(sign), pa.array(bucket)], names=[*keys, "sign", "bucket"]
            ).filter(pa.array(known))
            counted = table.group_by([*keys, "sign", "bucket"]).aggregate([([], "count_all")])
            yield from counted.select([*keys, "sign", "bucket", "count_all"]).rename_columns([*keys, "sign", "bucket", "n"]).to_batches()

    numbers = df.select(*keys, F.col(value).cast("double").alias("_value"))
    return merge_sketches(numbers.mapInArrow(count, schema), keys)


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One sketch per key from any number of them."""
    return sketches.groupBy(*keys, "sign", "bucket").agg(F.sum("n").alias("n"))


def sketch_quantiles(
    sketch: DataFrame, keys: Sequence[str], quantiles: Sequence[float], accuracy: float = 0.01
) -> DataFrame:
    """``keys, q, value``: the value at place ``floor(q * (count - 1))``, off by ``accuracy`` of it at most.

    A key has no more rows than buckets, so one task can hold a key.
    """
    g = growth(accuracy)
    order = Window.partitionBy(*keys).orderBy("sign", F.col("sign") * F.col("bucket"))
    past = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy(*keys))
    middle = F.col("sign") * F.pow(F.lit(g), F.col("bucket")) * F.lit(2 / (g + 1))
    rows = sketch.select(*keys, middle.alias("value"), "n", past.alias("past"), total.alias("total"))
    wanted = rows.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])))
    place = F.floor(F.col("q") * (F.col("total") - 1))
    hit = (F.col("past") > place) & (F.col("past") - F.col("n") <= place)
    return wanted.where(hit).select(*keys, "q", "value")
