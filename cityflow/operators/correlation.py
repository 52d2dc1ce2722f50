"""How feeds move together, and how much each moved over the last days.

Feeds are first put into aligned buckets, one row per bucket and feed, so what
follows grows with time and not with the number of samples.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def aligned_buckets(records: DataFrame, features: Sequence[str], seconds: int = 3600, ts: str = "ts") -> DataFrame:
    """``bucket, feature, value``: each feature's mean per bucket; ``bucket`` counts from the epoch.

    ``records`` has a column per feature, null where a record is of another feed.
    A bucket in which a feature has no value has no row of it.
    """
    bucket = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")
    means = records.groupBy(bucket.alias("bucket")).agg(*[F.avg(f).alias(f) for f in features])
    long = means.unpivot("bucket", list(features), "feature", "value")
    return long.where("value IS NOT NULL")


def lagged_correlation(buckets: DataFrame, lags: Sequence[int]) -> DataFrame:
    """``first, second, lag, n, correlation``: feature ``second`` against ``first`` ``lag`` buckets before.

    A feature against itself and lag 0 both ways round are left out. Later values
    are shifted to the bucket they are compared with, so one equi-join on the
    bucket serves all lags; a bucket holds one row per feature and lag. Fewer than
    two buckets in common, or a feature that does not move, give null.
    """
    shift = F.explode(F.array(*map(F.lit, lags))).alias("lag")
    later = buckets.select("bucket", F.col("feature").alias("second"), F.col("value").alias("y"), shift)
    later = later.withColumn("bucket", F.col("bucket") - F.col("lag"))
    sooner = buckets.select("bucket", F.col("feature").alias("first"), F.col("value").alias("x"))
    pairs = sooner.join(later, "bucket").where(
        (F.col("first") != F.col("second")) & ((F.col("lag") != 0) | (F.col("first") < F.col("second")))
    )
    moving = (F.max("x") > F.min("x")) & (F.max("y") > F.min("y"))
    # corr() itself divides by zero where a feature does not move
    ratio = F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))
    return pairs.groupBy("first", "second", "lag").agg(
        F.count(F.lit(1)).alias("n"), F.when(moving, ratio).alias("correlation")
    )


def fluctuation(
    buckets: DataFrame, hours: Sequence[int] = (24, 48, 72), seconds: int = 3600
) -> DataFrame:
    """``bucket, feature, value`` and, per span of hours, the mean and the range of the values up to the bucket.

    A span of 24 hours holds the bucket and those that begin less than 24 hours
    before. Frames are taken within blocks as long as the longest span, each with
    the block before it as history, so a feature's whole past is never in one task.
    """
    longest = max(hours) * 3600 // seconds
    block = F.floor(F.col("bucket") / longest).cast("long")
    copies = F.explode(F.array(block, block + 1)).alias("block")
    rows = buckets.select("bucket", "feature", "value", block.alias("home"), copies)
    order = Window.partitionBy("feature", "block").orderBy("bucket")
    out = ["bucket", "feature", "value", "home", "block"]
    for h in hours:
        frame = order.rangeBetween(-(h * 3600 // seconds) + 1, 0)
        out += [
            F.avg("value").over(frame).alias(f"mean_{h}h"),
            (F.max("value").over(frame) - F.min("value").over(frame)).alias(f"range_{h}h"),
        ]
    return rows.select(*out).where("home = block").drop("home", "block")
