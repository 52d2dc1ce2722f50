"""Ten-minute training buckets from three archived feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.options import FEATURES, WEATHER_FEATURES


def count_per_bucket(tweets: DataFrame) -> DataFrame:
    return tweets.groupBy("bucket").agg(F.count(F.lit(1)).alias("tweets"))


def traffic_per_bucket(traffic: DataFrame) -> DataFrame:
    return traffic.groupBy("bucket").agg(F.avg("traffic").alias("traffic"))


def weather_per_bucket(weather: DataFrame) -> DataFrame:
    """Mean of the four readings, each rounded to six digits."""
    means = [F.round(F.avg(c), 6).alias(c) for c in WEATHER_FEATURES]
    return weather.groupBy("bucket").agg(*means)


def training_set_joined(tweets: DataFrame, traffic: DataFrame, weather: DataFrame) -> DataFrame:
    """Three-way full outer join of the per-bucket aggregates."""
    sides = (count_per_bucket(tweets), weather_per_bucket(weather), traffic_per_bucket(traffic))
    joined = sides[0].join(sides[1], "bucket", "full_outer").join(sides[2], "bucket", "full_outer")
    return joined.select("bucket", *FEATURES)


def training_set(tweets: DataFrame, traffic: DataFrame, weather: DataFrame) -> DataFrame:
    """The same rows in one shuffle: union the feeds, then aggregate each feed's own columns.

    A bucket the tweet feed never mentions has a null count, as in the join.
    """
    feeds = (
        tweets.select("bucket", F.lit(1).alias("tweets"))
        .unionByName(weather, allowMissingColumns=True)
        .unionByName(traffic, allowMissingColumns=True)
    )
    return feeds.groupBy("bucket").agg(
        F.nullif(F.count("tweets"), F.lit(0).cast("long")).alias("tweets"),
        *[F.round(F.avg(c), 6).alias(c) for c in WEATHER_FEATURES],
        F.avg("traffic").alias("traffic"),
    )


def complete_rows(training: DataFrame) -> DataFrame:
    """Buckets in which all three feeds reported."""
    return training.dropna(subset=list(FEATURES))


def feed_lists(training: DataFrame) -> DataFrame:
    """List view of a training row: one element per feed, none where the feed is absent."""

    def listed(value, present):
        return F.when(present, F.array(value)).otherwise(F.array())

    weather = F.struct(*WEATHER_FEATURES)
    return training.select(
        "bucket",
        listed(F.col("tweets"), F.col("tweets").isNotNull()).alias("twitter"),
        listed(weather, F.col("uv").isNotNull()).alias("weather"),
        listed(F.col("traffic"), F.col("traffic").isNotNull()).alias("traffic"),
    )
