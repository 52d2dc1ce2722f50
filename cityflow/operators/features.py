"""City-state features: three feeds to one feature point per window.

Two equal routes exist. The long form (`key`, `value` rows) mirrors the feeds
one by one. The wide form gives every message one row with the columns it
fills, so weather is not copied four times and a whole point is a single
``groupBy(window)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.functions.text import attribute, number
from cityflow.functions.weather import rain_level
from cityflow.operators.windows import Count, Mean, hopping, rewindow
from cityflow.options import FEATURE_HOP, FEATURE_HOP_LONG, FEATURES, POINT_TUMBLE, Hop


def traffic_records(messages: DataFrame) -> DataFrame:
    """Camera messages: the score of the image model."""
    return messages.select("ts", number(attribute("cnn_output")).alias("traffic"))


def tweet_records(messages: DataFrame) -> DataFrame:
    """Every tweet counts as one."""
    return messages.select("ts", F.lit(1).alias("tweets"))


def weather_records(messages: DataFrame, strict: bool = False) -> DataFrame:
    """Weather messages: precipitation level, temperature, UV index and wind."""
    return messages.select(
        "ts",
        rain_level(attribute("summary"), strict).alias("precip"),
        number(attribute("temp")).alias("temp"),
        number(attribute("uv")).alias("uv"),
        number(attribute("wind")).alias("wind"),
    )


#: The numbers each feed's messages carry as text.
FEED_NUMBERS = {"traffic": ("cnn_output",), "tweets": (), "weather": ("temp", "uv", "wind")}


def feed_faults(messages: DataFrame, feed: str) -> DataFrame:
    """Messages of a feed that lose something on the way to a record, with ``fault`` saying what.

    A message without a usable time is in no window; one whose number is missing or
    unreadable, or whose weather summary has no level, is in its window without that
    value. Several faults are listed together. Works on batches and streams.
    """

    def of(name: str) -> Column:
        text = attribute(name)
        unread = F.when(number(text).isNull(), F.lit(f"unreadable {name}"))
        return F.when(text.isNull(), F.lit(f"missing {name}")).otherwise(unread)

    faults = [F.when(F.col("ts").isNull(), F.lit("no time")), *map(of, FEED_NUMBERS[feed])]
    if feed == "weather":
        faults.append(F.when(rain_level(attribute("summary")).isNull(), F.lit("unknown summary")))
    listed = messages.withColumn("fault", F.concat_ws(", ", *faults))
    return listed.where("fault <> ''")


def to_long(records: DataFrame) -> DataFrame:
    """Feature columns to ``(ts, key, value)`` rows: one row in, one row per feature out."""
    names = [f for f in FEATURES if f in records.columns]
    typed = records.select("ts", *[F.col(n).cast("double").alias(n) for n in names])
    return typed.unpivot("ts", names, "key", "value").filter(F.col("value").isNotNull())


def merge_feeds(*feeds: DataFrame) -> DataFrame:
    """Union of feeds; columns a feed lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def _measures(value_of) -> dict:
    return {
        name: Count(value_of(name)) if name == "tweets" else Mean(value_of(name))
        for name in FEATURES
    }


def windowed_features(records: DataFrame, hop: Hop, paned: bool | None = None) -> DataFrame:
    """Wide records to one row per window: tweet count, means of the rest, null if absent."""
    return hopping(records, hop, [], _measures(F.col), paned=paned)


def windowed_features_long(features: DataFrame, hop: Hop) -> DataFrame:
    """Long features to one ``(window, key, value)`` row: count of tweets, mean otherwise."""
    is_tweets = F.col("key") == "tweets"
    per_key = hopping(
        features, hop, ["key"], {"n": Count(F.col("value")), "mean": Mean(F.col("value"))}
    )
    value = F.when(is_tweets, F.col("n").cast("double")).otherwise(F.col("mean"))
    return per_key.select("window", "key", value.alias("value"))


def pivot_point(windowed: DataFrame) -> DataFrame:
    """Long window results to one wide row per window: the mean of each feature's values."""
    cells = [F.avg(F.when(F.col("key") == name, F.col("value"))).alias(name) for name in FEATURES]
    return windowed.groupBy("window").agg(*cells)


def is_valid_point() -> Column:
    """Tweets, weather (by its UV index) and traffic must all be present."""
    return F.col("tweets").isNotNull() & F.col("uv").isNotNull() & F.col("traffic").isNotNull()


def feature_points(
    records: DataFrame, hop: Hop = FEATURE_HOP, paned: bool | None = None
) -> DataFrame:
    """Valid feature points per hopping window, straight from wide records."""
    points = windowed_features(records, hop, paned).filter(is_valid_point())
    return points.withColumn("tweets", F.col("tweets").cast("double"))


def feature_points_long(features: DataFrame, hop: Hop = FEATURE_HOP) -> DataFrame:
    """`feature_points` from long features, one aggregation per key before the pivot."""
    return pivot_point(windowed_features_long(features, hop)).filter(is_valid_point())


def rewindowed_points(
    records: DataFrame,
    hop: Hop = FEATURE_HOP_LONG,
    tumble: Hop = POINT_TUMBLE,
    paned: bool | None = None,
) -> DataFrame:
    """Points per tumbling window: means of the hopping results, not of the raw rows."""
    hops = windowed_features(records, hop, paned)
    means = [F.avg(name).alias(name) for name in FEATURES]
    points = rewindow(hops, tumble, means)
    return points.filter(is_valid_point()).withColumnRenamed("outer_window", "window")
