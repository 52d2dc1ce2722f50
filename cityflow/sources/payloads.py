"""Landed JSON payloads: weather observations, tweets and published channel results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.functions.text import payload_text


def parse_weather(payloads: DataFrame, column: str = "value") -> DataFrame:
    """The current conditions of a weather response, one typed row each."""
    now = F.from_json(F.col(column), schemas.WEATHER_PAYLOAD)["currently"]
    return payloads.withColumn("_now", now).select(
        *[c for c in payloads.columns if c != column],
        F.timestamp_seconds(F.col("_now.time")).alias("ts"),
        F.col("_now.summary").alias("summary"),
        F.col("_now.icon").alias("icon"),
        F.col("_now.precipProbability").alias("precip"),
        F.col("_now.temperature").alias("temp"),
        F.col("_now.uvIndex").alias("uv"),
        F.col("_now.windSpeed").alias("wind"),
    )


def parse_tweets(raw: DataFrame, column: str = "value") -> DataFrame:
    """Raw tweet JSON to the nested TWEET columns."""
    return raw.select(F.from_json(F.col(column), schemas.TWEET).alias("t")).select("t.*")


def normalise_tweets(tweets: DataFrame) -> DataFrame:
    """Nested tweets to flat rows; a truncated one takes its extended text and entities."""
    cut = F.coalesce(F.col("truncated"), F.lit(False))
    long_form = F.col("extended_tweet")
    entities = F.when(cut, long_form["entities"]).otherwise(F.col("entities"))
    return tweets.select(
        "id_str",
        F.timestamp_millis(F.col("timestamp_ms").try_cast("long")).alias("ts"),
        "created_at",
        "timestamp_ms",
        "lang",
        F.when(cut, long_form["full_text"]).otherwise(F.col("text")).alias("text"),
        F.col("coordinates.coordinates").alias("coordinates"),
        entities["hashtags"]["text"].alias("hashtags"),
        entities["user_mentions"]["screen_name"].alias("user_mentions"),
        "source",
        F.col("user.id_str").alias("author_id_str"),
        F.col("user.location").alias("author_location"),
        F.col("user.geo_enabled").alias("author_geo_enabled"),
        F.col("user.statuses_count").alias("author_statuses_count"),
        F.col("user.followers_count").alias("author_followers_count"),
        F.col("user.friends_count").alias("author_friends_count"),
        F.col("place.id").alias("place_id_str"),
        F.col("place.place_type").alias("place_type"),
        F.col("place.full_name").alias("place_full_name"),
        F.col("place.country_code").alias("place_country_code"),
        F.col("place.country").alias("place_country"),
        F.col("place.bounding_box.type").alias("place_bounding_box_type"),
        F.col("place.bounding_box.coordinates").alias("place_bounding_box_coordinates"),
    )


def tweets_to_messages(tweets: DataFrame) -> DataFrame:
    """Flat tweets to publishable messages: text payload, every other column an attribute."""

    def as_text(name: str, dtype: str) -> Column:
        nested = dtype.startswith(("array", "struct", "map"))
        return F.to_json(F.col(name)) if nested else F.col(name).cast("string")

    skipped = {"ts", "text"}
    entries = [
        F.struct(F.lit(n).alias("key"), as_text(n, d).alias("value"))
        for n, d in tweets.dtypes
        if n not in skipped
    ]
    filled = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
    return tweets.select(
        F.encode(F.col("text"), "UTF-8").alias("data"),
        F.map_from_entries(filled).alias("attributes"),
        F.col("ts").alias("publish_time"),
    )


def _channel_text(messages: DataFrame, data: str) -> Column:
    dtype = dict(messages.dtypes)[data]
    return payload_text(data) if dtype == "binary" else F.col(data)


def unreadable_channel_results(messages: DataFrame, data: str = "data") -> DataFrame:
    """Messages without a channel result, with the reason in ``fault``."""
    text = _channel_text(messages, data)
    sides = F.from_json(text, schemas.CHANNEL_JSON)
    fault = (
        F.when(text.isNull(), "no payload")
        .when(sides.isNull(), "bad json")
        .when(F.size(sides) == 0, "no channel")
    )
    return messages.withColumn("fault", fault).where("fault IS NOT NULL")


def decode_channel_results(messages: DataFrame, data: str = "data") -> DataFrame:
    """Published channel JSON back to one row per frequency.

    Each side contributes its first element; an empty side gives nulls. Messages
    that give no row are those of :func:`unreadable_channel_results`.
    """
    text = _channel_text(messages, data)
    sides = messages.select(F.explode(F.from_json(text, schemas.CHANNEL_JSON)))
    avg, cong = F.get(F.col("value.average"), 0), F.get(F.col("value.congestion"), 0)
    return sides.select(
        F.col("key").try_cast("double").alias("center_freq"),
        avg["value"].alias("average"),
        avg["start"].alias("avg_start"),
        avg["end"].alias("avg_end"),
        cong["value"].alias("congestion"),
        cong["start"].alias("cong_start"),
        cong["end"].alias("cong_end"),
    )
