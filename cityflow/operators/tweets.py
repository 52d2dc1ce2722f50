"""Tweet stream: geographic boxes and message flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.functions.text import payload_text
from cityflow.options import CITY_BOX_EXTENDED


def in_box(lon: Column, lat: Column, box: Sequence[float] = CITY_BOX_EXTENDED) -> Column:
    """Point inside ``(sw_lon, sw_lat, ne_lon, ne_lat)``, edges included."""
    west, south, east, north = map(F.lit, box)
    return lon.between(west, east) & lat.between(south, north)


def place_overlaps_box(polygon: Column, box: Sequence[float] = CITY_BOX_EXTENDED) -> Column:
    """Bounding polygon of a place (rings of ``[lon, lat]``) overlapping the box.

    Upstream feeds match on the place, so a matching tweet's own point may lie outside.
    """
    west, south, east, north = map(F.lit, box)
    corners = F.flatten(polygon)
    lons, lats = F.transform(corners, lambda p: p[0]), F.transform(corners, lambda p: p[1])
    return (
        (F.array_min(lons) <= east)
        & (F.array_max(lons) >= west)
        & (F.array_min(lats) <= north)
        & (F.array_max(lats) >= south)
    )


def near_city(tweets: DataFrame, box: Sequence[float] = CITY_BOX_EXTENDED) -> DataFrame:
    """Flat tweets whose exact point lies in the box or, lacking one, whose place overlaps it."""
    point = F.col("coordinates")
    by_point = in_box(F.get(point, 0), F.get(point, 1), box)
    by_place = place_overlaps_box(F.col("place_bounding_box_coordinates"), box)
    return tweets.filter(F.when(point.isNotNull(), by_point).otherwise(by_place))


def flatten_messages(messages: DataFrame) -> DataFrame:
    """Messages with event time to ``(ts, attributes as a list, text)``."""
    return messages.select(
        "ts", F.map_entries("attributes").alias("attributes"), payload_text().alias("text")
    )


def hourly_volume(tweets: DataFrame) -> DataFrame:
    """``hour, n`` of flat tweets; those without a time are counted under a null hour."""
    return tweets.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )


def hour_of_day_volume(tweets: DataFrame) -> DataFrame:
    """``hour_of_day, n, share`` over the 24 hours of the day; hours without tweets have no row."""
    counted = tweets.where("ts IS NOT NULL").groupBy(F.hour("ts").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("share", F.round(F.col("n") / total, 9))


def top_hashtags(tweets: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` hashtags in most tweets, case aside; of equals the first by name.

    A tag repeated within a tweet counts once.
    """
    tags = F.array_distinct(F.transform("hashtags", F.lower))
    counted = tweets.select(F.explode(tags).alias("hashtag")).groupBy("hashtag").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.orderBy(F.desc("n"), "hashtag").limit(k)


def device_counts(tweets: DataFrame) -> DataFrame:
    """``source, n, authors``: tweets and different authors per sending device."""
    return tweets.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("author_id_str").alias("authors")
    )
