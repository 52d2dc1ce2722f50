"""The dataflows, end to end: messages or archives in, results out.

Each takes frames (batch or streaming) and returns a frame; reading and writing
stay with `cityflow.sources` and `cityflow.streaming`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.operators import cluster, features, imaging, normalize, radio, training, tweets
from cityflow.options import (
    FEATURE_HOP,
    FEATURE_HOP_LONG,
    PEAK_THRESHOLD,
    POINT_TUMBLE,
    RADIO_HOP,
    TWEET_TUMBLE,
    Hop,
    NormalizerBounds,
)
from cityflow.operators.windows import tumbling_counts
from cityflow.sources import archives, images
from cityflow.sources.messages import drop_repeated_messages, with_event_time


def radio_channel_results(
    messages: DataFrame,
    threshold: float = PEAK_THRESHOLD,
    hop: Hop = RADIO_HOP,
    watermark: str = "0 seconds",
) -> DataFrame:
    """Radio messages to one JSON document per window and frequency.

    Unusable samples are left out here; `radio.bad_samples` gives them to a
    quarantine sink.
    """
    timed = with_event_time(messages, "timestamp", "rfc3339", watermark)
    samples = radio.good_samples(radio.parse_samples(timed))
    return radio.result_json(radio.channel_stats(samples, threshold, hop))


def _records(
    traffic: DataFrame, tweet_feed: DataFrame, weather: DataFrame, watermark: str
) -> DataFrame:
    """Three message feeds, timed by publication, as one frame of wide records.

    On a stream each feed keeps its own watermark and the slowest one decides,
    so an idle feed holds results back rather than losing them
    (``spark.sql.streaming.multipleWatermarkPolicy=min``).
    """

    def timed(feed):
        return with_event_time(feed, watermark=watermark)

    return features.merge_feeds(
        features.traffic_records(timed(traffic)),
        features.tweet_records(timed(tweet_feed)),
        features.weather_records(timed(weather)),
    )


def city_state(
    traffic: DataFrame,
    tweet_feed: DataFrame,
    weather: DataFrame,
    hop: Hop = FEATURE_HOP,
    bounds: NormalizerBounds | None = None,
    centers=None,
    watermark: str = "0 seconds",
    paned: bool | None = None,
) -> DataFrame:
    """Feature point, normalised point and nearest cluster per hopping window."""
    records = _records(traffic, tweet_feed, weather, watermark)
    points = features.feature_points(records, hop, paned)
    return cluster.assign_clusters(normalize.normalise_points(points, bounds), centers)


def city_state_rewindowed(
    traffic: DataFrame,
    tweet_feed: DataFrame,
    weather: DataFrame,
    hop: Hop = FEATURE_HOP_LONG,
    tumble: Hop = POINT_TUMBLE,
    bounds: NormalizerBounds | None = None,
    centers=None,
    watermark: str = "0 seconds",
) -> DataFrame:
    """The two-level variant: hopping results averaged per tumbling window."""
    records = _records(traffic, tweet_feed, weather, watermark)
    points = features.rewindowed_points(records, hop, tumble)
    return cluster.assign_clusters(normalize.normalise_points(points, bounds), centers)


def training_set_from_archives(
    spark: SparkSession, tweet_glob: str, traffic_glob: str, weather_glob: str
) -> DataFrame:
    """Three text archives to one row per ten-minute bucket."""
    return training.training_set(
        archives.parse_tweet_lines(archives.read_lines(spark, tweet_glob)),
        archives.parse_traffic_lines(archives.read_lines(spark, traffic_glob)),
        archives.parse_weather_lines(archives.read_lines(spark, weather_glob)),
    )


def tweet_stream(messages: DataFrame, watermark: str = "0 seconds") -> DataFrame:
    """Tweets in event time, flattened to time, attributes and text."""
    return tweets.flatten_messages(with_event_time(messages, "timestamp_ms", "epoch_ms", watermark))


def tweet_window_counts(
    messages: DataFrame, tumble: Hop = TWEET_TUMBLE, watermark: str = "0 seconds"
) -> DataFrame:
    """Tweets without repeats, counted per tumbling window."""
    timed = with_event_time(messages, "timestamp_ms", "epoch_ms", watermark)
    return tumbling_counts(drop_repeated_messages(timed), tumble)


def image_slice(
    spark: SparkSession, path: str, first: int | None = None, last: int | None = None,
    pattern: str = images.IMAGE_FILES,
) -> list[str]:
    """Paths of a folder's image files from place ``first`` to ``last`` in order of name.

    The listing is sorted and sliced by Spark; what comes to the driver are the
    chosen paths, no more than the reader's own file index holds.
    """
    listing = images.read_manifest(spark, path, pattern, recursive=False)
    named = listing.select(images.file_name(F.col("path")).alias("name"), "path")
    return [r.path for r in imaging.sorted_slice(named, ["name"], first, last).select("path").collect()]


def score_image_folder(
    spark: SparkSession, path: str, load_model, first: int | None = None, last: int | None = None,
    **options,
) -> DataFrame:
    """Images of a folder, optionally a slice in name order, to ``localdatetime, predict, fault``.

    The slice is taken on the listing of the folder's image files, in order of
    name; either end may be open. Only the chosen files are opened. A file that
    cannot be decoded keeps its row, without a score and with the fault.
    """
    frames = images.read_images_checked(spark, image_slice(spark, path, first, last))
    scored = imaging.score_images(frames.where("fault IS NULL"), load_model, **options)
    failed = frames.where("fault IS NOT NULL").select("image.origin", F.lit(None).cast("double"), "fault")
    stamp = images.image_stamp(images.file_name(F.col("origin"))).alias("localdatetime")
    return scored.withColumn("fault", F.lit(None).cast("string")).union(failed).select(
        stamp, "predict", "fault"
    )
