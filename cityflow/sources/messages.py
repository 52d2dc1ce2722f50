"""Message streams (payload + string attributes), event time and repeat removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.functions.text import attribute
from cityflow.functions.time import event_time


def read_messages(
    spark: SparkSession, path: str, fmt: str = "json", streaming: bool = False, **options: str
) -> DataFrame:
    """Landed messages in the MESSAGE shape, as a batch or as a file stream."""
    reader = spark.readStream if streaming else spark.read
    return reader.format(fmt).schema(schemas.MESSAGE).options(**options).load(path)


def read_kafka_messages(
    spark: SparkSession, servers: str, topic: str, streaming: bool = True, **options: str
) -> DataFrame:
    """Broker messages in the MESSAGE shape; needs the Kafka connector on the classpath."""
    reader = spark.readStream if streaming else spark.read
    records = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("includeHeaders", "true")
        .options(**options)
        .load()
    )
    return from_kafka(records)


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka columns to MESSAGE columns; the last of repeated headers wins."""
    pairs = F.transform(
        F.coalesce(F.col("headers"), F.array()),
        lambda h: F.struct(h["key"].alias("key"), F.decode(h["value"], "UTF-8").alias("value")),
    )
    last = F.filter(
        pairs,
        lambda p, i: ~F.exists(
            F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["key"] == p["key"]
        ),
    )
    return records.select(
        F.col("value").alias("data"),
        F.map_from_entries(last).alias("attributes"),
        F.col("timestamp").alias("publish_time"),
    )


def with_event_time(
    messages: DataFrame,
    name: str | None = None,
    encoding: str = "rfc3339",
    watermark: str | None = "0 seconds",
) -> DataFrame:
    """Add ``ts`` from attribute ``name``, or from the publish time when none is named.

    A streaming frame also gets a watermark on ``ts``; the default allows no
    lateness, so late rows are dropped.
    """
    ts = F.col("publish_time") if name is None else event_time(attribute(name), encoding)
    out = messages.withColumn("ts", ts)
    return out.withWatermark("ts", watermark) if out.isStreaming and watermark else out


def drop_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep one row per message id.

    On a stream the memory of seen ids ends with the watermark.
    """
    return df.dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def drop_repeated_messages(messages: DataFrame, id_attribute: str = "id_str") -> DataFrame:
    """Repeat removal on a message attribute; messages without one are all kept.

    Those get a key of their own, so that the input is read once.
    """
    known = attribute(id_attribute)
    keyed = messages.withColumn("_id", known).withColumn("_own", F.when(known.isNull(), F.uuid()))
    return drop_repeats(keyed, ["_id", "_own"]).drop("_id", "_own")
