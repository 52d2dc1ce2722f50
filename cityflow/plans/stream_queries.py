"""Named queries over streams that arrive in several deliveries.

Each lands the events table in parts, in a folder in the shared place, and runs
its query once per part (or over several small batches) from one checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.operators import enrich, features, windows
from cityflow.options import Hop
from cityflow.plans import dataflows, feeds
from cityflow.plans.named import query
from cityflow.plans.registry import DECODED, LAST_EVENT, SAMPLES, US, rounded, window_start_ntz
from cityflow.session import run_dir
from cityflow.sources import messages, payloads, sinks
from cityflow.streaming import writers

DELIVERIES = 5
LATENESS = "10 minutes"

#: An event comes in the part of the time range it lies in; every seventh one part
#: later, every eleventh two parts later.
DELIVERY_SQL = f"""least({DELIVERIES - 1}, (epoch_us(ts) - lo) * {DELIVERIES} // (hi - lo + 1)
  + CASE WHEN event_id % 11 = 0 THEN 2 WHEN event_id % 7 = 0 THEN 1 ELSE 0 END)"""


def _numbered(spark: SparkSession, sf_dir: str, ordered: bool) -> DataFrame:
    """The events with the number of their delivery."""
    ev = feeds.events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    micros = F.unix_micros("ts")
    span = ev.agg(F.min(micros).alias("lo"), F.max(micros).alias("hi"))
    part = F.call_function("div", (micros - F.col("lo")) * DELIVERIES, F.col("hi") - F.col("lo") + 1)
    if not ordered:
        delay = F.when(F.col("event_id") % 11 == 0, 2).when(F.col("event_id") % 7 == 0, 1).otherwise(0)
        part = F.least(F.lit(DELIVERIES - 1), part + delay)
    # one row of bounds
    return ev.crossJoin(F.broadcast(span)).withColumn("delivery", part.cast("int")).drop("lo", "hi")


def deliveries(spark: SparkSession, sf_dir: str, ordered: bool = True):
    """Functions that land one part of the events each, and the stream over the landing folder."""
    folder = run_dir(spark, "landing")
    numbered = _numbered(spark, sf_dir, ordered)
    schema = numbered.drop("delivery").schema

    def land(i: int):
        return lambda: numbered.where(F.col("delivery") == i).drop("delivery").write.mode("append").parquet(folder)

    return [land(i) for i in range(DELIVERIES)], lambda: spark.readStream.schema(schema).parquet(folder)


@query(f"""WITH bounds AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
sent AS (SELECT event_id, epoch_us(ts) AS t, {DELIVERY_SQL} AS delivery FROM events, bounds),
ends AS (SELECT d.delivery, (SELECT max(t // 1000) * 1000 FROM sent s WHERE s.delivery < d.delivery) - {600 * US} AS mark
  FROM (SELECT DISTINCT delivery FROM sent) d),
judged AS (SELECT t, mark IS NOT NULL AND t <= mark AS late FROM sent JOIN ends USING (delivery))
SELECT 'kept' AS kind, make_timestamp(s) AS window_start, count(*) AS n
FROM (SELECT t // {300 * US} * {300 * US} AS s FROM judged WHERE NOT late)
WHERE s + {300 * US} <= (SELECT max(t // 1000) * 1000 FROM sent) - {600 * US} GROUP BY ALL
UNION ALL SELECT 'late', NULL, count(*) FROM judged WHERE late""")
def late_rows_stream(spark, sf_dir):
    """Counts per window of what came in time, and how many rows the watermark dropped."""
    land, stream = deliveries(spark, sf_dir, ordered=False)

    def counted():
        timed = stream().withWatermark("ts", LATENESS)
        once = messages.drop_repeats(timed, ["event_id"])
        return windows.tumbling_counts(once, Hop(300, 300))

    done = writers.drain_deliveries(spark, land, counted, "late-rows")
    kept = window_start_ntz(done.rows).select(F.lit("kept").alias("kind"), "window_start", "n")
    late = spark.createDataFrame([("late", None, done.late_rows)], "kind STRING, window_start TIMESTAMP_NTZ, n LONG")
    return kept.union(late)


@query(f"""WITH w AS (SELECT user_id % 16 AS channel, epoch_us(ts) // {600 * US} * {600 * US} AS s, value FROM events)
SELECT make_timestamp(s) AS window_start, channel, count(*) AS n, round(avg(value), 6) AS mean, max(value) AS most
FROM w GROUP BY ALL""")
def early_results_stream(spark, sf_dir):
    """Windows as they stand after every batch, upserted: after the last they equal those of a batch job."""
    land, stream = deliveries(spark, sf_dir)
    checkpoint = run_dir(spark, "early-results")
    upserts = None
    for deliver in land:
        deliver()
        timed = stream().withWatermark("ts", LATENESS)
        stats = timed.groupBy(F.window("ts", "10 minutes"), (F.col("user_id") % 16).alias("channel")).agg(
            F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.max("value").alias("most")
        )
        upserts = upserts or writers.Upserts(spark, stats.schema, ["window", "channel"])
        with writers.state_parts(spark):
            run = writers.early_results(stats, upserts, checkpoint=checkpoint, trigger={"availableNow": True})
        run.awaitTermination()
    return window_start_ntz(rounded(upserts.current(), "mean"))


@query("""SELECT event_id, user_id, c_name AS name, c_mktsegment AS segment,
  CASE WHEN c_custkey IS NULL THEN 'no record' END AS fault
FROM events LEFT JOIN customer ON c_custkey = user_id AND c_custkey % 10 <> 3""")
def enriched_stream(spark, sf_dir):
    """Events joined with customer records as they arrive; a tenth of the records is missing."""
    land, stream = deliveries(spark, sf_dir)
    customers = feeds.table(spark, sf_dir, "customer").where("c_custkey % 10 <> 3").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )

    def joined():
        ids = stream().select("event_id", "user_id")
        return enrich.enrich_or_fault(ids, customers, "user_id", salt=4)

    done = writers.drain_deliveries(spark, land, joined, "enriched")
    return done.rows.select("event_id", "user_id", "name", "segment", "fault")


@query("""SELECT event_id, value AS data, strftime(ts, '%Y-%m-%d %H:%M:%S') AS localdatetime,
  470e6 + 12500.0 * (user_id % 16) AS center_freq
FROM events WHERE ts::DATE >= (SELECT max(ts)::DATE FROM events) - 1""")
def warehouse_stream(spark, sf_dir):
    """Samples appended to a nested table by day, the query restarted after each delivery; two days read back."""
    land, stream = deliveries(spark, sf_dir)
    path, checkpoint = run_dir(spark, "warehouse"), run_dir(spark, "warehouse-checkpoint")
    table = "rf_" + path.rsplit("-", 1)[1]
    for deliver in [*land, lambda: None]:  # the last start finds nothing new
        deliver()
        samples = stream().select(
            "event_id", F.col("value").alias("data"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("localdatetime"),
            feeds.center_freq().alias("center_freq"), F.lit(2e6).alias("sample_rate"), F.to_date("ts").alias("day"),
        )
        rows = sinks.radio_table_rows(samples, keep=("event_id", "day"))
        writers.append_table(rows, table, checkpoint, {"availableNow": True}, ["day"], path).awaitTermination()
    stored = spark.table(table)
    last = stored.agg(F.max("day")).first()[0]
    recent = stored.where(F.col("day") >= F.date_sub(F.lit(last), 1)) if last else stored
    return recent.select("event_id", "data", "attribute.localdatetime", "attribute.center_freq")


READABLE = DECODED.replace(SAMPLES, f"{SAMPLES} WHERE event_id % 77 <> 0 AND event_id % 50 <> 0")


@query(f"{READABLE} WHERE s + {60 * US} <= {LAST_EVENT}")
def radio_results_from_messages(spark, sf_dir):
    """The radio dataflow end to end: messages with bad samples in, published JSON out, decoded."""
    sent = feeds.radio_messages(feeds.event_stream(spark, sf_dir))
    published = writers.drain(dataflows.radio_channel_results(sent, threshold=50), "radio-results")
    return rounded(payloads.decode_channel_results(published, "value"), "average")


@query("""WITH sent AS (SELECT CASE event_type WHEN 'click' THEN 'traffic' WHEN 'view' THEN 'tweets' ELSE 'weather' END AS feed,
  event_id FROM events WHERE event_type IN ('click', 'view', 'purchase')),
judged AS (SELECT feed, CASE
  WHEN feed = 'traffic' THEN CASE WHEN event_id % 13 = 0 THEN 'missing cnn_output' WHEN event_id % 7 = 0 THEN 'unreadable cnn_output' END
  WHEN feed = 'tweets' THEN CASE WHEN event_id % 13 = 0 THEN 'no time' END
  ELSE nullif(concat_ws(', ', CASE WHEN event_id % 13 = 0 THEN 'missing temp' END,
    CASE WHEN event_id % 7 = 0 THEN 'unknown summary' END), '') END AS fault FROM sent)
SELECT feed, fault, count(*) AS n FROM judged WHERE fault IS NOT NULL GROUP BY ALL""")
def feed_faults(spark, sf_dir):
    """Messages of the three feeds that lose their time or a value, each with what is wrong."""
    ev = feeds.events(spark, sf_dir)
    thirteenth, seventh = F.col("event_id") % 13 == 0, F.col("event_id") % 7 == 0

    def with_attribute(sent, name, value):
        others = F.map_filter("attributes", lambda k, v: k != name)
        extra = F.when(value.isNull(), F.map_from_arrays(F.array(), F.array()).cast("map<string,string>")).otherwise(
            F.create_map(F.lit(name), value))
        return sent.withColumn("attributes", F.map_concat(others, extra))

    old = lambda name: F.col("attributes")[name]
    traffic = with_attribute(
        feeds.traffic_messages(ev), "cnn_output",
        F.when(thirteenth, F.lit(None).cast("string")).when(seventh, F.lit("n/a")).otherwise(old("cnn_output")),
    )
    sent = with_attribute(
        feeds.tweet_messages(ev), "timestamp_ms", F.when(thirteenth, F.lit("soon")).otherwise(old("timestamp_ms"))
    )
    weather = with_attribute(
        feeds.weather_messages(ev), "temp", F.when(thirteenth, F.lit(None).cast("string")).otherwise(old("temp"))
    )
    weather = with_attribute(weather, "summary", F.when(seventh, F.lit("Fog of a kind")).otherwise(old("summary")))
    found = [
        features.feed_faults(messages.with_event_time(m, *how), feed).select(F.lit(feed).alias("feed"), "fault")
        for feed, m, how in (
            ("traffic", traffic, ()), ("tweets", sent, ("timestamp_ms", "epoch_ms")), ("weather", weather, ()),
        )
    ]
    return found[0].union(found[1]).union(found[2]).groupBy("feed", "fault").agg(F.count(F.lit(1)).alias("n"))
