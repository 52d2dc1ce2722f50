"""Named queries over the driver's tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.functions import text, time
from cityflow.functions.stats import mean_or_nan
from cityflow.operators import (
    cluster,
    enrich,
    features,
    imaging,
    normalize,
    radio,
    relations,
    spectral,
    training,
    tweets,
    windows,
)
from cityflow.options import (
    FEATURES,
    TWEET_TUMBLE,
    WEATHER_FEATURES,
    Hop,
    MedoidModel,
    NormalizerBounds,
)
from cityflow.plans import dataflows, feeds, set_expansion
from cityflow.plans.named import ORACLES, QUERIES, query  # noqa: F401
from cityflow.session import run_dir
from cityflow.sources import archives, images, messages, payloads, sinks
from cityflow.sources.annotations import read_sentences
from cityflow.streaming.writers import append_csv, drain

# --------------------------------------------------------------------------- SQL building blocks

US = 1_000_000
DAY_STAMP = "'%Y-%m-%d %H:%M:%S'"


def hops(source: str, size: int, slide: int) -> str:
    """Rows of ``source`` copied to every window start ``s`` (microseconds) they fall into."""
    copies = -(-size // slide)
    return (
        f"SELECT * FROM (SELECT e.*, (epoch_us(ts) // {slide * US} - i) * {slide * US} AS s"
        f" FROM {source} e, (SELECT unnest(range(0, {copies})) AS i))"
        f" WHERE epoch_us(ts) < s + {size * US}"
    )


def stamp(micros: str) -> str:
    return f"strftime(make_timestamp({micros}), {DAY_STAMP})"


SAMPLES = "SELECT ts, 470e6 + 12500.0 * (user_id % 16) AS center_freq, value AS data FROM events"
LEVEL = "[0.0, 0.1, 0.1, 0.1, 0.2, 0.2, 0.4, 0.6, 0.8, 1.0]::DOUBLE[]"
CATEGORY = (
    "['Clear', 'Partly Cloudy', 'Mostly Cloudy', 'Breezy and Mostly Cloudy', 'Overcast',"
    " 'Breezy and Overcast', 'Drizzle', 'Light Rain', 'Rain', 'Heavy Rain']"
)
RECORDS = f"""SELECT ts,
  CASE WHEN event_type = 'view' THEN 1 END AS tweets,
  CASE WHEN event_type = 'purchase' THEN ({LEVEL})[user_id % 10 + 1] END AS precip,
  CASE WHEN event_type = 'purchase' THEN value END AS temp,
  CASE WHEN event_type = 'purchase' THEN (user_id % 9)::DOUBLE END AS uv,
  CASE WHEN event_type = 'purchase' THEN value / 10 END AS wind,
  CASE WHEN event_type = 'click' THEN value / 1000 END AS traffic
FROM events WHERE event_type IN ('view', 'purchase', 'click')"""
MEANS = """nullif(count(tweets), 0)::DOUBLE AS tweets, avg(precip) AS precip, avg(temp) AS temp,
  avg(uv) AS uv, avg(wind) AS wind, avg(traffic) AS traffic"""
VALID = "tweets IS NOT NULL AND uv IS NOT NULL AND traffic IS NOT NULL"
# Digits to which each mean is compared. Engines add in different orders, so the
# last bits differ; the digits reach far enough past those of the inputs that a
# mean does not fall halfway between two rounded values.
DIGITS = {"tweets": 9, "precip": 9, "temp": 9, "uv": 9, "wind": 10, "traffic": 11}
# Adding zero turns a negative zero positive.
ROUNDED = ", ".join(f"round({f}, {n}) + 0.0::DOUBLE AS {f}" for f, n in DIGITS.items())
NORM_ROUNDED = ", ".join(f"round({f}, 9) + 0.0::DOUBLE AS {f}" for f in FEATURES)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def rounded_means(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), n) for c, n in DIGITS.items()})


def window_start_ntz(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.col("window.start").cast("timestamp_ntz")).drop("window")


# --------------------------------------------------------------------------- radio channels

CHANNELS = f"""WITH samples AS ({SAMPLES}), w AS ({hops('samples', 60, 50)}),
stats AS (SELECT s, center_freq, round(avg(data), 6) AS channel_avg,
    sum(CASE WHEN data >= 50 THEN 1.0::DOUBLE END) AS congestion FROM w GROUP BY ALL)
"""
CHANNEL_ROWS = f"""{CHANNELS} SELECT {stamp('s')} AS "start", {stamp(f's + {60 * US}')} AS "end",
  center_freq, channel_avg, congestion FROM stats"""


def _channel_rows(stats: DataFrame) -> DataFrame:
    named = radio.with_bounds(rounded(stats, "channel_avg"))
    return named.select("start", "end", "center_freq", "channel_avg", "congestion")


@query(CHANNEL_ROWS)
def radio_channel_stats(spark, sf_dir):
    samples = feeds.radio_samples(feeds.events(spark, sf_dir))
    return _channel_rows(radio.channel_stats(samples, threshold=50))


@query(CHANNEL_ROWS)
def radio_channel_stats_join(spark, sf_dir):
    samples = feeds.radio_samples(feeds.events(spark, sf_dir))
    return _channel_rows(radio.channel_stats_joined(samples, threshold=50))


def _json_side(value: str) -> str:
    one = (
        f"""'[{{"value":' || {value}::VARCHAR || ',"start":"' || {stamp('s')}"""
        f""" || '","end":"' || {stamp(f's + {60 * US}')} || '"}}]'"""
    )
    return f"CASE WHEN {value} IS NULL THEN '[]' ELSE {one} END"


@query(f"""{CHANNELS} SELECT '{{"' || printf('%.1f', center_freq) || '":{{"congestion":'
  || {_json_side('congestion')} || ',"average":' || {_json_side('channel_avg')} || '}}}}' AS value
  FROM stats""")
def radio_json_out(spark, sf_dir):
    samples = feeds.radio_samples(feeds.events(spark, sf_dir))
    stats = rounded(radio.channel_stats(samples, threshold=50), "channel_avg")
    return radio.result_json(stats)


DECODED = f"""{CHANNELS} SELECT center_freq, channel_avg AS average, {stamp('s')} AS avg_start,
  {stamp(f's + {60 * US}')} AS avg_end, congestion,
  CASE WHEN congestion IS NOT NULL THEN {stamp('s')} END AS cong_start,
  CASE WHEN congestion IS NOT NULL THEN {stamp(f's + {60 * US}')} END AS cong_end FROM stats"""


@query(DECODED)
def radio_json_decode(spark, sf_dir):
    return payloads.decode_channel_results(radio_json_out(spark, sf_dir), "value")


@query("""SELECT CASE event_id % 7 WHEN 0 THEN 'bad json' WHEN 1 THEN 'no payload'
  WHEN 2 THEN 'no channel' ELSE 'read' END AS fault, count(*) AS n FROM events GROUP BY ALL""")
def radio_json_faults(spark, sf_dir):
    """Every published result is decoded or reported with a reason: the counts add up."""
    good = F.format_string('{"%d": {"average": [], "congestion": []}}', F.col("event_id"))
    kind = F.col("event_id") % 7
    sent = feeds.events(spark, sf_dir).select(
        F.when(kind == 0, F.substring(good, 1, 9))
        .when(kind == 1, F.lit(None))
        .when(kind == 2, F.lit("{}"))
        .otherwise(good)
        .alias("value")
    )
    read = payloads.decode_channel_results(sent, "value").select(F.lit("read").alias("fault"))
    faults = payloads.unreadable_channel_results(sent, "value").select("fault")
    return faults.union(read).groupBy("fault").agg(F.count(F.lit(1)).alias("n"))


def _parsed(spark, sf_dir):
    timed = messages.with_event_time(
        feeds.radio_messages(feeds.events(spark, sf_dir)), "timestamp", "rfc3339"
    )
    return radio.parse_samples(timed)


@query("""SELECT event_id, ts, strftime(ts, '%Y-%m-%d %H:%M:%S') AS localdatetime,
  470e6 + 12500.0 * (user_id % 16) AS center_freq, 2000000.0::DOUBLE AS sample_rate, value AS data
FROM events WHERE event_id % 77 <> 0 AND event_id % 50 <> 0""")
def radio_parse_messages(spark, sf_dir):
    good = radio.good_samples(_parsed(spark, sf_dir)).drop("publish_time")
    return good.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""SELECT CASE WHEN event_id % 77 = 0 THEN 'bad data' ELSE 'missing center_freq' END AS fault,
  count(*) AS n FROM events WHERE event_id % 77 = 0 OR event_id % 50 = 0 GROUP BY ALL""")
def radio_bad_samples(spark, sf_dir):
    bad = radio.bad_samples(_parsed(spark, sf_dir))
    return bad.groupBy("fault").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT strftime(make_timestamp(epoch_us(ts)), '%Y-%m-%d %H:%M:%S') AS localdatetime,
  470e6 + 12500.0 * (user_id % 16) AS center_freq, value AS data, 1.0::DOUBLE AS peak
FROM events WHERE value >= 50 AND event_id % 77 <> 0 AND event_id % 50 <> 0""")
def radio_peaks(spark, sf_dir):
    good = radio.good_samples(_parsed(spark, sf_dir))
    return radio.mark_peaks(radio.detect_signals(good, 50)).select(
        "localdatetime", "center_freq", "data", "peak"
    )


@query("""SELECT data.data, data.center_freq, data.localdatetime FROM (SELECT {
  'data': value, 'center_freq': 470e6 + 12500.0 * (user_id % 16),
  'localdatetime': strftime(ts, '%Y-%m-%d %H:%M:%S')} AS data FROM events
  WHERE event_id % 77 <> 0 AND event_id % 50 <> 0)""")
def radio_warehouse_rows(spark, sf_dir):
    nested = sinks.radio_table_rows(radio.good_samples(_parsed(spark, sf_dir)))
    return nested.select("data", "attribute.center_freq", "attribute.localdatetime")


def _sampler_sql(fn: str) -> str:
    return f"""SELECT make_timestamp(epoch_us(ts) // {600 * US} * {600 * US}) AS window_start,
  470e6 + 12500.0 * (user_id % 16) AS center_freq, round({fn}(value), 6) AS data
FROM events GROUP BY ALL"""


def _sampled(spark, sf_dir, attribute):
    samples = feeds.radio_samples(feeds.events(spark, sf_dir))
    sampled = radio.sample_channels(samples, Hop(600, 600), attribute)
    return window_start_ntz(rounded(sampled, "data"))


@query(_sampler_sql("avg"))
def radio_sampler_avg(spark, sf_dir):
    return _sampled(spark, sf_dir, "average")


@query(_sampler_sql("max"))
def radio_sampler_max(spark, sf_dir):
    return _sampled(spark, sf_dir, "max")


@query(_sampler_sql("min"))
def radio_sampler_min(spark, sf_dir):
    return _sampled(spark, sf_dir, "min")


@query("""SELECT user_id % 16 AS channel, coalesce(round(avg(CASE WHEN event_type = 'signup'
  AND value > 200 THEN value END), 6), -1) AS mean FROM events GROUP BY ALL""")
def channel_mean_or_nan(spark, sf_dir):
    chosen = F.when((F.col("event_type") == "signup") & (F.col("value") > 200), F.col("value"))
    grouped = feeds.events(spark, sf_dir).groupBy((F.col("user_id") % 16).alias("channel"))
    means = grouped.agg(mean_or_nan(chosen).alias("mean"))
    return means.withColumn("mean", F.round(F.nanvl("mean", F.lit(-1.0)), 6))


# --------------------------------------------------------------------------- training buckets

BUCKETS = f"""WITH rec AS ({RECORDS}),
training AS (SELECT left(strftime(ts, '%Y-%m-%d-%H-%M'), 15) AS bucket,
  nullif(count(tweets), 0)::DOUBLE AS tweets, round(avg(precip), 6) AS precip,
  round(avg(temp), 6) AS temp, round(avg(uv), 6) AS uv, round(avg(wind), 6) AS wind,
  round(avg(traffic), 11) AS traffic
  FROM rec GROUP BY ALL)
"""


def _archives(spark, sf_dir):
    ev = feeds.events(spark, sf_dir)
    return (
        archives.parse_tweet_lines(feeds.tweet_lines(ev)),
        archives.parse_traffic_lines(feeds.traffic_lines(ev)),
        archives.parse_weather_lines(feeds.weather_lines(ev), strict=True),
    )


def _training_rows(rows: DataFrame) -> DataFrame:
    counted = rows.withColumn("tweets", F.col("tweets").cast("double"))
    return rounded(counted, "traffic", digits=11)


@query(f"{BUCKETS} SELECT * FROM training")
def training_set(spark, sf_dir):
    return _training_rows(training.training_set(*_archives(spark, sf_dir)))


@query(f"{BUCKETS} SELECT * FROM training")
def training_set_join(spark, sf_dir):
    return _training_rows(training.training_set_joined(*_archives(spark, sf_dir)))


@query(f"""{BUCKETS} SELECT * FROM training WHERE tweets IS NOT NULL AND uv IS NOT NULL
  AND traffic IS NOT NULL""")
def training_complete(spark, sf_dir):
    return training.complete_rows(training_set(spark, sf_dir))


@query(f"{BUCKETS} SELECT " + ", ".join(
    f"{fn}({f})::DOUBLE AS {fn}_{f}" for f in FEATURES for fn in ("min", "max")
) + " FROM training WHERE tweets IS NOT NULL AND uv IS NOT NULL AND traffic IS NOT NULL")
def normalizer_bounds(spark, sf_dir):
    return normalize.fit_bounds(training_set(spark, sf_dir))


@query("""SELECT left(strftime(ts, '%Y-%m-%d-%H-%M'), 15) AS bucket, count(*) AS tweets
FROM events WHERE event_type = 'view' GROUP BY ALL""")
def archive_text_scan(spark, sf_dir):
    """Tweet lines written to text files and scanned back by glob."""
    out = run_dir(spark, "archive")
    feeds.tweet_lines(feeds.events(spark, sf_dir)).write.text(out)
    lines = archives.read_lines(spark, f"{out}/*.txt")
    return training.count_per_bucket(archives.parse_tweet_lines(lines))


@query("""SELECT strftime(ts, '%Y-%m-%d-%H-%M-%S') AS datetime,
  (user_id % 12)::INTEGER AS vehicles, (event_id % 5)::INTEGER AS people,
  ((user_id % 12) + (event_id % 5)) / 16.0::DOUBLE AS label,
  CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%a, ') ELSE '' END
    || strftime(ts, '%d %b %Y %H:%M:%S GMT') AS http_date,
  date_trunc('second', ts) AS taken FROM events""")
def camera_labels(spark, sf_dir):
    parsed = archives.parse_label_lines(feeds.label_lines(feeds.events(spark, sf_dir)))
    taken = time.event_time(F.col("http_date"), "http").cast("timestamp_ntz")
    return parsed.withColumns({"label": imaging.label_value(), "taken": taken})


@query("""SELECT round(avg(abs(p - y)), 6) AS mae, round(avg((p - y) * (p - y)), 6) AS mse
FROM (SELECT value / 500 AS p, ((user_id % 12) + (event_id % 5)) / 16.0::DOUBLE AS y FROM events)""")
def model_error(spark, sf_dir):
    labelled = feeds.events(spark, sf_dir).select(
        (F.col("value") / 500).alias("predict"),
        (F.col("user_id") % 12).alias("vehicles"),
        (F.col("event_id") % 5).alias("people"),
    )
    scored = labelled.withColumn("label", imaging.label_value())
    return rounded(imaging.model_error(scored), "mae", "mse")


@query("""SELECT CASE WHEN CAST('0x' || substr(md5('7:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT)
    / 4294967296.0::DOUBLE < 0.1 THEN 'test' ELSE 'train' END AS part, count(*) AS n
FROM events GROUP BY part""")
def train_test_counts(spark, sf_dir):
    parts = imaging.train_test_split(feeds.events(spark, sf_dir).select("event_id"), "event_id")
    named = [p.select(F.lit(n).alias("part")) for n, p in zip(("train", "test"), parts)]
    return named[0].unionByName(named[1]).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- city state

POINT_HOP = Hop(1800, 600)
POINT_BOUNDS = NormalizerBounds(window_minutes=30.0)

POINTS = f"""WITH rec AS ({RECORDS}), w AS ({hops('rec', 1800, 600)}),
points AS (SELECT s, {MEANS} FROM w GROUP BY s),
valid AS (SELECT * FROM points WHERE {VALID})"""
POINT_ROWS = f"{POINTS} SELECT make_timestamp(s) AS window_start, {ROUNDED} FROM valid"
NORMALISED = f"""{POINTS}, norm AS (SELECT s, (tweets * 10.0 / 30.0 - 320.0) / (1.0 - 320.0) AS tweets,
  precip, (temp - 44.035) / (76.665 - 44.035)::DOUBLE AS temp, uv / 8.0 AS uv,
  (wind - 0.23) / (19.605 - 0.23) AS wind,
  (traffic - 0.0362919) / (0.2750302 - 0.0362919) AS traffic FROM valid)"""


def _message_records(spark, sf_dir):
    ev = feeds.events(spark, sf_dir)
    timed = [
        messages.with_event_time(feed)
        for feed in (
            feeds.traffic_messages(ev), feeds.tweet_messages(ev), feeds.weather_messages(ev)
        )
    ]
    return features.merge_feeds(
        features.traffic_records(timed[0]),
        features.tweet_records(timed[1]),
        features.weather_records(timed[2], strict=True),
    )


def _records(spark, sf_dir):
    """All three feeds in one scan, where one table holds them."""
    return feeds.wide_records(feeds.events(spark, sf_dir))


@query(POINT_ROWS)
def feature_points(spark, sf_dir):
    points = features.feature_points(_records(spark, sf_dir), POINT_HOP)
    return window_start_ntz(rounded_means(points))


@query(POINT_ROWS)
def feature_points_long(spark, sf_dir):
    long = features.to_long(_message_records(spark, sf_dir))
    points = features.feature_points_long(long, POINT_HOP)
    return window_start_ntz(rounded_means(points))


@query(f"""WITH rec AS ({RECORDS}) SELECT * FROM (
  SELECT ts, 'traffic' AS key, traffic AS value FROM rec
  UNION ALL SELECT ts, 'tweets', tweets::DOUBLE FROM rec UNION ALL SELECT ts, 'precip', precip FROM rec
  UNION ALL SELECT ts, 'temp', temp FROM rec UNION ALL SELECT ts, 'uv', uv FROM rec
  UNION ALL SELECT ts, 'wind', wind FROM rec) WHERE value IS NOT NULL""")
def feature_records(spark, sf_dir):
    long = features.to_long(_message_records(spark, sf_dir))
    return long.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(f"{NORMALISED} SELECT make_timestamp(s) AS window_start, {NORM_ROUNDED} FROM norm")
def normalized_points(spark, sf_dir):
    points = features.feature_points(_records(spark, sf_dir), POINT_HOP)
    normalised = normalize.normalise_points(points, POINT_BOUNDS)
    return window_start_ntz(rounded(normalised, *FEATURES, digits=9))


_CENTERS = ", ".join(
    "sqrt(" + " + ".join(f"pow({f} - {c}, 2)" for f, c in zip(FEATURES, center)) + ")"
    for center in MedoidModel().centers
)


@query(f"""{NORMALISED}, dist AS (SELECT s, [{_CENTERS}] AS d FROM norm)
SELECT make_timestamp(s) AS window_start, (list_position(d, list_min(d)) - 1)::INTEGER AS cluster,
  len(list_filter(d, lambda x: x = list_min(d)))::INTEGER AS n_nearest FROM dist""")
def cluster_assign(spark, sf_dir):
    ev = feeds.events(spark, sf_dir)
    state = dataflows.city_state(
        feeds.traffic_messages(ev), feeds.tweet_messages(ev), feeds.weather_messages(ev),
        POINT_HOP, POINT_BOUNDS,
    )
    return window_start_ntz(state).select(
        "window_start", "cluster", F.size("clusters").alias("n_nearest")
    )


REWINDOW_HOP, REWINDOW_TUMBLE = Hop(2700, 300), Hop(3600, 3600)
REWINDOWED = f"""WITH rec AS ({RECORDS}), w AS ({hops('rec', 2700, 300)}),
hop AS (SELECT s, {MEANS} FROM w GROUP BY s),
points AS (SELECT (s + {2700 * US} - 1) // {3600 * US} * {3600 * US} AS s, avg(tweets) AS tweets,
  avg(precip) AS precip, avg(temp) AS temp, avg(uv) AS uv, avg(wind) AS wind,
  avg(traffic) AS traffic FROM hop GROUP BY ALL),
valid AS (SELECT * FROM points WHERE {VALID})"""


@query(f"{REWINDOWED} SELECT make_timestamp(s) AS window_start, {ROUNDED} FROM valid")
def rewindow_features(spark, sf_dir):
    points = features.rewindowed_points(_records(spark, sf_dir), REWINDOW_HOP, REWINDOW_TUMBLE)
    return window_start_ntz(rounded_means(points))


# --------------------------------------------------------------------------- tweets, payloads, time


@query(f"""SELECT make_timestamp(epoch_us(ts) // {5 * US} * {5 * US}) AS window_start, count(*) AS n
FROM events GROUP BY ALL""")
def tumbling_counts(spark, sf_dir):
    return window_start_ntz(windows.tumbling_counts(feeds.events(spark, sf_dir), TWEET_TUMBLE))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def dedup_events(spark, sf_dir):
    ev = feeds.events(spark, sf_dir)
    return messages.drop_repeats(ev.unionByName(ev), ["event_id"])


@query("""SELECT event_id::VARCHAR AS id_str, props AS text FROM events WHERE event_type = 'view'""")
def dedup_messages(spark, sf_dir):
    sent = feeds.tweet_messages(feeds.events(spark, sf_dir))
    once = messages.drop_repeated_messages(sent.unionByName(sent))
    return once.select(
        text.attribute("id_str").alias("id_str"), text.payload_text().alias("text")
    )


@query("""SELECT make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts, user_id::VARCHAR AS author, props AS text,
  3 AS n_attributes FROM events WHERE event_type = 'view'""")
def tweet_flatten(spark, sf_dir):
    flat = dataflows.tweet_stream(feeds.tweet_messages(feeds.events(spark, sf_dir)))
    author = F.filter("attributes", lambda a: a["key"] == "author_id_str")[0]["value"]
    return flat.select(
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        author.alias("author"),
        "text",
        F.size("attributes").alias("n_attributes"),
    )


@query("""SELECT props AS payload, octet_length(encode(props))::INTEGER AS n_bytes
FROM events WHERE event_type = 'view'""")
def tweet_payload(spark, sf_dir):
    flat = dataflows.tweet_stream(feeds.tweet_messages(feeds.events(spark, sf_dir)))
    value = sinks.to_payload(flat)
    return value.select(
        F.decode("value", "UTF-8").alias("payload"), F.octet_length("value").alias("n_bytes")
    )


@query("""SELECT conv_id || '-' || turn AS id_str,
  make_timestamp((1556000000000 + conv_id * 60000 + turn * 1000) * 1000) AS ts,
  text, CASE WHEN turn % 2 = 1 THEN 'full' ELSE role END AS hashtag, conv_id::VARCHAR AS author
FROM conversations""")
def tweet_normalise(spark, sf_dir):
    raw = feeds.tweet_json(feeds.table(spark, sf_dir, "conversations"))
    flat = payloads.normalise_tweets(payloads.parse_tweets(raw))
    return flat.select(
        "id_str",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        "text",
        F.col("hashtags")[0].alias("hashtag"),
        F.col("author_id_str").alias("author"),
    )


TWEETED = "make_timestamp((1556000000000 + conv_id * 60000 + turn * 1000) * 1000)"


def _flat_tweets(spark, sf_dir):
    raw = feeds.tweet_json(feeds.table(spark, sf_dir, "conversations"))
    return payloads.normalise_tweets(payloads.parse_tweets(raw))


@query(f"""SELECT date_trunc('hour', {TWEETED})::TIMESTAMP AS hour, count(*) AS n
FROM conversations GROUP BY ALL""")
def tweet_hourly_volume(spark, sf_dir):
    volume = tweets.hourly_volume(_flat_tweets(spark, sf_dir))
    return volume.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query(f"""SELECT hour({TWEETED})::INTEGER AS hour_of_day, count(*) AS n,
  round(count(*)::DOUBLE / sum(count(*)) OVER (), 9) AS share FROM conversations GROUP BY 1""")
def tweet_hour_of_day(spark, sf_dir):
    return tweets.hour_of_day_volume(_flat_tweets(spark, sf_dir))


@query("""SELECT CASE WHEN turn % 2 = 1 THEN 'full' ELSE lower(role) END AS hashtag, count(*) AS n
FROM conversations GROUP BY ALL ORDER BY n DESC, hashtag LIMIT 20""")
def tweet_top_hashtags(spark, sf_dir):
    return tweets.top_hashtags(_flat_tweets(spark, sf_dir))


@query("""SELECT role AS source, count(*) AS n, count(DISTINCT conv_id) AS authors
FROM conversations GROUP BY ALL""")
def tweet_devices(spark, sf_dir):
    return tweets.device_counts(_flat_tweets(spark, sf_dir))


@query("""SELECT conv_id || '-' || turn AS id_str FROM (
  SELECT conv_id, turn, -74.0 + (conv_id % 10) * 0.01::DOUBLE AS lon,
    40.78 + (turn % 10) * 0.01::DOUBLE AS lat FROM conversations)
WHERE lon <= -73.952234 AND lon + 0.01::DOUBLE >= -73.964927
  AND lat <= 40.818940 AND lat + 0.01::DOUBLE >= 40.807030""")
def geo_place(spark, sf_dir):
    raw = feeds.tweet_json(feeds.table(spark, sf_dir, "conversations"))
    flat = payloads.normalise_tweets(payloads.parse_tweets(raw))
    return tweets.near_city(flat).select("id_str")


@query("""SELECT event_id FROM (SELECT event_id, -74.0 + (user_id % 100) * 0.001::DOUBLE AS lon,
  40.8 + (event_id % 50) * 0.001::DOUBLE AS lat FROM events)
WHERE lon BETWEEN -73.964927 AND -73.952234 AND lat BETWEEN 40.807030 AND 40.818940""")
def geo_box(spark, sf_dir):
    lon = F.lit(-74.0) + (F.col("user_id") % 100) * 0.001
    lat = F.lit(40.8) + (F.col("event_id") % 50) * 0.001
    return feeds.events(spark, sf_dir).filter(tweets.in_box(lon, lat)).select("event_id")


@query("""SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events""")
def props_json(spark, sf_dir):
    k = F.from_json("props", "k LONG")["k"]
    return feeds.events(spark, sf_dir).select("event_id", k.alias("k"))


@query(f"""SELECT event_id, make_timestamp(epoch_us(ts) // {US} * {US}) AS ts,
  ({CATEGORY})[user_id % 10 + 1] AS summary, value AS temp, (user_id % 9)::DOUBLE AS uv,
  round(value / 10, 6) AS wind FROM events WHERE event_type = 'purchase'""")
def weather_payload(spark, sf_dir):
    raw = feeds.weather_payloads(feeds.events(spark, sf_dir))
    now = rounded(payloads.parse_weather(raw), "wind")
    return now.select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "summary", "temp", "uv", "wind"
    )


@query("""SELECT event_id, unnest(range(ts, ts + INTERVAL 600 SECOND, INTERVAL 10 SECOND)) AS ts
FROM events WHERE event_type = 'signup'""")
def upsample(spark, sf_dir):
    signups = feeds.of_type(feeds.events(spark, sf_dir), "signup")
    return signups.select("event_id", F.explode(time.repeats("ts")).alias("ts"))


@query("""SELECT event_id, strftime(ts - INTERVAL 4 HOUR, '%Y-%m-%d-%H-%M-%S') AS local FROM events""")
def local_time_fixed(spark, sf_dir):
    local = F.date_format(time.local_time(F.col("ts"), "fixed"), time.SECOND_STAMP)
    return feeds.events(spark, sf_dir).select("event_id", local.alias("local"))


@query("""SELECT o_orderkey, strftime(timezone('America/New_York', timezone('UTC', o_orderdate
  + INTERVAL 6 HOUR)), '%Y-%m-%d %H:%M:%S') AS local FROM orders""")
def local_time_zone(spark, sf_dir):
    """Order dates run over many years, so both sides of daylight saving occur."""
    six = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(6))
    local = F.date_format(time.local_time(six, "zone"), time.STAMP)
    return feeds.table(spark, sf_dir, "orders").select("o_orderkey", local.alias("local"))


@query("""SELECT event_id, make_timestamp(epoch_us(ts)) AS rfc3339,
  make_timestamp(epoch_us(ts) // 1000 * 1000) AS epoch_ms, date_trunc('second', ts) AS epoch_s,
  date_trunc('minute', ts) AS minute, date_trunc('second', ts) AS second,
  date_trunc('second', ts) AS stamp FROM events""")
def timestamp_encodings(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    encoded = {
        "rfc3339": F.date_format(ts, feeds.RFC3339),
        "epoch_ms": F.unix_millis(ts).cast("string"),
        "epoch_s": F.unix_seconds(ts).cast("string"),
        "minute": F.date_format(ts, time.MINUTE_STAMP),
        "second": F.date_format(ts, time.SECOND_STAMP),
        "stamp": F.date_format(ts, time.STAMP),
    }
    return feeds.events(spark, sf_dir).select(
        "event_id",
        *[time.event_time(v, k).cast("timestamp_ntz").alias(k) for k, v in encoded.items()],
    )


@query("""SELECT event_id, '689' AS camera FROM events WHERE event_type <> 'error'""")
def fetched_only(spark, sf_dir):
    fetches = feeds.events(spark, sf_dir).select(
        "event_id",
        F.lit("689").alias("camera"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
    )
    return images.only_fetched(fetches).drop("status")


# --------------------------------------------------------------------------- enrichment


def _quantities(spark, sf_dir):
    return feeds.table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity")


def _parts(spark, sf_dir):
    return feeds.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_size"
    )


JOINED = """SELECT count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_quantity >= 25 AND l_quantity >= 35"""


@query(JOINED)
def selective_join(spark, sf_dir):
    joined = enrich.filter_after_join(
        _quantities(spark, sf_dir), _parts(spark, sf_dir), "l_partkey", "l_quantity",
        before=0.5, after=0.3, max_level=50,
    )
    return enrich.count_rows(joined)


@query(JOINED)
def selective_join_pushed(spark, sf_dir):
    joined = enrich.filter_before_join(
        _quantities(spark, sf_dir), _parts(spark, sf_dir), "l_partkey", "l_quantity",
        before=0.5, after=0.3, max_level=50,
    )
    return enrich.count_rows(joined)


@query("""SELECT l_partkey, l_quantity, p_name, p_size FROM lineitem JOIN part
ON l_partkey = p_partkey WHERE l_quantity >= 25""")
def enriched_lines(spark, sf_dir):
    kept = _quantities(spark, sf_dir).filter(enrich.selected(F.col("l_quantity"), 0.5, 50))
    return enrich.enrich(kept, _parts(spark, sf_dir), "l_partkey", on_missing="fail")


@query("""SELECT l_partkey, l_quantity, p_name, p_size FROM lineitem JOIN part
ON l_partkey = p_partkey WHERE l_quantity >= 25""")
def enriched_lines_salted(spark, sf_dir):
    kept = _quantities(spark, sf_dir).filter(enrich.selected(F.col("l_quantity"), 0.5, 50))
    return enrich.enrich(kept, _parts(spark, sf_dir), "l_partkey", salt=8)


STEPS = (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)


@query("""WITH joined AS (SELECT l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT round(1.0 - s, 1)::DOUBLE AS selectivity,
  (SELECT count(*) FROM joined WHERE l_quantity >= 50 - bound) AS tuples
FROM (VALUES (1.0, 50), (0.9, 45), (0.8, 40), (0.7, 35), (0.6, 30), (0.5, 25), (0.4, 20), (0.3, 15),
  (0.2, 10), (0.1, 5)) AS steps(s, bound)""")
def selectivity_sweep(spark, sf_dir):
    return enrich.selectivity_sweep(
        _quantities(spark, sf_dir), _parts(spark, sf_dir), "l_partkey", "l_quantity", STEPS, 50
    )


@query("""SELECT l_partkey AS id, l_quantity::INTEGER AS vital, p_name AS name FROM lineitem
JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 25""")
def vitals_csv_join(spark, sf_dir):
    """Vitals and records written as headerless CSV and scanned back with declared types."""
    out = run_dir(spark, "vitals")
    _quantities(spark, sf_dir).select(
        "l_partkey", F.col("l_quantity").cast("int").alias("vital")
    ).write.csv(f"{out}/vitals")
    feeds.table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.col("p_size").alias("year"), F.lit("f").alias("gender")
    ).write.csv(f"{out}/patients")
    kept = archives.read_vitals(spark, f"{out}/vitals").filter(
        enrich.selected(F.col("vital"), 0.5, 50)
    )
    patients = archives.read_patients(spark, f"{out}/patients")
    return enrich.enrich(kept, patients, "id").select("id", "vital", "name")


# --------------------------------------------------------------------------- scaling and clusters


@query("""SELECT p_partkey, round(p_size / (SELECT max(p_size) FROM part)::DOUBLE, 6) AS p_size,
  round(p_retailprice / (SELECT max(p_retailprice) FROM part), 6) AS p_retailprice FROM part""")
def max_scale(spark, sf_dir):
    part = feeds.table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    scaled = normalize.max_scale(part, ["p_size", "p_retailprice"])
    return rounded(scaled, "p_size", "p_retailprice")


@query(f"""WITH t AS (SELECT strftime(ts, '%Y-%m-%d-%H-%M-%S') AS localdatetime,
  ({LEVEL})[user_id % 10 + 1] AS precip, value AS temp, (user_id % 9)::DOUBLE AS uv,
  value / 10 AS wind FROM events WHERE event_type = 'purchase')
SELECT localdatetime, round(precip / (SELECT max(precip) FROM t), 6) AS precip,
  round(temp / (SELECT max(temp) FROM t), 6) AS temp, round(uv / (SELECT max(uv) FROM t), 6) AS uv,
  round(wind / (SELECT max(wind) FROM t), 6) AS wind FROM t""")
def weather_csv_scale(spark, sf_dir):
    """The weather table written as CSV with a header, scanned back, mapped and scaled."""
    out = run_dir(spark, "weather")
    feeds.weather_table(feeds.events(spark, sf_dir)).write.option("header", True).csv(out)
    rows = cluster.weather_training_rows(
        archives.read_weather_table(spark, out), keep=("localdatetime",)
    )
    scaled = normalize.max_scale(rows, WEATHER_FEATURES)
    return rounded(scaled, *WEATHER_FEATURES)


@query()
def weather_kmeans(spark, sf_dir):
    rows = cluster.weather_training_rows(feeds.weather_table(feeds.events(spark, sf_dir)))
    _, _, centers = cluster.fit_weather_clusters(rows)
    return centers


@query()
def training_medoids(spark, sf_dir):
    """Seven medoids of the normalised training buckets."""
    complete = training.complete_rows(training_set(spark, sf_dir))
    points = normalize.normalise_points(complete, NormalizerBounds(window_minutes=10.0))
    medoids = cluster.fit_medoids(points)
    rows = [(i, *m) for i, m in enumerate(medoids)]
    return spark.createDataFrame(rows, "cluster INT, " + ", ".join(f"{f} DOUBLE" for f in FEATURES))


# --------------------------------------------------------------------------- relations

TAGS = {"R": relations.PERSON, "A": relations.LOCATION, "N": relations.ORGANIZATION}
TAG_COUNTS = """WITH c AS (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS p,
  count(*) FILTER (l_returnflag = 'A') AS l, count(*) FILTER (l_returnflag = 'N') AS o
  FROM lineitem GROUP BY l_orderkey)"""


def _tags(spark, sf_dir):
    tag = F.lit(None).cast("string")
    for flag, name in TAGS.items():
        tag = F.when(F.col("l_returnflag") == flag, F.lit(name)).otherwise(tag)
    return feeds.table(spark, sf_dir, "lineitem").select("l_orderkey", tag.alias("tag"))


@query(f"""{TAG_COUNTS} SELECT l_orderkey, p AS "n_PERSON", l AS "n_LOCATION" FROM c
WHERE p >= 1 AND l >= 1""")
def sentence_filter(spark, sf_dir):
    kind = relations.KINDS["Live_In"]
    return relations.candidate_groups(_tags(spark, sf_dir), ["l_orderkey"], "tag", kind)


@query(f"""{TAG_COUNTS} SELECT l_orderkey, l AS "n_LOCATION" FROM c WHERE l >= 2""")
def sentence_filter_located(spark, sf_dir):
    kind = relations.KINDS["Located_In"]
    return relations.candidate_groups(_tags(spark, sf_dir), ["l_orderkey"], "tag", kind)


@query(f"""{TAG_COUNTS} SELECT l_orderkey, o AS "n_ORGANIZATION", p AS "n_PERSON" FROM c
WHERE o >= 1 AND p >= 1""")
def sentence_filter_work_for(spark, sf_dir):
    kind = relations.KINDS["Work_For"]
    return relations.candidate_groups(_tags(spark, sf_dir), ["l_orderkey"], "tag", kind)


def _sentences(spark, sf_dir, page="order"):
    return feeds.annotated_sentences(feeds.table(spark, sf_dir, "lineitem"), page)


SENTENCE_ID = "(l_linenumber::BIGINT * 1000000000000000 + l_partkey * 10000000 + l_suppkey)"
RELATIONS = f"""WITH rel AS (SELECT 'order/' || l_orderkey AS url, l_orderkey AS page_order,
  {SENTENCE_ID} AS sent_id, 'Supplier' || l_suppkey AS value1, 'Part' || l_partkey AS value2,
  l_discount * 10 AS confidence FROM lineitem WHERE l_returnflag <> 'A')"""
BEST = f"""{RELATIONS},
page AS (SELECT url, page_order, value1, value2, max(confidence) AS confidence,
  min(sent_id) AS sent_id FROM rel GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY value1, value2
    ORDER BY confidence DESC, page_order, sent_id) AS best,
  row_number() OVER (PARTITION BY value1, value2 ORDER BY page_order, sent_id) AS seen FROM page),
x AS (SELECT value1, value2, max(confidence) AS confidence, max(url) FILTER (best = 1) AS url,
  max(page_order) FILTER (seen = 1) AS page_order, max(sent_id) FILTER (seen = 1) AS sent_id
  FROM ranked GROUP BY value1, value2)"""


@query(f"""SELECT 'order/' || l_orderkey AS url, {SENTENCE_ID} AS sent_id,
  'Supplier' || l_suppkey || ' makes Part' || l_partkey AS sentence FROM lineitem""")
def sentence_text(spark, sf_dir):
    kind = relations.KINDS["OrgBased_In"]
    kept = relations.candidate_sentences(_sentences(spark, sf_dir), kind)
    return kept.select("url", "sent_id", relations.sentence_text().alias("sentence"))


def _extracted(spark, sf_dir, page="order"):
    kind = relations.KINDS["OrgBased_In"]
    kept = relations.candidate_sentences(_sentences(spark, sf_dir, page), kind)
    return relations.extract_relations(kept, kind)


def _flat(rel: DataFrame) -> DataFrame:
    return rel.select(
        "url", "page_order", "sent_id",
        F.col("e1.value").alias("value1"), F.col("e2.value").alias("value2"), "confidence",
    )


@query(f"{RELATIONS} SELECT * FROM rel")
def relation_extract(spark, sf_dir):
    return _flat(_extracted(spark, sf_dir))


@query(f"{BEST} SELECT * FROM x")
def relation_dedup(spark, sf_dir):
    return _flat(relations.dedup_relations(_extracted(spark, sf_dir)))


@query(f"""{BEST} SELECT * FROM x WHERE confidence > 0.5
ORDER BY confidence DESC, page_order, sent_id LIMIT 50""")
def relation_topk(spark, sf_dir):
    best = _flat(relations.dedup_relations(_extracted(spark, sf_dir)))
    return relations.top_relations(best, 0.5, 50, ["page_order", "sent_id"])


@query(f"""{BEST} SELECT value1, value2, confidence FROM x WHERE (lower(value1), lower(value2)) NOT IN
  (SELECT (lower('Supplier' || l_suppkey), lower('Part' || l_partkey)) FROM lineitem
   WHERE l_returnflag = 'R')
ORDER BY confidence DESC, page_order, sent_id LIMIT 1""")
def next_query(spark, sf_dir):
    best = _flat(relations.dedup_relations(_extracted(spark, sf_dir)))
    used = feeds.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(
        F.concat(F.lit("SUPPLIER"), F.col("l_suppkey").cast("string")).alias("value1"),
        F.concat(F.lit("PART"), F.col("l_partkey").cast("string")).alias("value2"),
    )
    picked = relations.next_query(best, used, order=["page_order", "sent_id"])
    return picked.select("value1", "value2", "confidence")


@query("""SELECT p_partkey, p_name, p_brand FROM part p WHERE NOT EXISTS (SELECT 1 FROM part u
  WHERE u.p_size > 25 AND u.p_name = p.p_name AND u.p_brand = p.p_brand)""")
def unseen_pairs(spark, sf_dir):
    part = feeds.table(spark, sf_dir, "part")
    seen = part.filter("p_size > 25").select(
        F.upper("p_name").alias("p_name"), F.upper("p_brand").alias("p_brand")
    )
    fresh = relations.unseen(part, seen, ["p_name", "p_brand"], ignore_case=True)
    return fresh.select("p_partkey", "p_name", "p_brand")


@query("SELECT DISTINCT url FROM pages")
def distinct_urls(spark, sf_dir):
    pages = feeds.table(spark, sf_dir, "pages").select("url")
    return pages.unionByName(pages).dropDuplicates()


@query(f"{RELATIONS} SELECT value1, value2, confidence, sent_id FROM rel")
def sentences_xml_scan(spark, sf_dir):
    """Annotated sentences written as compressed XML and scanned back, a file after so many sentences.

    As plain text the XML is forty times the size of the table. A compressed file
    has one split, so the number of files follows the number of sentences. Level 3
    takes a third of the usual level's time and 1.3 times its bytes.
    """
    out = run_dir(spark, "sentences")
    xml = _sentences(spark, sf_dir).select(feeds.sentence_xml().alias("value"))
    written = xml.write.option("maxRecordsPerFile", 100_000).option("zlib.compress.level", "THREE")
    written.text(out, compression="gzip")
    kind = relations.KINDS["OrgBased_In"]
    found = relations.extract_relations(read_sentences(spark, out), kind)
    return _flat(found).select("value1", "value2", "confidence", "sent_id")


def _expansion_sql(rounds: int = 5, hits: int = 10, k: int = 30, patience: int = 4) -> str:
    """The loop unrolled: a round without a query finds nothing, and so do those after it."""
    steps = [f"""WITH line AS MATERIALIZED (SELECT 'line/' || l_orderkey || '/' || {SENTENCE_ID} AS url,
  {SENTENCE_ID} AS sent_id, 'Supplier' || l_suppkey AS value1, 'Part' || l_partkey AS value2,
  l_discount * 10 AS confidence, l_returnflag FROM lineitem),
q1 AS (SELECT 'Supplier1' AS value1, 'Part1' AS value2),
pages0 AS (SELECT NULL::VARCHAR AS url, 0::BIGINT AS page_order WHERE false)"""]
    for i in range(1, rounds + 1):
        used = " UNION ALL ".join(f"SELECT value1, value2 FROM q{j}" for j in range(2, i + 1))
        unused = f"(value1, value2) NOT IN ({used})" if used else "true"
        idle = " + ".join(f"(SELECT (count(*) = 0)::INTEGER FROM rel{j})" for j in range(1, i + 1))
        steps.append(f"""found{i} AS MATERIALIZED (SELECT url, (l.value1 = q.value1)::INTEGER + (l.value2 = q.value2)::INTEGER AS matched
  FROM line l, q{i} q WHERE l.value1 = q.value1 OR l.value2 = q.value2 ORDER BY matched DESC, url LIMIT {hits}),
fresh{i} AS MATERIALIZED (SELECT url, (SELECT count(*) FROM pages{i - 1}) + row_number() OVER (ORDER BY matched DESC, url) - 1
  AS page_order FROM found{i} WHERE url NOT IN (SELECT url FROM pages{i - 1})),
pages{i} AS MATERIALIZED (SELECT * FROM pages{i - 1} UNION ALL SELECT * FROM fresh{i}),
rel{i} AS MATERIALIZED (SELECT line.*, page_order FROM fresh{i} JOIN line USING (url) WHERE l_returnflag <> 'A'),
best{i} AS MATERIALIZED (SELECT value1, value2, max(confidence) AS confidence,
  (list(url ORDER BY confidence DESC, page_order, sent_id))[1] AS url, min(page_order) AS page_order,
  (list(sent_id ORDER BY page_order, sent_id))[1] AS sent_id
  FROM ({" UNION ALL ".join(f"SELECT * FROM rel{j}" for j in range(1, i + 1))}) GROUP BY value1, value2),
q{i + 1} AS MATERIALIZED (SELECT value1, value2 FROM best{i} WHERE EXISTS (SELECT 1 FROM q{i})
  AND (SELECT count(*) FROM best{i} WHERE confidence > 0.5) < {k} AND {idle} < {patience}
  AND NOT (contains('supplier1 part1', lower(value1)) AND contains('supplier1 part1', lower(value2))) AND {unused}
  ORDER BY confidence DESC, page_order, sent_id LIMIT 1)""")
    return ",\n".join(steps) + f"\nSELECT url, page_order, sent_id, value1, value2, confidence FROM best{rounds}"


@query(_expansion_sql())
def expanded_relations(spark, sf_dir):
    """Set expansion over all order lines, one page each, from one seed."""
    lines = feeds.table(spark, sf_dir, "lineitem")
    result = set_expansion.expand(
        feeds.line_pages(lines), _sentences(spark, sf_dir, "line"),
        seed="Supplier1 Part1", kind=relations.KINDS["OrgBased_In"], threshold=0.5, k=30,
    )
    return _flat(result.relations)


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _page_text_sql() -> str:
    out = "html"
    for pattern in text.MARKUP:
        out = f"regexp_replace({out}, {_sql_text(pattern)}, ' ', 'g')"
    for name, char in text.NAMED_REFERENCES:
        out = f"regexp_replace({out}, '&{name};?', {_sql_text(char)}, 'g')"
    return (
        f"SELECT page_id, trim(regexp_replace({out}, '[ \\t\\r\\n]+', ' ', 'g')) AS text FROM pages"
    )


@query(_page_text_sql())
def page_text(spark, sf_dir):
    pages = feeds.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.page_text(F.col("html")).alias("text"))


# --------------------------------------------------------------------------- images and spectra


@query("""SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 60 OFFSET 40""")
def sorted_slice(spark, sf_dir):
    part = feeds.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return imaging.sorted_slice(part, ["p_name", "p_partkey"], 40, 100)


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d-%H-%M') AS localdatetime FROM events""")
def image_stamps(spark, sf_dir):
    name = F.concat(F.lit("689-"), F.date_format("ts", time.SECOND_STAMP), F.lit(".jpg"))
    return feeds.events(spark, sf_dir).select(
        "event_id", images.image_stamp(name).alias("localdatetime")
    )


def _as_image(df: DataFrame) -> DataFrame:
    return df.select(F.struct("origin", "height", "width", "nChannels", "data").alias("image"))


@query("""SELECT '689' AS camera, vec_id::VARCHAR AS localdatetime, 8 AS height, 8 AS width
FROM embeddings""")
def image_metadata(spark, sf_dir):
    tiny = feeds.tiny_images(feeds.table(spark, sf_dir, "embeddings"))
    return images.image_metadata(_as_image(tiny))


_PIXELS = ", ".join(f"p[{(1 + r) * 8 + 1 + c + 1}]" for r in (0, 2, 4) for c in (0, 2, 4))


@query(f"""WITH px AS (SELECT vec_id, list_transform(embedding, lambda v:
  floor(least(greatest(v::DOUBLE + 0.5::DOUBLE, 0.0::DOUBLE), 0.996::DOUBLE) * 256)) AS p
  FROM embeddings)
SELECT '689-' || vec_id AS origin, round(list_sum([{_PIXELS}]) / 9 / 255, 4) AS predict FROM px""")
def image_scores(spark, sf_dir):
    tiny = feeds.tiny_images(feeds.table(spark, sf_dir, "embeddings"))
    scored = imaging.score_images(
        _as_image(tiny), feeds.mean_brightness, crop=(1, 1, 6, 6), size=(3, 3)
    )
    return rounded(scored, "predict", digits=4)


_ANGLE = "2 * pi() * i / 63"
_TAPER = (
    f"(0.35875 - 0.48829 * cos({_ANGLE}) + 0.14128 * cos(2 * {_ANGLE}) - 0.01168 * cos(3 * {_ANGLE}))"
)


@query(f"""WITH taper AS (SELECT i, {_TAPER} AS w FROM range(64) t(i)),
x AS (SELECT vec_id, i, embedding[i + 1]::DOUBLE * w AS x FROM embeddings, taper),
f AS (SELECT vec_id, k, sum(x * cos(2 * pi() * k * i / 64)) AS re,
  sum(x * sin(2 * pi() * k * i / 64)) AS im FROM x, range(64) b(k) GROUP BY ALL)
SELECT vec_id, ((k + 32) % 64)::INTEGER AS bin,
  round(10 * log10(greatest(re * re + im * im, 1e-18)), 4) + 0.0::DOUBLE AS power FROM f""")
def spectral_power(spark, sf_dir):
    frames = feeds.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("re")
    )
    spectra = spectral.power_spectrum(frames, "re", None)
    bins = spectra.select("vec_id", F.posexplode("power").alias("bin", "power"))
    return rounded(bins, "power", digits=4)


# --------------------------------------------------------------------------- streams
#
# A file stream never closes the windows that end after its last event, so the
# SQL side keeps those the watermark has passed.

LAST_EVENT = "(SELECT max(epoch_ms(ts)) * 1000 FROM events)"
LAST_FEED = """(SELECT min(last) FROM (SELECT max(epoch_ms(ts)) * 1000 AS last FROM events
  WHERE event_type IN ('view', 'purchase', 'click') GROUP BY event_type))"""


def _sample_stream(spark, sf_dir):
    stream = feeds.radio_samples(feeds.event_stream(spark, sf_dir))
    return stream.withWatermark("ts", "0 seconds")


@query(f"{CHANNEL_ROWS} WHERE s + {60 * US} <= {LAST_EVENT}")
def radio_stream_stats(spark, sf_dir):
    stats = radio.channel_stats(_sample_stream(spark, sf_dir), threshold=50)
    return _channel_rows(drain(stats, "radio-stats"))


@query(f"{DECODED} WHERE s + {60 * US} <= {LAST_EVENT}")
def radio_csv_log(spark, sf_dir):
    """Published results subscribed to, decoded and appended to CSV files."""
    out = run_dir(spark, "csv-log")
    published = radio.result_json(radio.channel_stats(_sample_stream(spark, sf_dir), threshold=50))
    decoded = payloads.decode_channel_results(published, "value")
    append_csv(decoded, out, trigger={"availableNow": True}).awaitTermination()
    log = spark.read.schema(decoded.schema).option("header", True).csv(out)
    return rounded(log, "average")


@query(f"{CHANNEL_ROWS} WHERE s + {60 * US} <= {LAST_EVENT}")
def radio_stream_join(spark, sf_dir):
    stats = radio.channel_stats_joined(_sample_stream(spark, sf_dir), threshold=50)
    return _channel_rows(drain(stats, "radio-join"))


def _message_streams(spark, sf_dir):
    ev = feeds.event_stream(spark, sf_dir)
    return feeds.traffic_messages(ev), feeds.tweet_messages(ev), feeds.weather_messages(ev)


@query(f"""{NORMALISED}, dist AS (SELECT s, [{_CENTERS}] AS d FROM norm)
SELECT make_timestamp(s) AS window_start, (list_position(d, list_min(d)) - 1)::INTEGER AS cluster
FROM dist WHERE s + {1800 * US} <= {LAST_FEED}""")
def city_state_stream(spark, sf_dir):
    state = dataflows.city_state(*_message_streams(spark, sf_dir), POINT_HOP, POINT_BOUNDS)
    return window_start_ntz(drain(state, "city-state")).select("window_start", "cluster")


@query(f"""{REWINDOWED}, norm AS (SELECT s, (tweets * 10.0 / 45.0 - 320.0) / (1.0 - 320.0) AS tweets,
  precip, (temp - 44.035) / (76.665 - 44.035) AS temp, uv / 8.0 AS uv,
  (wind - 0.23) / (19.605 - 0.23) AS wind,
  (traffic - 0.0362919) / (0.2750302 - 0.0362919) AS traffic FROM valid)
SELECT make_timestamp(s) AS window_start, {NORM_ROUNDED} FROM norm
WHERE s + {3600 * US} <= {LAST_FEED}""")
def rewindow_stream(spark, sf_dir):
    state = dataflows.city_state_rewindowed(
        *_message_streams(spark, sf_dir), REWINDOW_HOP, REWINDOW_TUMBLE,
        NormalizerBounds(window_minutes=45.0),
    )
    points = drain(state.drop("clusters", "cluster"), "rewindow")
    return window_start_ntz(rounded(points, *FEATURES, digits=9))


@query(f"""SELECT make_timestamp(s) AS window_start, count(*) AS n FROM (
  SELECT epoch_us(ts) // {5 * US} * {5 * US} AS s FROM events WHERE event_type = 'view')
WHERE s + {5 * US} <= (SELECT max(epoch_ms(ts)) * 1000 FROM events WHERE event_type = 'view')
GROUP BY ALL""")
def tweet_stream_counts(spark, sf_dir):
    """Every tweet is sent twice; repeats are dropped before counting."""
    sent = feeds.tweet_messages(feeds.event_stream(spark, sf_dir))
    counts = dataflows.tweet_window_counts(sent.unionByName(sent))
    return window_start_ntz(drain(counts, "tweet-counts"))


@query("""SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def dedup_stream(spark, sf_dir):
    ev = feeds.event_stream(spark, sf_dir)
    twice = ev.unionByName(ev).withWatermark("ts", "10 minutes")
    once = drain(messages.drop_repeats(twice, ["event_id"]), "dedup")
    return once.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# These register queries of their own, built with the names above.
from cityflow.plans import analysis_queries, image_queries, sink_queries, stream_queries  # noqa: E402, F401
