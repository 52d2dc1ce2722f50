import math
import random
from collections import defaultdict
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from cityflow.operators import cluster, features, normalize
from cityflow.options import FEATURES, Bounds, Hop, MedoidModel, NormalizerBounds
from cityflow.plans import dataflows
from cityflow.sources.messages import read_messages
from cityflow.streaming.writers import drain, early_results
from frames import rows

EPOCH = datetime(1970, 1, 1)


def records(spark, *values):
    """``(second, feature, value)`` triples as wide records."""
    cells = ", ".join(f"{f} DOUBLE" for f in FEATURES)
    wide = [(s, *[v if f == name else None for f in FEATURES]) for s, name, v in values]
    frame = spark.createDataFrame(wide, f"s LONG, {cells}")
    return frame.select(F.timestamp_seconds("s").alias("ts"), *FEATURES)


def random_values(n=300, seed=5, span=600):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        second, feed = rng.randrange(span), rng.choice(("tweets", "traffic", "weather"))
        names = ("precip", "temp", "uv", "wind") if feed == "weather" else (feed,)
        out += [(second, name, 1.0 if name == "tweets" else float(rng.randrange(64)))
                for name in names]
    return out


def hop_means(values, size, slide):
    """Brute force: window start -> feature -> count of tweets or mean of the rest."""
    groups = defaultdict(lambda: defaultdict(list))
    for second, name, v in values:
        start = second // slide * slide
        while start > second - size:
            groups[start][name].append(v)
            start -= slide
    return {
        start: {k: float(len(v)) if k == "tweets" else sum(v) / len(v) for k, v in by.items()}
        for start, by in groups.items()
    }


def valid(point):
    return {"tweets", "uv", "traffic"} <= set(point)


def as_dict(points):
    return {
        int(r.window.start.replace(tzinfo=timezone.utc).timestamp()): tuple(r[f] for f in FEATURES)
        for r in points.collect()
    }


def close(a, b):
    return a.keys() == b.keys() and all(
        x == y or math.isclose(x, y, rel_tol=1e-12) for k in a for x, y in zip(a[k], b[k])
    )


@pytest.mark.parametrize("size, slide", [(30, 10), (45, 5), (60, 60)])
def test_points_match_brute_force(spark, size, slide):
    values = random_values()
    expected = {s: tuple(p.get(f) for f in FEATURES)
                for s, p in hop_means(values, size, slide).items() if valid(p)}
    frame = records(spark, *values)
    for paned in (False, True):
        assert close(as_dict(features.feature_points(frame, Hop(size, slide), paned)), expected)
    long = features.to_long(frame)
    assert close(as_dict(features.feature_points_long(long, Hop(size, slide))), expected)


def test_rewindowed_points_are_means_of_hop_results(spark):
    values = random_values(200)
    outer = defaultdict(lambda: defaultdict(list))
    for start, point in hop_means(values, 45, 5).items():
        closing = start + 45 - 1  # the last instant of the hop, in whole seconds
        for name, v in point.items():
            outer[closing // 60 * 60][name].append(v)
    expected = {
        s: tuple(sum(p[f]) / len(p[f]) if f in p else None for f in FEATURES)
        for s, p in outer.items() if valid(p)
    }
    got = as_dict(features.rewindowed_points(records(spark, *values)))
    assert close(got, expected)


def test_weather_is_tested_by_uv_only(spark):
    r = records(spark, (1, "tweets", 1.0), (2, "traffic", 0.5), (3, "uv", 2.0))
    point = features.feature_points(r, Hop(60, 60)).first()
    assert (point.tweets, point.temp, point.uv) == (1.0, None, 2.0)
    for missing in FEATURES:
        if missing in ("tweets", "uv", "traffic"):
            rest = records(spark, *[(1, f, 1.0) for f in FEATURES if f != missing])
            assert features.feature_points(rest, Hop(60, 60)).count() == 0


def test_long_form_of_one_weather_message(spark, message):
    m = message(("i", {"summary": "Drizzle", "temp": "51.5", "uv": "3", "wind": "4"},
                 "2019-01-01 00:00:00")).withColumnRenamed("publish_time", "ts")
    long = features.to_long(features.weather_records(m))
    assert rows(long, "key", "value") == [
        ("precip", 0.4), ("temp", 51.5), ("uv", 3.0), ("wind", 4.0),
    ]


def points(spark, *values):
    return spark.createDataFrame(list(values), ", ".join(f"{f} DOUBLE" for f in FEATURES))


def test_normalisation_runs_downwards_for_tweets_and_never_clamps(spark):
    p = points(spark, (16.0, 0.4, 44.035, 8.0, 19.605, 0.0), (0.05, 0.0, 80.0, 0.0, 0.23, 0.5))
    a, b = normalize.normalise_points(p).collect()
    assert (a.tweets, a.precip, a.temp, a.uv, a.wind) == (0.0, 0.4, 0.0, 1.0, 1.0)
    assert a.traffic < 0 and b.temp > 1 and b.tweets == pytest.approx(1.0)
    up = NormalizerBounds(invert=False, window_minutes=10.0)
    assert normalize.normalise_points(points(spark, (320.0, 0.0, 50.0, 0.0, 1.0, 0.1)), up).first()[
        "tweets"
    ] == pytest.approx(1.0)


def test_bounds_are_fitted_on_complete_rows(spark):
    p = points(spark, (1.0, 0.1, 50.0, 1.0, 2.0, 0.1), (9.0, 0.2, 60.0, 2.0, 3.0, 0.3),
               (None, 0.2, 99.0, 2.0, 3.0, 0.3))
    fitted = normalize.bounds_from_row(normalize.fit_bounds(p).first())
    assert fitted.temp == Bounds(50.0, 60.0) and fitted.tweets == Bounds(1.0, 9.0)
    assert fitted.precip == Bounds(0.0, 1.0)


def test_max_scale(spark):
    frame = spark.createDataFrame([(1, 2.0, 0), (4, 8.0, 0)], "a INT, b DOUBLE, c INT")
    assert rows(normalize.max_scale(frame, ["a", "b", "c"])) == [
        (0.25, 0.25, None), (1.0, 1.0, None),
    ]


def test_every_medoid_is_its_own_cluster(spark):
    got = cluster.assign_clusters(points(spark, *MedoidModel().centers))
    assert [r.cluster for r in got.collect()] == list(range(7))


def test_ties_are_kept(spark):
    frame = spark.createDataFrame([(0.0, 0.0)], "x DOUBLE, y DOUBLE")
    got = cluster.assign_clusters(frame, [(1.0, 0.0), (5.0, 5.0), (0.0, -1.0)], ["x", "y"]).first()
    assert got.clusters == [0, 2] and got.cluster == 0


def test_assignment_is_minimal(spark):
    rng = random.Random(2)
    data = [tuple(rng.random() for _ in FEATURES) for _ in range(50)]
    centers = MedoidModel().centers
    for r in cluster.assign_clusters(points(spark, *data)).collect():
        dist = [math.dist([r[f] for f in FEATURES], c) for c in centers]
        assert dist[r.cluster] == pytest.approx(min(dist))


def test_medoids_match_brute_force(spark):
    rng = random.Random(4)
    data = [(gx + rng.random(), gy + rng.random()) for gx, gy in ((0, 0), (9, 0), (0, 9))
            for _ in range(15)]
    frame = spark.createDataFrame(data, "x DOUBLE, y DOUBLE")
    got = cluster.fit_medoids(frame, k=3, columns=["x", "y"])
    groups = [data[:15], data[15:30], data[30:]]
    best = [min(g, key=lambda m: sum(math.dist(m, p) ** 2 for p in g)) for g in groups]
    assert sorted(got) == sorted(best)


def test_medoids_with_repeated_rows(spark):
    frame = spark.createDataFrame([(0.0, 0.0)] * 5 + [(9.0, 9.0)] * 5, "x DOUBLE, y DOUBLE")
    assert cluster.fit_medoids(frame, k=2, columns=["x", "y"]) == [(0.0, 0.0), (9.0, 9.0)]


def test_weather_clusters(spark):
    rng = random.Random(8)
    weather = spark.createDataFrame(
        [(s, float(rng.randrange(40, 80)), float(rng.randrange(9)), rng.random() * 20)
         for s in ("Clear", "Rain", "Overcast") for _ in range(40)],
        "precip STRING, temp DOUBLE, uv DOUBLE, wind DOUBLE",
    )
    numbers = cluster.weather_training_rows(weather)
    model, predicted, centers = cluster.fit_weather_clusters(numbers)
    assert predicted.count() == 120 and centers.count() == 6
    tops = {c: numbers.agg(F.max(c)).first()[0] for c in numbers.columns}
    for i, row in enumerate(centers.orderBy("cluster").collect()):
        expected = [round(c * tops[n], 1) for c, n in zip(model.clusterCenters()[i], numbers.columns)]
        assert list(row[1:]) == pytest.approx(expected, abs=0.051)
    again = cluster.fit_weather_clusters(numbers)[0]
    assert [list(c) for c in again.clusterCenters()] == [list(c) for c in model.clusterCenters()]


def feeds(message, n=120, seed=6):
    """Three message feeds over ten minutes."""
    rng = random.Random(seed)

    def at():
        return f"2019-01-01 00:{rng.randrange(10):02d}:{rng.randrange(60):02d}"

    traffic = [("s", {"cnn_output": str(rng.randrange(8) / 8)}, at()) for _ in range(n)]
    tweets = [("t", {}, at()) for _ in range(n)]
    weather = [("i", {"summary": "Rain", "temp": str(rng.randrange(64)), "uv": "2", "wind": "1"},
                at()) for _ in range(n)]
    return traffic, tweets, weather


@pytest.mark.parametrize("dataflow", [dataflows.city_state, dataflows.city_state_rewindowed])
def test_city_state_stream_equals_batch(spark, message, tmp_path, dataflow):
    kinds = feeds(message)
    batch = dataflow(*[message(*rows_) for rows_ in kinds])
    late = [("s", {"cnn_output": "0"}, "2030-01-01 00:00:00"), ("t", {}, "2030-01-01 00:00:00"),
            ("i", {"summary": "Rain", "temp": "0", "uv": "0", "wind": "0"}, "2030-01-01 00:00:00")]
    streams = []
    for name, rows_, sentinel in zip(("traffic", "tweets", "weather"), kinds, late):
        path = str(tmp_path / name)
        message(*rows_, sentinel).coalesce(1).write.json(path)
        streams.append(read_messages(spark, path, streaming=True))
    streamed = drain(dataflow(*streams), "state")

    def flat(df):
        return {r.window.start: (tuple(round(r[f], 9) for f in FEATURES), r.cluster)
                for r in df.collect()}

    assert flat(streamed) == flat(batch) and batch.count() > 5


def test_early_city_state_in_update_mode(spark, message, tmp_path):
    kinds = feeds(message)
    streams = []
    for name, rows_ in zip(("traffic", "tweets", "weather"), kinds):
        path = str(tmp_path / name)
        message(*rows_).coalesce(1).write.json(path)
        streams.append(read_messages(spark, path, streaming=True))
    seen = {}

    def upsert(batch, _):
        seen.update({r.window.start: r.cluster for r in batch.collect()})

    query = early_results(dataflows.city_state(*streams, paned=False), upsert, every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    batch = dataflows.city_state(*[message(*rows_) for rows_ in kinds])
    assert seen == {r.window.start: r.cluster for r in batch.collect()}


def test_tweet_counts_stream(spark, message, tmp_path):
    sent = [("t", {"id_str": str(i), "timestamp_ms": str(1_556_000_000_000 + 700 * i)},
             "2019-01-01 00:00:00") for i in range(40)]
    sentinel = ("t", {"id_str": "z", "timestamp_ms": "1900000000000"}, "2019-01-01 00:00:00")
    path = str(tmp_path / "tweets")
    message(*sent, *sent, sentinel).coalesce(1).write.json(path)
    streamed = drain(
        dataflows.tweet_window_counts(read_messages(spark, path, streaming=True)), "tweets"
    )
    batch = dataflows.tweet_window_counts(message(*sent))
    assert rows(streamed) == rows(batch)
    assert batch.agg(F.sum("n")).first()[0] == 40
    flat = dataflows.tweet_stream(message(sent[0])).first()
    assert flat.text == "t" and {e.key for e in flat.attributes} == {"id_str", "timestamp_ms"}


def test_rows_late_for_a_pane_but_not_for_a_window_are_kept(spark, tmp_path):
    """Four micro-batches out of order: direct, default and batch agree on the open window."""
    from pyspark.sql import functions as F

    from cityflow.operators.windows import Count, hopping
    from cityflow.streaming.writers import drain

    for k, second in enumerate((12, 13, 3, 600)):
        stamp = spark.range(1).select(F.timestamp_seconds(F.lit(second)).alias("ts"))
        stamp.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{k}")
    read = spark.readStream.schema("ts TIMESTAMP").option("maxFilesPerTrigger", 1)
    stream = read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in").withWatermark("ts", "0 seconds")
    measures = {"n": Count(F.col("ts"))}
    found = {}
    for paned in (None, False):
        counted = hopping(stream, Hop(30, 10), [], measures, paned=paned)
        rows_of = drain(counted, f"late-{paned}").collect()
        found[paned] = {r.window.start.second + 60 * r.window.start.minute: r.n for r in rows_of}
    assert found[None] == found[False] and found[None][0] == 3


def test_a_folder_of_files_streams_whole(spark, tmp_path):
    from cityflow.plans import feeds
    from cityflow.streaming.writers import drain

    source = "/root/testdata/sf0.001/events.parquet"
    spark.read.parquet(source).repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    whole = drain(feeds.event_stream(spark, str(tmp_path)), "folder")
    assert whole.count() == spark.read.parquet(source).count()


def test_faults_of_feeds_are_named(message):
    from cityflow.sources.messages import with_event_time

    at = "2019-04-01T10:00:00Z"
    weather = message(
        (None, {"temp": "51.5", "uv": "2", "wind": "3", "summary": "Rain"}, at),
        (None, {"temp": "warm", "uv": "2", "summary": "Sleet"}, at),
        (None, {"temp": "1", "uv": "2", "wind": "3", "summary": "Clear"}, None),
    )
    got = [r.fault for r in features.feed_faults(with_event_time(weather), "weather").collect()]
    assert sorted(got) == ["no time", "unreadable temp, missing wind, unknown summary"]
    tweets = message((None, {"timestamp_ms": "soon"}, at), (None, {"timestamp_ms": "1554112800000"}, at))
    assert features.feed_faults(with_event_time(tweets, "timestamp_ms", "epoch_ms"), "tweets").count() == 1
