import json
import random

import pytest
from pyspark.sql import functions as F

from cityflow.operators import radio
from cityflow.operators.windows import Count, Mean, Total, hopping
from cityflow.options import Hop
from cityflow.plans.dataflows import radio_channel_results
from cityflow.sources.messages import read_messages, with_event_time
from cityflow.sources.payloads import decode_channel_results
from cityflow.sources.sinks import radio_table_rows
from cityflow.streaming.writers import drain
from frames import rows


def samples(spark, *values):
    frame = spark.createDataFrame(list(values), "t STRING, center_freq DOUBLE, data DOUBLE")
    return frame.select(F.col("t").cast("timestamp").alias("ts"), "center_freq", "data")


def test_stats_threshold_edges_and_overlap(spark):
    s = samples(
        spark,
        ("1970-01-01 00:00:00", 1.0, 1.0),
        ("1970-01-01 00:00:49", 1.0, 0.0),
        ("1970-01-01 00:00:55", 1.0, 5.0),
        ("1970-01-01 00:01:00", 1.0, 0.5),
        ("1970-01-01 00:00:30", 2.0, 0.9),
    )
    got = rows(radio.with_bounds(radio.channel_stats(s)), "start", "center_freq",
               "channel_avg", "congestion")
    assert got == [
        # the first ten seconds also fall into the window that began 50 seconds earlier
        ("1969-12-31 23:59:10", 1.0, 1.0, 1.0),
        ("1970-01-01 00:00:00", 1.0, 2.0, 2.0),
        ("1970-01-01 00:00:00", 2.0, 0.9, None),
        # 55 s and 60 s: the 60 s sample is outside the window that ends there
        ("1970-01-01 00:00:50", 1.0, 2.75, 1.0),
    ]


def test_empty_input(spark):
    assert radio.channel_stats(samples(spark).limit(0)).count() == 0


def test_nan_is_no_signal(spark):
    s = samples(spark, ("1970-01-01 00:00:20", 1.0, float("nan")),
                ("1970-01-01 00:00:20", 1.0, float("-inf")),
                ("1970-01-01 00:00:20", 2.0, float("inf")))
    assert rows(radio.channel_stats(s), "center_freq", "congestion") == [(1.0, None), (2.0, 1.0)]
    assert radio.detect_signals(s).count() == 1


def test_frequencies_survive_publication(spark):
    freqs = (462562500.0, 100.25, 100.3, 462562500.125)
    s = samples(spark, *[("1970-01-01 00:00:20", f, 0.0) for f in freqs])
    decoded = decode_channel_results(radio.result_json(radio.channel_stats(s)), "value")
    assert sorted(r.center_freq for r in decoded.collect()) == sorted(freqs)


def random_samples(spark, n=400, seed=3):
    rng = random.Random(seed)
    values = [(f"2019-05-01 00:{rng.randrange(20):02d}:{rng.randrange(60):02d}",
               float(rng.randrange(3)), float(rng.randrange(0, 5))) for _ in range(n)]
    return samples(spark, *values)


def test_one_pass_equals_join(spark):
    s = random_samples(spark)
    columns = ("window", "center_freq", "channel_avg", "congestion")
    assert rows(radio.channel_stats(s), *columns) == rows(radio.channel_stats_joined(s), *columns)


def test_join_keeps_a_side_without_partner(spark):
    a = radio.channel_average(samples(spark, ("1970-01-01 00:00:20", 1.0, 3.0)))
    c = radio.channel_congestion(
        radio.mark_peaks(samples(spark, ("1970-01-01 00:00:20", 2.0, 3.0)))
    )
    assert rows(radio.join_channel_sides(c, a), "center_freq", "channel_avg", "congestion") == [
        (1.0, 3.0, None), (2.0, None, 1.0),
    ]


@pytest.mark.parametrize("hop", [Hop(60, 50), Hop(45, 5), Hop(30, 10), Hop(60, 60)])
def test_panes_change_nothing(spark, hop):
    s = random_samples(spark)
    measures = {"m": Mean(F.col("data")), "t": Total(F.when(F.col("data") > 2, 1.0)),
                "n": Count(F.when(F.col("data") > 2, F.col("data")))}
    flat = hopping(s, hop, ["center_freq"], measures, paned=False)
    paned = hopping(s, hop, ["center_freq"], measures, paned=True)
    assert rows(flat, *flat.columns) == rows(paned, *flat.columns)
    # every row falls into size/slide windows when that divides evenly
    if hop.size % hop.slide == 0:
        total = hopping(s, hop, [], {"n": Count(F.lit(1))}).agg(F.sum("n")).first()[0]
        assert total == s.count() * hop.size // hop.slide


@pytest.mark.parametrize("seed", range(3))
def test_peaks_never_outnumber_samples(spark, seed):
    s = random_samples(spark, seed=seed)
    counted = hopping(s, Hop(60, 50), ["center_freq"], {"n": Count(F.lit(1))})
    both = radio.channel_stats(s, 2.0).join(counted, ["window", "center_freq"])
    assert both.count() == counted.count()
    assert both.filter("congestion > n OR channel_avg < 0 OR channel_avg > 4").count() == 0


def test_result_json_round_trip(spark):
    s = samples(spark, ("1970-01-01 00:00:20", 476362500.0, 3.0),
                ("1970-01-01 00:00:20", 5.0, 0.5))
    documents = radio.result_json(radio.channel_stats(s))
    parsed = [json.loads(r.value) for r in documents.collect()]
    bounds = {"start": "1970-01-01 00:00:00", "end": "1970-01-01 00:01:00"}
    assert {"476362500.0": {"congestion": [{"value": 1.0, **bounds}],
                            "average": [{"value": 3.0, **bounds}]}} in parsed
    assert {"5.0": {"congestion": [], "average": [{"value": 0.5, **bounds}]}} in parsed
    decoded = decode_channel_results(documents.select(F.encode("value", "UTF-8").alias("data")))
    assert rows(decoded, "center_freq", "average", "congestion", "cong_start") == [
        (476362500.0, 3.0, 1.0, "1970-01-01 00:00:00"), (5.0, 0.5, None, None),
    ]


def radio_message(data, freq="5.0", t="2019-01-01 00:00:20", **extra):
    attributes = {"timestamp": t.replace(" ", "T") + "Z", "localdatetime": t,
                  "sample_rate": "2000000", **extra}
    if freq is not None:
        attributes["center_freq"] = freq
    return data, attributes, t


def test_unusable_samples_are_set_aside(message):
    m = message(
        radio_message("1.5"), radio_message("x"), radio_message(None),
        radio_message("1", freq=None), radio_message("1", freq="?"),
    )
    parsed = radio.parse_samples(m)
    assert rows(radio.good_samples(parsed), "data", "center_freq") == [(1.5, 5.0)]
    assert rows(radio.bad_samples(parsed), "fault") == [
        ("bad center_freq",), ("bad data",), ("missing center_freq",), ("missing data",),
    ]
    legacy = radio.good_samples(radio.parse_samples(m, legacy_defaults=True))
    assert rows(legacy, "data") == [(-1.0,), (1.5,)]


def test_missing_attributes_have_defaults(message):
    m = message(("2", {"center_freq": "1"}, "2019-01-01 00:00:00"))
    got = radio.parse_samples(m).first()
    assert (got.localdatetime, got.sample_rate, got.data) == ("", None, 2.0)
    table = radio_table_rows(radio.good_samples(radio.parse_samples(m)))
    assert table.first().attribute.center_freq == 1.0


def test_sampler(spark):
    s = samples(spark, ("1970-01-01 00:00:00", 1.0, 1.0), ("1970-01-01 00:00:01", 1.0, 4.0),
                ("1970-01-01 00:00:02", 1.0, 7.0))
    every = Hop(2, 2)
    assert rows(radio.sample_channels(s, every, "average"), "data") == [(2.5,), (7.0,)]
    assert rows(radio.sample_channels(s, every, "max"), "data") == [(4.0,), (7.0,)]
    assert rows(radio.sample_channels(s, every, "min"), "data") == [(1.0,), (7.0,)]
    with pytest.raises(ValueError):
        radio.sample_channels(s, every, "median")


def test_stream_equals_batch_once_windows_close(spark, message, tmp_path):
    rng = random.Random(1)
    live = [radio_message(str(rng.randrange(4)), str(float(rng.randrange(2))),
                          f"2019-01-01 00:{rng.randrange(10):02d}:{rng.randrange(60):02d}")
            for _ in range(60)]
    sentinel = radio_message("0", "9.0", "2030-01-01 00:00:00")
    path = str(tmp_path / "messages")
    message(*live, sentinel).coalesce(1).write.json(path)
    streamed = drain(radio_channel_results(read_messages(spark, path, streaming=True)), "radio")
    batch = radio_channel_results(message(*live))
    assert rows(streamed) == rows(batch)


@pytest.mark.parametrize("hop", [Hop(60, 50), Hop(45, 5)])
def test_panes_work_on_streams(spark, message, tmp_path, hop):
    live = [radio_message(str(i % 3), "1.0", f"2019-01-01 00:0{i % 5}:{i:02d}") for i in range(50)]
    path = str(tmp_path / "messages")
    message(*live, radio_message("0", "9.0", "2030-01-01 00:00:00")).coalesce(1).write.json(path)

    def stats(messages, paned):
        timed = with_event_time(messages, "timestamp")
        good = radio.good_samples(radio.parse_samples(timed))
        return hopping(good, hop, ["center_freq"], {"m": Mean(F.col("data"))}, paned=paned)

    streamed = drain(stats(read_messages(spark, path, streaming=True), True), "panes")
    assert rows(streamed) == rows(stats(message(*live), False))


def test_joined_stream_equals_batch(spark, message, tmp_path):
    live = [radio_message(str(i % 3), "1.0", f"2019-01-01 00:0{i % 5}:{i:02d}") for i in range(50)]
    path = str(tmp_path / "messages")
    message(*live, radio_message("0", "9.0", "2030-01-01 00:00:00")).coalesce(1).write.json(path)

    def stats(messages):
        timed = with_event_time(messages, "timestamp")
        return radio.channel_stats_joined(radio.good_samples(radio.parse_samples(timed)))

    streamed = drain(stats(read_messages(spark, path, streaming=True)), "joined")
    columns = ("window", "center_freq", "channel_avg", "congestion")
    assert rows(streamed, *columns) == rows(stats(message(*live)), *columns)
