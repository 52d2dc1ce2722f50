"""Rows that cannot be read, repeat or tie: none is lost silently, none is picked by chance."""

import pytest
from pyspark.sql import functions as F

from cityflow.functions.text import page_text
from cityflow.operators import cluster
from cityflow.operators import relations as rel
from cityflow.options import WEATHER_FEATURES
from cityflow.sources import messages, payloads


def test_equal_confidences_go_by_address(spark):
    rows = [(f"u{i:02d}", 0, 1, 0, "r", ("a", "T", "A"), ("b", "T", "B"), 0.5) for i in range(40)]
    frame = spark.createDataFrame(
        rows, "url STRING, page_order LONG, sent_id LONG, seq LONG, rel_type STRING,"
        " e1 STRUCT<id: STRING, type: STRING, value: STRING>,"
        " e2 STRUCT<id: STRING, type: STRING, value: STRING>, confidence DOUBLE")
    for parts in (1, 2, 7, 40):
        best = rel.dedup_relations(frame.repartition(parts))
        assert [r.url for r in best.collect()] == ["u00"]


def test_unknown_confidence_loses(spark):
    frame = spark.createDataFrame(
        [("x", None, 1), ("x", 0.1, 2), ("x", 0.4, 3)], "k STRING, confidence DOUBLE, page_order LONG")
    best = rel.keep_best(frame, ["k"], ["page_order"]).first()
    assert (best.confidence, best.page_order) == (0.4, 1)


def test_messages_without_an_id_are_kept_on_one_scan(spark, message):
    sent = message(
        ("a", {"id_str": "1"}, "2019-04-23T00:00:00"), ("a", {"id_str": "1"}, "2019-04-23T00:00:00"),
        ("b", {}, "2019-04-23T00:00:00"), ("b", {}, "2019-04-23T00:00:00"))
    once = messages.drop_repeated_messages(sent)
    assert once.count() == 3
    assert once.columns == sent.columns


def test_decode_reports_what_it_cannot_read(spark):
    good = '{"470000000.0": {"average": [], "congestion": []}}'
    frame = spark.createDataFrame([(good,), ("{oops",), (None,), ("{}",)], "data STRING")
    assert payloads.decode_channel_results(frame).count() == 1
    faults = {r.data: r.fault for r in payloads.unreadable_channel_results(frame).collect()}
    assert faults == {"{oops": "bad json", None: "no payload", "{}": "no channel"}


def test_weather_fit_keeps_partial_rows_and_zero_columns(spark):
    rows = [(0.0, float(i), 1.0, float(i % 5)) for i in range(30)] + [(0.0, None, 1.0, 2.0)] * 3
    frame = spark.createDataFrame(rows, ", ".join(f"{c} DOUBLE" for c in WEATHER_FEATURES))
    _, predicted, centers = cluster.fit_weather_clusters(frame, k=2)
    assert predicted.count() == 33
    assert predicted.where(F.col("prediction").isNull()).count() == 3
    assert centers.count() == 2
    assert {r[WEATHER_FEATURES[0]] for r in centers.collect()} == {0.0}


def test_too_few_medoids_is_an_error(spark):
    frame = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (5.0, 5.0)] * 3, "x DOUBLE, y DOUBLE")
    with pytest.raises(ValueError, match="not 7"):
        cluster.fit_medoids(frame, k=7, columns=["x", "y"])


@pytest.mark.parametrize("html, expected", [
    ("caf&eacute; 3&times;4 &rarr; &alpha;", "café 3×4 → α"),
    ("&#38;lt;b&#x26;gt; &amp;eacute; &#38;#233;", "&lt;b&gt; &eacute; &#233;"),
    ("R&D; &nosuch; &copy2020 &notit;", "R&D; &nosuch; ©2020 &notit;"),
])
def test_references_are_resolved_once(spark, html, expected):
    frame = spark.createDataFrame([(html,)], "h STRING")
    assert frame.select(page_text(F.col("h"))).first()[0] == expected
