import math
import os
import re
from datetime import datetime
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from cityflow.functions import stats, text, time, vectors, weather


def one(spark, expr, **values):
    cols = [F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*cols, F.lit(0)).select(expr).first()[0]


@pytest.mark.parametrize(
    "encoding, value, expected",
    [
        ("rfc3339", "2019-05-08T14:46:20.029Z", datetime(2019, 5, 8, 14, 46, 20, 29000)),
        ("rfc3339", "soon", None),
        ("epoch_ms", "1557326780029", datetime(2019, 5, 8, 14, 46, 20, 29000)),
        ("epoch_ms", "x", None),
        ("epoch_s", "1557326780", datetime(2019, 5, 8, 14, 46, 20)),
        ("minute", "2019-04-27-09-06", datetime(2019, 4, 27, 9, 6)),
        ("second", "2019-04-27-09-06-59", datetime(2019, 4, 27, 9, 6, 59)),
        ("stamp", "2019-04-27 09:06:59", datetime(2019, 4, 27, 9, 6, 59)),
        ("stamp", "27.04.2019", None),
        ("http", "Date: Sun, 31 Mar 2019 21:23:38 GMT", datetime(2019, 3, 31, 21, 23, 38)),
        ("http", "Sun, 31 Mar 2019 21:23:38 GMT", datetime(2019, 3, 31, 21, 23, 38)),
        ("http", "09 Apr 2019 23:46:25 GMT", datetime(2019, 4, 9, 23, 46, 25)),
        ("http", "yesterday", None),
    ],
)
def test_event_time(spark, encoding, value, expected):
    expr = time.event_time(F.col("v"), encoding).cast("timestamp_ntz")
    assert one(spark, expr, v=value) == expected


def test_unknown_encoding_and_mode():
    with pytest.raises(ValueError):
        time.event_time(F.lit("x"), "roman")
    with pytest.raises(ValueError):
        time.local_time(F.lit("x"), "mars")


@pytest.mark.parametrize(
    "utc, zone, fixed",
    [
        ("2019-07-01 12:00:00", "2019-07-01 08:00:00", "2019-07-01 08:00:00"),
        ("2019-01-01 12:00:00", "2019-01-01 07:00:00", "2019-01-01 08:00:00"),
    ],
)
def test_local_time(spark, utc, zone, fixed):
    ts = F.lit(utc).cast("timestamp")
    got = [one(spark, F.date_format(time.local_time(ts, m), time.STAMP)) for m in ("zone", "fixed")]
    assert got == [zone, fixed]


def test_bucket_key_is_a_ten_minute_window(spark):
    ts = F.lit("2019-04-15 05:29:59").cast("timestamp")
    assert one(spark, time.bucket_key(ts)) == "2019-04-15-05-2"


def test_a_reading_is_repeated_for_ten_minutes(spark):
    frame = spark.range(1).select(F.lit("2019-01-01 00:00:00").cast("timestamp").alias("ts"))
    times = frame.select(F.explode(time.repeats("ts")).alias("t")).orderBy("t").collect()
    assert len(times) == 60 and times[-1].t == datetime(2019, 1, 1, 0, 9, 50)


def test_rain_levels(spark):
    levels = spark.createDataFrame([(k,) for k in weather.RAIN_LEVELS], "s STRING").select(
        "s", weather.rain_level(F.col("s"), strict=True).alias("v")
    )
    assert {r.s: r.v for r in levels.collect()} == weather.RAIN_LEVELS
    assert one(spark, weather.rain_level(F.col("s")), s="Locusts") is None
    with pytest.raises(Exception, match="unknown weather category: Locusts"):
        one(spark, weather.rain_level(F.col("s"), strict=True), s="Locusts")


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>one</p><p>two</p>", "one two"),
        ("<script>var t='</p>';</script>kept<style>p{}</style>", "kept"),
        ("<SCRIPT type='x'>gone</SCRIPT >a", "a"),
        ("a<!-- <b>hidden</b> -->b", "a b"),
        ("cut <script>never closed", "cut"),
        ("cut <!-- never closed", "cut"),
        ("cut <a href='x", "cut"),
        ("1 < 2 &amp; 3 &gt; 2", "1 < 2 & 3 > 2"),
        ("&amp;lt; stays escaped once", "&lt; stays escaped once"),
        ("caf&#233; &#xE9; &#128512;&#x1F600; &#39;q&#39;", "café é 😀😀 'q'"),
        ("&#0; &#55296; &#99999999;", "&#0; &#55296; &#99999999;"),
        ("&copy;&middot;&nbsp;&quot;x&quot;", '©· "x"'),
        ("  a\n\t b  ", "a b"),
        ("", ""),
        (None, None),
    ],
)
def test_page_text(spark, html, expected):
    frame = spark.createDataFrame([(html,)], "h STRING")
    assert frame.select(text.page_text(F.col("h"))).first()[0] == expected


def test_page_text_keeps_the_whole_page(spark):
    page = "<p>" + "word " * 60_000 + "end</p>"
    got = spark.createDataFrame([(page,)], "h STRING").select(text.page_text(F.col("h"))).first()[0]
    assert got.endswith("word end") and len(got) == 5 * 60_000 + 3


def test_positions_of_min_keeps_ties(spark):
    ties = vectors.positions_of_min(F.array(F.lit(2.0), F.lit(1.0), F.lit(1.0)))
    assert one(spark, ties) == [1, 2]


def test_distances(spark):
    d = vectors.distances([F.lit(0.0), F.lit(0.0)], [(3.0, 4.0), (0.0, 1.0)])
    assert one(spark, d) == [5.0, 1.0]


def test_mean_or_nan(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None)], "k STRING, v DOUBLE")
    native = frame.groupBy("k").agg(stats.mean_or_nan(F.col("v")).alias("mean"))
    for frame_of_means in (native, stats.mean_per_key(frame, "k", "v")):
        got = {r.k: r.mean for r in frame_of_means.collect()}
        assert got["a"] == 1.5 and math.isnan(got["b"])


class _Parsed(HTMLParser):
    """A page's text as the standard library's parser finds it: markup is a gap, scripts and styles are none."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden = [], False
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.parts.append(" ")
        self.hidden = tag in ("script", "style")

    def handle_endtag(self, tag):
        self.parts.append(" ")
        self.hidden = False

    def handle_comment(self, data):
        self.parts.append(" ")

    handle_decl = handle_pi = handle_comment

    def handle_data(self, data):
        self.parts.append("" if self.hidden else data)

    def text(self):
        return re.sub("[ \t\r\n]+", " ", "".join(self.parts)).strip(" ")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver tables not present")
def test_page_text_equals_a_parsers(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = pages.select("html", text.page_text(F.col("html")).alias("text")).collect()
    assert len(got) > 100 and all(r.text == _Parsed(r.html).text() for r in got)
