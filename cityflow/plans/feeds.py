"""The feeds as derived from the driver's tables.

The driver supplies ``events``, ``lineitem`` and so on, not radio or weather
archives. Every feed here is computed by Spark from a whole table, row for row,
so its size follows the table's.
"""

from __future__ import annotations

import re
import struct
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.functions.time import MINUTE_STAMP, SECOND_STAMP, STAMP
from cityflow.functions.weather import RAIN_LEVELS, rain_level

RFC3339 = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
CATEGORIES = tuple(RAIN_LEVELS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, one file or a folder of them, as a stream; zone-less times are UTC."""
    schema = events(spark, sf_dir).schema  # fails where there is no table
    reader = spark.readStream.schema(schema)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getFileStatus(path).isDirectory():
        stream = reader.parquet(f"{sf_dir}/events.parquet")
    else:
        stream = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def of_type(df: DataFrame, event_type: str) -> DataFrame:
    return df.filter(F.col("event_type") == event_type)


def center_freq() -> Column:
    """Sixteen channels, 12.5 kHz apart."""
    return F.lit(470e6) + F.lit(12500.0) * (F.col("user_id") % 16)


def radio_samples(ev: DataFrame) -> DataFrame:
    return ev.select("ts", center_freq().alias("center_freq"), F.col("value").alias("data"))


def _messages(ev: DataFrame, data: Column, **attributes: Column) -> DataFrame:
    pairs = [
        F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
        for k, v in attributes.items()
    ]
    present = F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())
    return ev.select(
        F.col("event_id"),
        F.encode(data, "UTF-8").alias("data"),
        F.map_from_entries(present).alias("attributes"),
        F.col("ts").cast("timestamp").alias("publish_time"),
    )


def radio_messages(ev: DataFrame) -> DataFrame:
    """Radio messages; some lack a frequency and some carry a bad reading."""
    bad = F.when(F.col("event_id") % 77 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    freq = F.when(F.col("event_id") % 50 != 0, F.format_string("%.1f", center_freq()))
    return _messages(
        ev,
        bad,
        timestamp=F.date_format("ts", RFC3339),
        localdatetime=F.date_format("ts", STAMP),
        center_freq=freq,
        sample_rate=F.lit("2000000.0"),
    )


def category() -> Column:
    return F.element_at(
        F.array(*map(F.lit, CATEGORIES)), (F.col("user_id") % 10 + 1).cast("int")
    )


def traffic_messages(ev: DataFrame) -> DataFrame:
    return _messages(
        of_type(ev, "click"),
        F.lit("score"),
        camera=F.lit("689"),
        localdatetime=F.date_format("ts", SECOND_STAMP),
        cnn_output=F.col("value") / 1000,
    )


def tweet_messages(ev: DataFrame) -> DataFrame:
    return _messages(
        of_type(ev, "view"),
        F.col("props"),
        id_str=F.col("event_id"),
        timestamp_ms=F.unix_millis(F.col("ts").cast("timestamp")),
        author_id_str=F.col("user_id"),
    )


def weather_messages(ev: DataFrame) -> DataFrame:
    return _messages(
        of_type(ev, "purchase"),
        F.lit("icon"),
        localdatetime=F.date_format("ts", SECOND_STAMP),
        summary=category(),
        temp=F.col("value"),
        uv=F.col("user_id") % 9,
        wind=F.col("value") / 10,
    )


def wide_records(ev: DataFrame) -> DataFrame:
    """The three feeds as wide records, filled by event type in a single scan."""

    def when(event_type: str, value: Column) -> Column:
        return F.when(F.col("event_type") == event_type, value)

    return ev.filter(F.col("event_type").isin("view", "purchase", "click")).select(
        "ts",
        when("view", F.lit(1)).alias("tweets"),
        when("purchase", rain_level(category())).alias("precip"),
        when("purchase", F.col("value")).alias("temp"),
        when("purchase", (F.col("user_id") % 9).cast("double")).alias("uv"),
        when("purchase", F.col("value") / 10).alias("wind"),
        when("click", F.col("value") / 1000).alias("traffic"),
    )


def tweet_lines(ev: DataFrame) -> DataFrame:
    """Archive lines with a header-like line per thousand tweets to be skipped."""
    stamp = F.date_format("ts", SECOND_STAMP)
    line = F.concat(F.lit("@"), stamp, F.lit(" - "), F.col("props"))
    noise = F.when(F.col("event_id") % 1000 == 0, F.array(line, F.lit("localdatetime,tweet")))
    return of_type(ev, "view").select(
        F.explode(F.coalesce(noise, F.array(line))).alias("value")
    )


def traffic_lines(ev: DataFrame) -> DataFrame:
    stamp = F.date_format("ts", MINUTE_STAMP)
    return of_type(ev, "click").select(
        F.concat(stamp, F.lit(","), (F.col("value") / 1000).cast("string")).alias("value")
    )


def weather_lines(ev: DataFrame) -> DataFrame:
    stamp = F.date_format("ts", MINUTE_STAMP)
    fields = (
        stamp, F.lit("icon"), F.lit("0.0"), category(), F.col("value"),
        F.unix_seconds(F.col("ts").cast("timestamp")), F.col("user_id") % 9, F.col("value") / 10,
    )
    return of_type(ev, "purchase").select(F.concat_ws(",", *fields).alias("value"))


def weather_table(ev: DataFrame) -> DataFrame:
    """Weather rows whose ``precip`` column holds the category name."""
    return of_type(ev, "purchase").select(
        F.date_format("ts", SECOND_STAMP).alias("localdatetime"),
        F.lit("icon").alias("icon"),
        category().alias("precip"),
        category().alias("summary"),
        F.col("value").alias("temp"),
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("time"),
        (F.col("user_id") % 9).cast("double").alias("uv"),
        (F.col("value") / 10).alias("wind"),
    )


def weather_payloads(ev: DataFrame) -> DataFrame:
    """Weather responses as JSON text."""
    now = F.struct(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
        category().alias("summary"),
        F.lit("icon").alias("icon"),
        F.lit(0.0).alias("precipProbability"),
        F.col("value").alias("temperature"),
        (F.col("user_id") % 9).cast("double").alias("uvIndex"),
        (F.col("value") / 10).alias("windSpeed"),
    )
    return of_type(ev, "purchase").select(
        "event_id", F.to_json(F.struct(now.alias("currently"))).alias("value")
    )


def tweet_json(turns: DataFrame) -> DataFrame:
    """Conversation turns as raw tweets; odd turns are truncated and carry an extended text."""
    cut = F.col("turn") % 2 == 1
    empty = F.array().cast(
        "array<struct<id_str:string,screen_name:string,name:string,indices:array<int>>>"
    )

    def entities(tag: Column) -> Column:
        return F.struct(
            F.array(
                F.struct(tag.alias("text"), F.array(F.lit(0), F.lit(1)).alias("indices"))
            ).alias("hashtags"),
            empty.alias("user_mentions"),
        )

    lon, lat = place_corner()
    ring = F.array(
        F.array(lon, lat), F.array(lon, lat + 0.01),
        F.array(lon + 0.01, lat + 0.01), F.array(lon + 0.01, lat),
    )
    full = F.struct(F.col("text").alias("full_text"), entities(F.lit("full")).alias("entities"))
    tweet = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("id_str"),
        (F.lit(1556000000000) + F.col("conv_id") * 60000 + F.col("turn") * 1000)
        .cast("string")
        .alias("timestamp_ms"),
        F.lit("en").alias("lang"),
        F.when(cut, F.concat(F.substring("text", 1, 20), F.lit("…")))
        .otherwise(F.col("text"))
        .alias("text"),
        cut.alias("truncated"),
        F.when(cut, full).alias("extended_tweet"),
        entities(F.col("role")).alias("entities"),
        F.col("role").alias("source"),
        F.struct(
            F.col("conv_id").cast("string").alias("id_str"), F.col("turn").alias("statuses_count")
        ).alias("user"),
        F.struct(
            F.lit("p").alias("id"),
            F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias(
                "bounding_box"
            ),
        ).alias("place"),
    )
    return turns.select("conv_id", "turn", F.to_json(tweet).alias("value"))


def place_corner() -> tuple[Column, Column]:
    """South-west corner of a tweet's place, 0.01 degrees on a side, near the city box."""
    lon = F.lit(-74.0) + (F.col("conv_id") % 10) * 0.01
    lat = F.lit(40.78) + (F.col("turn") % 10) * 0.01
    return lon, lat


def label_lines(ev: DataFrame) -> DataFrame:
    """Camera label lines, every other one with the ``Date:`` prefix."""
    stamp = F.date_format("ts", SECOND_STAMP)
    http = F.date_format("ts", "dd MMM yyyy HH:mm:ss 'GMT'")
    dated = F.when(
        F.col("event_id") % 2 == 0,
        F.concat(F.lit("Date: "), F.date_format("ts", "EEE"), F.lit(", "), http),
    ).otherwise(http)
    return ev.select(
        F.concat(
            stamp, F.lit(" - "), dated,
            F.lit(","), (F.col("user_id") % 12).cast("string"),
            F.lit(","), (F.col("event_id") % 5).cast("string"),
        ).alias("value")
    )


def sentence_id() -> Column:
    """Unique within a page: line number, then part, then supplier."""
    return (
        F.col("l_linenumber").cast("long") * F.lit(10**15)
        + F.col("l_partkey") * F.lit(10**7)
        + F.col("l_suppkey")
    )


def line_address() -> Column:
    return F.concat_ws(
        "/", F.lit("line"), F.col("l_orderkey").cast("string"), sentence_id().cast("string")
    )


def annotated_sentences(lines: DataFrame, page: str = "order") -> DataFrame:
    """One sentence per order line: a supplier (organization) makes a part (location).

    The return flag decides the shape: R names the arguments in reverse, A
    states a relation of another kind, N is plain. A page is an order, or a
    single line.
    """
    order = F.concat_ws("/", F.lit("order"), F.col("l_orderkey").cast("string"))
    url = line_address() if page == "line" else order
    org = F.concat(F.lit("Supplier"), F.col("l_suppkey").cast("string"))
    loc = F.concat(F.lit("Part"), F.col("l_partkey").cast("string"))
    first_id = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    second_id = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))

    def token(i: int, word: Column, ner: str) -> Column:
        return F.struct(F.lit(str(i)).alias("id"), word.alias("word"), F.lit(ner).alias("ner"))

    def entity(eid: Column, kind: str, end: int) -> Column:
        return F.struct(
            eid.alias("id"), F.lit(kind).alias("type"), F.lit(str(end)).alias("end")
        )

    def argument(eid: Column, kind: str) -> Column:
        return F.struct(eid.alias("id"), F.lit(kind).alias("type"))

    straight = F.array(argument(first_id, "ORGANIZATION"), argument(second_id, "LOCATION"))
    reverse = F.array(argument(second_id, "LOCATION"), argument(first_id, "ORGANIZATION"))
    name = F.when(F.col("l_returnflag") == "A", "Work_For").otherwise("OrgBased_In")
    confidence = F.col("l_discount") * 10
    relation = F.struct(
        name.alias("type"),
        F.when(F.col("l_returnflag") == "R", reverse).otherwise(straight).alias("args"),
        F.array(
            F.struct(F.lit("_NR").alias("label"), (1 - confidence).alias("value")),
            F.struct(name.alias("label"), confidence.alias("value")),
        ).alias("probs"),
    )
    return lines.select(
        url.alias("url"),
        F.col("l_orderkey").alias("page_order"),
        sentence_id().alias("sent_id"),
        F.array(
            token(1, org, "ORGANIZATION"), token(2, F.lit("makes"), "O"), token(3, loc, "LOCATION")
        ).alias("tokens"),
        F.array(
            entity(first_id, "ORGANIZATION", 1), entity(second_id, "LOCATION", 3)
        ).alias("entities"),
        F.array(relation).alias("relations"),
    )


def sentence_xml() -> Column:
    """The sentence as the annotator's XML spells it; names and numbers need no escapes."""

    def each(rows, *parts) -> Column:
        return F.array_join(F.transform(rows, lambda x: F.concat(*[p(x) if callable(p) else F.lit(p) for p in parts])), "")

    tokens = each(
        "tokens", '<token id="', lambda t: t["id"], '"><word>', lambda t: t["word"], "</word><NER>", lambda t: t["ner"],
        "</NER></token>",
    )
    entities = each(
        "entities", '<entity id="', lambda e: e["id"], '">', lambda e: e["type"], '<span start="0" end="', lambda e: e["end"],
        '"/></entity>',
    )
    relations = each(
        "relations", '<relation id="R">', lambda r: r["type"], "<arguments>",
        lambda r: each(r["args"], '<entity id="', lambda a: a["id"], '">', lambda a: a["type"], "</entity>"),
        "</arguments><probabilities>",
        lambda r: each(
            r["probs"], "<probability><label>", lambda p: p["label"], "</label><value>", lambda p: p["value"].cast("string"),
            "</value></probability>",
        ),
        "</probabilities></relation>",
    )
    return F.concat(
        F.lit('<sentence id="'), F.col("sent_id").cast("string"), F.lit('"><tokens>'), tokens,
        F.lit("</tokens><MachineReading><entities>"), entities, F.lit("</entities><relations>"), relations,
        F.lit("</relations></MachineReading></sentence>"),
    )


def line_pages(lines: DataFrame) -> DataFrame:
    """One page per order line: what `search_pages` looks through."""
    words = F.concat_ws(
        " ",
        F.concat(F.lit("Supplier"), F.col("l_suppkey").cast("string")),
        F.lit("makes"),
        F.concat(F.lit("Part"), F.col("l_partkey").cast("string")),
    )
    return lines.select(line_address().alias("url"), words.alias("text"))


IMAGE_SIDE = 8


def tiny_images(vectors: DataFrame) -> DataFrame:
    """Each 64-value vector as an 8x8 grey image."""
    byte = F.transform(
        "embedding",
        lambda v: F.lpad(
            F.hex(F.floor(F.least(F.greatest(v.cast("double") + 0.5, F.lit(0.0)), F.lit(0.996)) * 256)
                  .cast("int")),
            2, "0",
        ),
    )
    return vectors.select(
        F.concat(F.lit("689-"), F.col("vec_id").cast("string")).alias("origin"),
        F.lit(IMAGE_SIDE).alias("height"),
        F.lit(IMAGE_SIDE).alias("width"),
        F.lit(1).alias("nChannels"),
        F.unhex(F.array_join(byte, "")).alias("data"),
        "vec_id",
        "label",
    )


def png_bytes(grey: bytes, side: int = IMAGE_SIDE) -> bytes:
    """A square grey image as a PNG file."""
    lines = b"".join(b"\0" + grey[r * side : (r + 1) * side] for r in range(side))

    def part(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", side, side, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")


def write_image_folder(vectors: DataFrame, out: str) -> str:
    """A PNG file per vector below ``out``, named by camera and number; returns ``out``.

    Tasks write their own files; of every hundred ids the first is no image. The
    folder must be reachable from all executors, as the shared folder is.
    """
    named = tiny_images(vectors).select(
        F.concat(F.lit("689-"), F.lpad(F.col("vec_id").cast("string"), 16, "0"), F.lit(".png")).alias("name"),
        "data", (F.col("vec_id") % 100 == 0).alias("broken"),
    )
    target = out if re.match(r"\w+://", out) else "file://" + out.removeprefix("file:")

    def write(batches):
        files, folder = pa.fs.FileSystem.from_uri(target)
        files.create_dir(folder, recursive=True)
        for batch in batches:
            for name, data, broken in zip(*(c.to_pylist() for c in batch.columns)):
                body = b"no image" if broken else png_bytes(data)
                with files.open_output_stream(f"{folder}/{name}") as stream:
                    stream.write(body)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    named.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return out


def mean_brightness():
    """A stand-in model: the mean of the input tensor."""
    return lambda batch: batch.mean(axis=(1, 2, 3), dtype="float64")


class NameAnnotator:
    """A rule-based annotator: sentences end at a stop, capitalised words are names."""

    def __call__(self, page: str):
        for part in re.split(r"[.!?]+", page):
            words = [w for w in part.split(" ") if w]
            if words:
                yield {"tokens": [
                    {"id": str(i), "word": w, "ner": "NAME" if re.match("[A-Z][a-z]", w) else "O"}
                    for i, w in enumerate(words, start=1)
                ]}
