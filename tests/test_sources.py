import os
import json
import struct
import zlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cityflow.functions.text import attribute, payload_text
from cityflow.operators import tweets
from cityflow.sources import annotations, archives, images, messages, payloads
from frames import rows


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_messages_read_as_batch_and_stream(spark, message, tmp_path):
    path = str(tmp_path / "in")
    message(("a", {"k": "1"}, "2019-01-01 00:00:00")).write.json(path)
    batch = messages.read_messages(spark, path)
    assert batch.select(payload_text(), attribute("k"), attribute("none")).first()[:] == (
        "a", "1", None,
    )
    stream = messages.read_messages(spark, path, streaming=True)
    assert stream.isStreaming and stream.schema == batch.schema


def test_kafka_columns(spark):
    header = "ARRAY<STRUCT<key: STRING, value: BINARY>>"
    records = spark.createDataFrame(
        [
            (bytearray(b"x"), [("k", bytearray(b"old")), ("k", bytearray(b"new"))]),
            (bytearray(b"y"), None),
        ],
        f"value BINARY, headers {header}",
    ).withColumn("timestamp", F.lit("2019-01-01").cast("timestamp"))
    got = messages.from_kafka(records).select(payload_text().alias("d"), attribute("k").alias("k"))
    assert rows(got) == [("x", "new"), ("y", None)]


def test_event_time_from_attribute_or_publication(message):
    m = message(("a", {"timestamp_ms": "1625407201500"}, "2019-01-01 00:00:00"))
    named = messages.with_event_time(m, "timestamp_ms", "epoch_ms")
    assert named.first().ts == datetime(2021, 7, 4, 14, 0, 1, 500000)
    assert messages.with_event_time(m).first().ts == datetime(2019, 1, 1)


def test_repeated_messages(message):
    m = message(
        ("a", {"id_str": "1"}, "2019-01-01 00:00:00"),
        ("a", {"id_str": "1"}, "2019-01-01 00:00:01"),
        ("b", {"id_str": "2"}, "2019-01-01 00:00:00"),
        ("c", {}, "2019-01-01 00:00:00"),
        ("c", {}, "2019-01-01 00:00:00"),
    )
    once = messages.drop_repeated_messages(m).select(payload_text().alias("t"))
    assert rows(once) == [("a",), ("b",), ("c",), ("c",)]


def test_tweet_lines(spark):
    frame = lines(
        spark,
        "localdatetime,tweet",
        "[2019-04-15-05-21-07 - hello, world",
        "second line of the tweet above",
        "",
        "x",
        "[2019-04-15-05-21-07",
    )
    assert rows(archives.parse_tweet_lines(frame)) == [
        ("2019-04-15-05-2", ""),
        ("2019-04-15-05-2", "hello, world"),
    ]


def test_traffic_lines(spark):
    frame = lines(spark, "localdatetime,predict", "2019-04-27-09-06,0.15", "2019-04-27-09-17,bad", "")
    assert rows(archives.parse_traffic_lines(frame)) == [
        ("2019-04-27-09-0", 0.15),
        ("2019-04-27-09-1", None),
    ]


def test_weather_lines(spark):
    frame = lines(
        spark,
        "localdatetime,icon,precip,summary,temp,time,uv,wind",
        "2019-04-15-05-21,rain,0.9,Heavy Rain,64.5,1555305660,0,7.6",
        "2019-04-15-05-29,fog,0.1,Sharknado,64.5,1555305660,0,7.6",
        "2019-04-15-05-29,cut,0.1",
    )
    assert rows(archives.parse_weather_lines(frame)) == [
        ("2019-04-15-05-2", 1.0, 64.5, 0.0, 7.6),
        ("2019-04-15-05-2", None, 64.5, 0.0, 7.6),
        ("2019-04-15-05-2", None, None, None, None),
    ]
    with pytest.raises(Exception, match="Sharknado"):
        archives.parse_weather_lines(frame, strict=True).collect()


def test_csv_tables(spark, tmp_path):
    (tmp_path / "v.csv").write_text("1,900\n2,100\n")
    (tmp_path / "p.csv").write_text("1,Ann,1970,f\n")
    (tmp_path / "w.csv").write_text(
        "localdatetime,icon,precip,summary,temp,time,uv,wind\n2019-04-15-05-21,i,Rain,s,64.5,1,2,3\n"
    )
    (tmp_path / "l.csv").write_text("datetime,vehicles,people\na.jpg,3,1\n")
    assert rows(archives.read_vitals(spark, str(tmp_path / "v.csv"))) == [(1, 900), (2, 100)]
    assert rows(archives.read_patients(spark, str(tmp_path / "p.csv"))) == [(1, "Ann", 1970, "f")]
    weather = archives.read_weather_table(spark, str(tmp_path / "w.csv")).first()
    assert (weather.precip, weather.temp, weather.wind) == ("Rain", 64.5, 3.0)
    assert rows(archives.read_labels_table(spark, str(tmp_path / "l.csv"))) == [("a.jpg", 3, 1)]


def test_label_lines(spark):
    frame = lines(
        spark,
        "2021-07-04-10-00-01 - Date: Sun, 04 Jul 2021 14:00:01 GMT,5,2",
        "2021-08-02-11-30-45 - 02 Aug 2021 15:30:45 GMT,0,7",
        "2021-07-05-12-00-00 - Date: Mon, 05 Jul 2021 16:00:00 GMT",
        "2021-08-01-09-15-30 - 01 Aug 2021 13:15:30 GMT,4.5",
        "no label here",
    )
    assert rows(archives.parse_label_lines(frame)) == [
        ("2021-07-04-10-00-01", "Sun, 04 Jul 2021 14:00:01 GMT", 5, 2),
        ("2021-07-05-12-00-00", "Mon, 05 Jul 2021 16:00:00 GMT", None, None),
        ("2021-08-01-09-15-30", "01 Aug 2021 13:15:30 GMT", None, None),
        ("2021-08-02-11-30-45", "02 Aug 2021 15:30:45 GMT", 0, 7),
    ]


def test_weather_payload(spark):
    doc = {
        "currently": {"time": 1556000000, "summary": "Drizzle", "icon": "rain",
                      "precipProbability": 0.4, "temperature": 51.2, "uvIndex": 3, "windSpeed": 4.5},
        "hourly": {"ignored": True},
    }
    got = payloads.parse_weather(lines(spark, json.dumps(doc))).first()
    assert got.ts == datetime(2019, 4, 23, 6, 13, 20)
    assert got[1:] == ("Drizzle", "rain", 0.4, 51.2, 3.0, 4.5)


def tweet(**over):
    base = {
        "id_str": "7", "timestamp_ms": "1625407201500", "lang": "en", "text": "short",
        "truncated": False, "source": "web", "coordinates": None,
        "entities": {"hashtags": [{"text": "a", "indices": [0, 2]}], "user_mentions": []},
        "user": {"id_str": "9", "location": None, "geo_enabled": True, "statuses_count": 1,
                 "followers_count": 2, "friends_count": 3},
        "place": {"id": "p", "place_type": "city", "full_name": "Here", "country_code": "US",
                  "country": "United States",
                  "bounding_box": {"type": "Polygon", "coordinates": [
                      [[-74.02, 40.68], [-74.02, 40.87], [-73.91, 40.87], [-73.91, 40.68]]]}},
    }
    return json.dumps({**base, **over})


def test_normalise_tweets(spark):
    long_form = {"full_text": "the whole text",
                 "entities": {"hashtags": [{"text": "b", "indices": [0, 2]}],
                              "user_mentions": [{"screen_name": "who"}]}}
    raw = lines(spark, tweet(), tweet(id_str="8", truncated=True, extended_tweet=long_form))
    flat = payloads.normalise_tweets(payloads.parse_tweets(raw))
    assert rows(flat, "id_str", "text", "hashtags", "user_mentions") == [
        ("7", "short", ["a"], []),
        ("8", "the whole text", ["b"], ["who"]),
    ]
    sent = payloads.tweets_to_messages(flat)
    first = sent.filter(attribute("id_str") == "7").first()
    assert bytes(first.data) == b"short"
    assert first.attributes["place_bounding_box_coordinates"].startswith("[[[-74.02,40.68]")
    assert "coordinates" not in first.attributes and "author_location" not in first.attributes


def test_geographic_filter(spark):
    inside = {"type": "Point", "coordinates": [-73.955, 40.815]}
    outside = {"type": "Point", "coordinates": [-73.90, 40.815]}
    far = {"id": "q", "bounding_box": {"type": "Polygon", "coordinates": [
        [[-75.0, 40.0], [-75.0, 40.1], [-74.9, 40.1], [-74.9, 40.0]]]}}
    raw = lines(
        spark,
        tweet(id_str="point in"), tweet(id_str="place over"),
        *[tweet(id_str="in", coordinates=inside), tweet(id_str="out", coordinates=outside)],
        tweet(id_str="far", place=far),
    )
    flat = payloads.normalise_tweets(payloads.parse_tweets(raw))
    assert rows(tweets.near_city(flat), "id_str") == [("in",), ("place over",), ("point in",)]
    edge = spark.range(1).select(tweets.in_box(F.lit(-73.964927), F.lit(40.818940)))
    assert edge.first()[0] is True


SENTENCES = """<root><document><sentences>
<sentence id="1"><tokens>
<token id="1"><word>Ann</word><NER>PERSON</NER></token>
<token id="2"><word>lives</word><NER>O</NER></token>
<token id="3"><word>Paris</word><NER>LOCATION</NER></token></tokens>
<MachineReading><entities>
<entity id="E-1">PEOPLE
  <span start="0" end="1"/></entity>
<entity id="E-2">LOCATION
  <span start="2" end="3"/></entity></entities>
<relations><relation id="R-1">Live_In
  <arguments><entity id="E-1">PEOPLE
    <span start="0" end="1"/></entity><entity id="E-2">LOCATION
    <span start="2" end="3"/></entity></arguments>
  <probabilities><probability><label>Live_In</label><value>0.9</value></probability>
  <probability><label>_NR</label><value>9e-5</value></probability></probabilities>
</relation></relations></MachineReading></sentence>
<sentence id="2"><tokens><token id="1"><word>Bare</word><NER>O</NER></token></tokens>
<MachineReading><entities/></MachineReading></sentence>
</sentences></document></root>"""


def test_annotated_xml(spark, tmp_path):
    (tmp_path / "page.xml").write_text(SENTENCES)
    got = annotations.read_sentences(spark, str(tmp_path / "page.xml")).orderBy("sent_id").collect()
    full, bare = got
    assert [t.word for t in full.tokens] == ["Ann", "lives", "Paris"]
    assert [(e.id, e.type, e.end) for e in full.entities] == [
        ("E-1", "PEOPLE", "1"), ("E-2", "LOCATION", "3"),
    ]
    rel = full.relations[0]
    assert rel.type == "Live_In" and [a.type for a in rel.args] == ["PEOPLE", "LOCATION"]
    assert [(p.label, p.value) for p in rel.probs] == [("Live_In", 0.9), ("_NR", 9e-5)]
    assert bare.entities == [] and bare.relations == [] and full.url.endswith("page.xml")


def test_pages_are_annotated_by_a_supplied_model(spark):
    def load():
        names = {"Ann": "PERSON", "Paris": "LOCATION"}

        def annotate(page):
            for part in page.split(". "):
                words = part.split()
                yield {"tokens": [{"id": str(i), "word": w, "ner": names.get(w, "O")}
                                  for i, w in enumerate(words, start=1)]}

        return annotate

    pages = spark.createDataFrame(
        [("u", "Ann likes Paris. Nobody else"), ("v", None)], "url STRING, text STRING")
    got = annotations.annotate_pages(pages, load).orderBy("sent_id").collect()
    assert [(r.url, r.sent_id, [t.ner for t in r.tokens], r.relations) for r in got] == [
        ("u", 1, ["PERSON", "O", "LOCATION"], []), ("u", 2, ["O", "O"], []),
    ]


def test_pages_joined_to_a_table_function(spark):
    class Names:
        """Sentences end at a full stop; two words are known names."""

        def __call__(self, page):
            names = {"Ann": "PERSON", "Paris": "LOCATION"}
            for part in page.split(". "):
                words = enumerate(part.split(), start=1)
                yield {"tokens": [{"id": str(i), "word": w, "ner": names.get(w, "O")} for i, w in words]}

    pages = spark.createDataFrame(
        [(1, "Ann likes Paris. Nobody else"), (2, None), (3, "Paris")], "page_id INT, text STRING")
    got = annotations.annotate_lateral(pages, Names).orderBy("page_id", "sent_id").collect()
    assert [(r.page_id, r.sent_id, [t.ner for t in r.tokens], r.entities) for r in got] == [
        (1, 1, ["PERSON", "O", "LOCATION"], []), (1, 2, ["O", "O"], []), (3, 1, ["LOCATION"], []),
    ]


def png(height, width, pixel):
    """A colour PNG from ``pixel(row, column) -> (r, g, b)``."""
    raw = b"".join(
        b"\0" + bytes(v for c in range(width) for v in pixel(r, c)) for r in range(height)
    )

    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw))
            + chunk(b"IEND", b""))


def test_images_and_manifest(spark, tmp_path):
    for name in ("689-2019-04-04-08-34-38.jpg", "688-2019-04-04-08-35-38.jpg"):
        (tmp_path / name).write_bytes(png(2, 3, lambda r, c: (10, 20, 30)))
    (tmp_path / "689-2019-04-04-08-36-38.jpg").write_bytes(b"not an image")
    meta = images.image_metadata(images.read_images(spark, str(tmp_path)))
    assert rows(meta) == [
        ("688", "2019-04-04-08-35-38", 2, 3), ("689", "2019-04-04-08-34-38", 2, 3),
    ]
    listing = images.read_manifest(spark, str(tmp_path), "689-*.jpg")
    names = rows(listing.select(images.file_name(F.col("path")).alias("n")))
    assert names == [("689-2019-04-04-08-34-38.jpg",), ("689-2019-04-04-08-36-38.jpg",)]
    stamp = spark.range(1).select(images.image_stamp(F.lit("689-2019-04-04-08-34-38.jpg")))
    assert stamp.first()[0] == "2019-04-04-08-34"


def test_only_fetched(spark):
    frame = spark.createDataFrame([(1, 200), (2, 404), (3, None)], "id INT, status INT")
    assert rows(images.only_fetched(frame), "id") == [(1,)]


def test_one_xml_file_feeds_many_tasks(spark, tmp_path):
    def sentence(i, word):
        return (f'<sentence id="{i}">\n<tokens><token id="1"><word>{word}</word><NER>O</NER></token></tokens>'
                f"<MachineReading><entities/><relations/></MachineReading></sentence>")

    head, tail = '<?xml version="1.0"?>\n<root><document><sentences>\n', "\n</sentences></document></root>"
    big = tmp_path / "b-large.xml"
    big.write_text(head + "\n".join(sentence(i, f"größe{i} " + "x" * (i % 400)) for i in range(6000)) + tail)
    (tmp_path / "a-small.xml").write_text(
        head + '<sentence id="1"/>' + sentence(7, "only") + '<sentence id="8"><tokens></sentence>' + tail)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        got = annotations.read_sentences(spark, str(tmp_path))
        assert annotations.sentence_records(spark, str(big)).rdd.getNumPartitions() > 5
        found = got.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    of_big = sorted(r.sent_id for r in found if r.page_order == 1)
    assert of_big == list(range(6000)) and len(found) == 6001
    assert [r.tokens[0].word[:8] for r in found if r.sent_id == 41] == ["größe41 "[:8]]
    first, = [r for r in found if r.page_order == 0]
    assert first.sent_id == 7 and first.url.endswith("a-small.xml") and first.entities == []
    bad, = annotations.sentence_faults(spark, str(tmp_path)).collect()
    assert 'id="8"' in bad.record and bad.url.endswith("a-small.xml")


def test_pages_in_order_of_time(spark, tmp_path):
    for i, name in enumerate(("c.xml", "a.xml", "b.xml")):
        (tmp_path / name).write_text("<s/>")
        os.utime(tmp_path / name, (1000 + i, 1000 + i))
    by_time = annotations.page_positions(spark, str(tmp_path), "time").orderBy("page_order").collect()
    assert [r.url[-5:] for r in by_time] == ["c.xml", "a.xml", "b.xml"]
    by_path = annotations.page_positions(spark, str(tmp_path)).orderBy("page_order").collect()
    assert [(r.url[-5:], r.page_order) for r in by_path] == [("a.xml", 0), ("b.xml", 1), ("c.xml", 2)]


def test_scanned_xml_is_written_compressed_in_several_files(spark, tmp_path):
    from pathlib import Path

    from cityflow.plans.registry import sentences_xml_scan
    from cityflow.session import shared_dir

    lines = spark.range(150_000).coalesce(1).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 700).alias("l_partkey"), (F.col("id") % 30).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(0.5).alias("l_discount"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("N").alias("l_returnflag"),
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    before = set(Path(shared_dir(spark)).glob("cityflow/sentences-*"))
    found = sentences_xml_scan(spark, str(tmp_path))
    (folder,) = set(Path(shared_dir(spark)).glob("cityflow/sentences-*")) - before
    files = [f for f in folder.iterdir() if f.name.startswith("part-")]
    assert len(files) == 2 and sum(f.stat().st_size for f in files) < 150_000 * 100
    assert found.count() == 100_000


def spelled(number="1", word="Bill", more="", mention="ORGANIZATION", end="1", value="0.25", gap="", middle=""):
    """A sentence with one relation; the arguments are written into it as they are."""
    return (
        f'<sentence id="{number}">{gap}<tokens>{gap}<token id="1">{gap}<word>{word}</word>{gap}{more}<NER>O</NER>{gap}</token>'
        f'{gap}<token id="2"><word>x</word><NER>LOCATION</NER></token></tokens>{gap}{middle}<MachineReading>{gap}'
        f'<entities>{gap}<entity id="E1">{gap}{mention}{gap}<span start="0" end="{end}"/>{gap}<probabilities/>{gap}</entity>'
        f'</entities>{gap}<relations>{gap}<relation id="R1">{gap}OrgBased_In{gap}<arguments>{gap}'
        f'<entity id="E1">{gap}{mention}{gap}<span start="0" end="1"/></entity>{gap}<entity id="E2">LOCATION</entity>'
        f"{gap}</arguments>{gap}<probabilities>{gap}<probability><label>OrgBased_In</label>{gap}<value>{value}</value>"
        f"</probability>{gap}</probabilities>{gap}</relation>{gap}<relation id=\"R2\">Work_For<arguments>"
        f'<entity id="E2">LOCATION</entity></arguments><probabilities><probability><label>_NR</label><value>1</value>'
        f"</probability></probabilities></relation></relations></MachineReading>{gap}</sentence>"
    )


def as_parsed(spark, path):
    """The sentences below ``path``, each by the XML parser."""
    from cityflow import schemas

    read = F.from_xml("record", f"{schemas.SENTENCE_XML}, _corrupt_record STRING", {"columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = annotations.sentence_records(spark, path).select("url", read.alias("s")).where("s._corrupt_record IS NULL")
    return annotations.from_xml_rows(parsed.select("url", "s.*"))


def test_plain_sentences_are_read_as_the_parser_reads_them(spark, tmp_path):
    plain = [
        spelled(), spelled(gap="\n   "), spelled(gap="\r\n\t"), spelled(word='größe "x" & y'.replace("&", "'")),
        spelled(more="<lemma>bill</lemma><POS>NNP</POS><Speaker></Speaker>"), spelled(value="1.0E-4"), spelled(value="none"),
        spelled(mention="two words", end="2"), spelled(word="two\nlines"), spelled(word="\U0001F600"),
        spelled(middle='<parse>(ROOT (S x)) </parse><dependencies type="basic"><dep type="root">'
                       '<governor idx="0">ROOT</governor><dependent idx="1">x</dependent></dep></dependencies>'),
        spelled().replace("<entities>", "<entities/><!").split("<!")[0] + "<relations/></MachineReading></sentence>",
    ]
    others = [
        spelled(word="a&amp;b"), spelled(word="&#65;"), spelled(word="<![CDATA[a<b]]>"), spelled(word="a<!-- c -->b"),
        spelled(word=" padded "), spelled(word=""), spelled(number="+7"), spelled(number=" 7 "), spelled(end=" 1"),
        spelled(mention="ORG<b>x</b>"), spelled(more="<word>again</word>"), spelled(more="<WORD>again</WORD>"),
        spelled().replace('"', "'"), spelled().replace("<NER>O</NER>", ""), spelled().replace("tokens>", "Tokens>"),
        spelled().replace("<probabilities><probability><label>_NR</label><value>1</value></probability></probabilities>", ""),
        spelled().replace('<token id="1">', '<token x="y" id="1">'), '<sentence id="9"><tokens/></sentence>',
        spelled(word="\x01"), "\x01a\x01b\x01c\x01d" + spelled(), spelled(word="]]>"), spelled(number="x"),
        spelled(more="<POS>NN</pos>"), spelled(end='1" end="2'),
    ]
    for name, records in (("plain", plain), ("others", others)):
        (tmp_path / f"{name}.xml").write_text("\n".join(records), newline="")
    by_parser = annotations._parsed(spark, str(tmp_path)).where("full IS NOT NULL")
    assert rows(by_parser.select("url").distinct())[0][0].endswith("others.xml")
    assert by_parser.where("url LIKE '%others.xml'").count() == len(others)
    expected = as_parsed(spark, str(tmp_path))
    got = annotations.read_sentences(spark, str(tmp_path), None)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    faults = annotations.sentence_faults(spark, str(tmp_path)).collect()
    assert len(faults) + got.count() == len(plain) + len(others) and len(faults) >= 5


def test_a_long_plain_sentence_is_matched_without_recursion(spark, tmp_path):
    more = "".join(f"<a{i}>b</a{i}>" for i in range(20_000))
    token = '<token id="3"><word>y</word><NER>O</NER></token>'
    record = spelled(more=more).replace("</tokens>", token * 20_000 + "</tokens>")
    for name, tag in (("entities", "entity"), ("relations", "relation"), ("probabilities", "probability")):
        place = record.rindex(f"</{name}>")
        one = record[record.rindex(f"<{tag}", 0, place):place]
        record = record[:place] + one * 3_000 + record[place:]
    (tmp_path / "long.xml").write_text(record)
    assert annotations._parsed(spark, str(tmp_path)).where("full IS NULL").count() == 1
    found = annotations.read_sentences(spark, str(tmp_path), None).first()
    assert len(found.tokens) == 20_002 and found.tokens[-1].word == "y"
    assert len(found.entities) == 3_001 and len(found.relations) == 3_002 and len(found.relations[-1].probs) == 3_001


def test_written_sentences_do_not_need_the_parser(spark, tmp_path):
    from cityflow.plans import feeds

    lines = spark.range(300).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 7).alias("l_partkey"), (F.col("id") % 3).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), (F.col("id") / 700).alias("l_discount"),
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"),
    )
    path = str(tmp_path / "xml")
    feeds.annotated_sentences(lines).select(feeds.sentence_xml()).write.text(path, compression="gzip")
    parsed = annotations._parsed(spark, path)
    assert parsed.count() == 300 and parsed.where("full IS NOT NULL").count() == 0
    got = annotations.read_sentences(spark, path, None)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, as_parsed(spark, path).collect()))
