import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.session import run_dir, shared_dir
from cityflow.sources import sinks
from cityflow.streaming import writers
from frames import rows


def stream(spark, tmp_path, name="in"):
    path = str(tmp_path / name)
    spark.range(6).select("id", F.concat(F.lit("t"), "id").alias("text")).write.json(path)
    return spark.readStream.schema("id LONG, text STRING").json(path)


ONCE = {"availableNow": True}


def test_batch_sinks(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "id INT, t STRING")
    sinks.write_sharded(frame, str(tmp_path / "json"))
    documents = [json.loads(line) for f in (tmp_path / "json").glob("*.json")
                 for line in f.read_text().splitlines()]
    assert sorted(documents, key=lambda d: d["id"]) == [{"id": 1, "t": "a"}, {"id": 2}]
    sinks.write_count(frame.agg(F.count(F.lit(1)).alias("n")), str(tmp_path / "count"))
    parts = [p.read_text() for p in (tmp_path / "count").glob("part-*")]
    assert parts == ["2\n"]
    sinks.write_scores(frame, str(tmp_path / "scores"))
    assert any(p.read_text().startswith("id,t\n") for p in (tmp_path / "scores").glob("part-*"))


def test_tap_counts_without_a_job_of_its_own(spark):
    tapped, seen = sinks.tap(spark.range(7), "tap", top=F.max("id"))
    assert tapped.filter("id > 2").count() == 4
    assert seen.get == {"rows": 7, "top": 6}


def test_publish_json(spark, tmp_path):
    out = str(tmp_path / "out")
    payload = sinks.to_payload(stream(spark, tmp_path))
    text = payload.select(F.decode("value", "UTF-8").alias("text"))
    writers.publish(text, "json", trigger=ONCE, path=out).awaitTermination(60)
    assert rows(spark.read.json(out)) == [(f"t{i}",) for i in range(6)]


def test_append_csv_and_restart(spark, tmp_path):
    source, out, checkpoint = stream(spark, tmp_path), str(tmp_path / "o"), str(tmp_path / "c")
    for _ in range(2):  # the second run finds nothing new
        writers.append_csv(source, out, checkpoint, ONCE).awaitTermination(60)
    assert spark.read.option("header", True).csv(out).count() == 6
    assert Path(checkpoint).exists()


def test_append_table(spark, tmp_path):
    samples = stream(spark, tmp_path).select(
        F.col("id").cast("double").alias("data"), F.lit("2019-01-01 00:00:00").alias("localdatetime"),
        F.lit(5.0).alias("center_freq"), F.lit(2.0).alias("sample_rate"),
    )
    nested = sinks.radio_table_rows(samples)
    writers.append_table(nested, "rf_samples", trigger=ONCE).awaitTermination(60)
    stored = spark.table("rf_samples")
    declared = spark.createDataFrame([], schemas.RADIO_TABLE).schema
    assert [f.name for f in stored.schema["attribute"].dataType] == [
        f.name for f in declared["attribute"].dataType
    ]
    assert stored.count() == 6


def test_early_results_update_open_windows(spark, tmp_path):
    seen = {}

    def upsert(batch, _):
        seen.update({r.id: r["count"] for r in batch.collect()})

    counts = stream(spark, tmp_path).groupBy((F.col("id") % 2).alias("id")).count()
    query = writers.early_results(counts, upsert, every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert seen == {0: 3, 1: 3}


def test_drain_times_out(spark, tmp_path):
    with pytest.raises(TimeoutError):
        writers.drain(stream(spark, tmp_path), "slow", timeout=0.001)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x").startswith(shared_dir(spark)) and run_dir(spark, "x") != run_dir(spark, "x")
