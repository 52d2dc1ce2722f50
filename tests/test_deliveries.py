"""Streams that arrive in several parts: restarts, late rows, upserts, replays."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cityflow.operators import enrich
from cityflow.session import shared_dir
from cityflow.sources.messages import drop_repeats
from cityflow.streaming import writers
from frames import rows

START = datetime(2019, 4, 1)


def landing(spark, path, parts, schema="id LONG, ts TIMESTAMP"):
    def land(part):
        return lambda: spark.createDataFrame(part, schema).write.mode("append").parquet(path)

    return [land(p) for p in parts], lambda: spark.readStream.schema(schema).parquet(path)


def at(minutes):
    return START + timedelta(minutes=minutes)


def test_late_rows_are_counted(spark, tmp_path):
    parts = [[(1, at(0)), (2, at(30))], [(3, at(25)), (4, at(5)), (5, at(60))], [(6, at(49)), (7, at(51)), (5, at(60))]]
    land, stream = landing(spark, str(tmp_path / "in"), parts)
    done = writers.drain_deliveries(
        spark, land, lambda: drop_repeats(stream().withWatermark("ts", "10 minutes"), ["id"]), "late")
    # 4 lies 25 minutes behind 2, 6 eleven behind 5; the repeat of 5 is no late row
    assert sorted(r.id for r in done.rows.collect()) == [1, 2, 3, 5, 7]
    assert done.late_rows == 2 and done.batches == 3


def test_state_has_parts_for_the_cores(spark, tmp_path):
    land, stream = landing(spark, str(tmp_path / "in"), [[(1, at(0))], [(2, at(30)), (1, at(30))]])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        done = writers.drain_deliveries(
            spark, land, lambda: drop_repeats(stream().withWatermark("ts", "10 minutes"), ["id"]), "parts")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "30"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(r.id for r in done.rows.collect()) == [1, 2]
    (state,) = Path(shared_dir(spark)).glob("cityflow/parts-*/checkpoint/state/0")
    assert len([p for p in state.iterdir() if p.name.isdigit()]) == 8  # local[4]


def test_upserts_keep_the_newest_row_and_a_replay_changes_nothing(spark):
    table = writers.Upserts(spark, spark.createDataFrame([], "k STRING, n LONG").schema, ["k"])
    assert table.current().count() == 0
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k STRING, n LONG")
    second = spark.createDataFrame([("a", 2), (None, 5)], "k STRING, n LONG")
    table(first, 0)
    table(second, 1)
    want = [("a", 2), ("b", 1), (None, 5)]
    assert rows(table.current()) == sorted(want, key=repr)
    table(second, 1)
    table(first, 0)
    assert rows(table.current()) == sorted(want, key=repr)
    table.fold(1)
    table(first, 0)  # a batch from before the fold
    assert rows(table.current()) == sorted(want, key=repr)
    table(spark.createDataFrame([("b", 9)], "k STRING, n LONG"), 2)
    assert ("b", 9) in rows(table.current())


def test_early_windows_equal_the_batch_result(spark, tmp_path):
    parts = [[(i, at(i)) for i in range(k, k + 40)] for k in (0, 20, 60)]
    land, stream = landing(spark, str(tmp_path / "in"), parts)
    checkpoint, table = str(tmp_path / "checkpoint"), None
    for deliver in land:
        deliver()
        counts = stream().withWatermark("ts", "1 hour").groupBy(F.window("ts", "10 minutes")).agg(F.count(F.lit(1)).alias("n"))
        table = table or writers.Upserts(spark, counts.schema, ["window"])
        writers.early_results(counts, table, checkpoint=checkpoint, trigger={"availableNow": True}).awaitTermination()
    everything = spark.read.parquet(str(tmp_path / "in"))
    want = everything.groupBy(F.window("ts", "10 minutes")).agg(F.count(F.lit(1)).alias("n"))
    assert rows(table.current()) == rows(want) and len(rows(want)) == 10


@pytest.mark.parametrize("salt", [1, 3])
def test_rows_without_a_record_are_faults(spark, salt):
    stream = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (1, "w")], "id LONG, v STRING")
    records = spark.createDataFrame([(1, "one"), (3, "three")], "id LONG, name STRING")
    got = rows(enrich.enrich_or_fault(stream, records, "id", salt), "id", "v", "name", "fault")
    assert got == sorted([(1, "x", "one", None), (1, "w", "one", None), (2, "y", None, "no record"), (None, "z", None, "no record")], key=repr)


def test_a_table_by_day_takes_no_row_twice(spark, tmp_path):
    parts = [[(1, at(0)), (2, at(60 * 30))], [(3, at(60 * 50))]]
    land, stream = landing(spark, str(tmp_path / "in"), parts)
    for deliver in [*land, lambda: None]:
        deliver()
        rows_in = stream().withColumn("day", F.to_date("ts"))
        writers.append_table(rows_in, "by_day", str(tmp_path / "cp"), {"availableNow": True}, ["day"], str(tmp_path / "t")).awaitTermination()
    stored = spark.table("by_day")
    assert rows(stored, "id") == [(1,), (2,), (3,)]
    one = stored.where("day = DATE'2019-04-02'")
    assert rows(one, "id") == [(2,)] and "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().toString()
