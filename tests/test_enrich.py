import pytest
from pyspark.sql import functions as F

from cityflow.operators import enrich
from frames import rows


@pytest.fixture
def vitals(spark):
    return spark.createDataFrame([(1, 999), (1, 400), (2, 600), (9, 800)], "id LONG, vital INT")


@pytest.fixture
def patients(spark):
    return spark.createDataFrame([(1, "Ann"), (2, "Bob")], "id LONG, name STRING")


def test_selected_keeps_the_top_share(spark):
    frame = spark.createDataFrame([(499,), (500,), (1000,)], "v INT")
    assert rows(frame.filter(enrich.selected(F.col("v"), 0.5))) == [(1000,), (500,)]
    assert frame.filter(enrich.selected(F.col("v"), 1.0)).count() == 3


def test_missing_records(vitals, patients):
    assert rows(enrich.enrich(vitals, patients, "id"), "id", "vital", "name") == [
        (1, 400, "Ann"), (1, 999, "Ann"), (2, 600, "Bob"),
    ]
    with pytest.raises(Exception, match="no record for key 9"):
        enrich.enrich(vitals, patients, "id", on_missing="fail").collect()
    with pytest.raises(Exception, match="no record for key 9"):
        enrich.count_rows(enrich.enrich(vitals, patients, "id", on_missing="fail")).collect()
    known = vitals.filter("id < 9")
    assert enrich.enrich(known, patients, "id", on_missing="fail").count() == 3
    with pytest.raises(ValueError):
        enrich.enrich(vitals, patients, "id", on_missing="guess")
    with pytest.raises(ValueError):
        enrich.enrich(vitals, patients, "id", on_repeat="guess")


def test_repeated_lookup_keys(spark, vitals, patients):
    twice = patients.union(patients)
    with pytest.raises(Exception, match="repeated lookup key: "):
        enrich.enrich(vitals, twice, "id").collect()
    assert enrich.enrich(vitals, twice, "id", on_repeat="any").count() == 6


@pytest.mark.parametrize("on_missing", ["drop", "fail"])
def test_salting_changes_nothing(spark, patients, on_missing):
    hot = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 2).otherwise(1).cast("long").alias("id"),
        F.col("id").alias("vital"),
    )
    plain = enrich.enrich(hot, patients, "id", on_missing)
    salted = enrich.enrich(hot, patients, "id", on_missing, salt=8)
    assert rows(plain, "id", "vital", "name") == rows(salted, "id", "vital", "name")


def test_lookup_is_not_broadcast_beyond_the_threshold(spark, vitals, patients):
    joined = enrich.enrich(vitals, patients, "id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        again = enrich.enrich(vitals, patients, "id")
        assert rows(again) == rows(joined)
        plan = again._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_both_orders_share_a_plan(vitals, patients):
    args = (vitals, patients, "id", "vital")
    options = {"before": 0.5, "after": 0.3, "on_repeat": "any"}
    after = enrich.filter_after_join(*args, **options)
    before = enrich.filter_before_join(*args, **options)

    def optimized(df):
        return df._jdf.queryExecution().optimizedPlan()

    assert optimized(after).sameResult(optimized(before))
    assert rows(after) == rows(before) == [(1, 999, "Ann")]


def test_sweep_equals_single_runs(vitals, patients):
    steps = (1.0, 0.5, 0.1)
    swept = {r.selectivity: r.tuples for r in enrich.selectivity_sweep(
        vitals, patients, "id", "vital", steps).collect()}
    for s in steps:
        one = enrich.filter_before_join(vitals, patients, "id", "vital", 1.0, s)
        assert swept[round(1 - s, 1)] == one.count()


def test_equal_rows_spread_over_all_salts(spark):
    stream = spark.range(1000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    lookup = spark.createDataFrame([(1, "one"), (2, "two")], "k INT, name STRING")
    spread = F.floor(F.rand(7) * 8).cast("int")
    assert stream.select(spread.alias("s")).distinct().count() == 8
    assert enrich.enrich(stream, lookup, "k", salt=8).count() == 1000


@pytest.mark.parametrize("join", [enrich.enrich, enrich.enrich_or_fault])
def test_copies_of_a_lookup_count_towards_its_broadcast(spark, tmp_path, join):
    """The lookup alone is below the limit of a broadcast, its copies are not."""
    lookup = spark.range(20_000).select(F.col("id").alias("k"), F.format_string("record %09d", "id").alias("v"))
    lookup.write.parquet(str(tmp_path / "lookup"))
    stored = spark.read.parquet(str(tmp_path / "lookup"))
    size = sum(f.stat().st_size for f in (tmp_path / "lookup").glob("*.parquet"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(2 * size))
    try:
        joined = join(spark.range(500_000).withColumnRenamed("id", "k"), stored, "k", salt=8)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert joined.where("v = format_string('record %09d', k)").count() == 20_000
