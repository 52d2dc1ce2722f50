import pytest

from cityflow.operators import imaging, training
from cityflow.plans import dataflows
from frames import rows


@pytest.fixture
def archives_dir(tmp_path):
    tweets = ["localdatetime,tweet"] + [f"[2019-04-15-05-2{i % 10}-07 - t{i}" for i in range(3)]
    traffic = ["localdatetime,predict", "2019-04-15-05-20,0.25", "2019-04-15-05-29,0.5",
               "2019-04-15-06-00,0.125"]
    weather = ["localdatetime,icon,precip,summary,temp,time,uv,wind",
               "2019-04-15-05-20,i,0,Rain,64.5,1,0,7.5", "2019-04-15-05-25,i,0,Clear,64.0,1,1,8.0",
               "2019-04-15-07-00,i,0,Drizzle,60.3333333,1,1,8.0"]
    for name, content in (("twitter", tweets), ("traffic", traffic), ("weather", weather)):
        (tmp_path / f"{name}-1.txt").write_text("\n".join(content) + "\n")
    return str(tmp_path)


EXPECTED = [
    ("2019-04-15-05-2", 3, 0.4, 64.25, 0.5, 7.75, 0.375),
    ("2019-04-15-06-0", None, None, None, None, None, 0.125),
    ("2019-04-15-07-0", None, 0.4, 60.333333, 1.0, 8.0, None),
]


def test_training_set_from_archives(spark, archives_dir):
    got = dataflows.training_set_from_archives(
        spark, f"{archives_dir}/twitter-*.txt", f"{archives_dir}/traffic-*.txt",
        f"{archives_dir}/weather-*.txt",
    )
    assert rows(got) == EXPECTED
    assert rows(training.complete_rows(got), "bucket") == [("2019-04-15-05-2",)]
    lists = {r.bucket: r for r in training.feed_lists(got).collect()}
    full = lists["2019-04-15-05-2"]
    assert full.twitter == [3] and full.traffic == [0.375]
    assert tuple(full.weather[0]) == (0.4, 64.25, 0.5, 7.75)
    assert lists["2019-04-15-06-0"].twitter == [] and lists["2019-04-15-06-0"].weather == []


def test_join_gives_the_same_rows(spark):
    tweets = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "bucket STRING, text STRING")
    traffic = spark.createDataFrame([("b", 0.5), ("c", 0.25)], "bucket STRING, traffic DOUBLE")
    weather = spark.createDataFrame(
        [("c", 0.1, 50.0, 1.0, 2.0), ("d", 0.2, 51.0, 1.0, 2.0)],
        "bucket STRING, precip DOUBLE, temp DOUBLE, uv DOUBLE, wind DOUBLE",
    )
    one = training.training_set(tweets, traffic, weather)
    joined = training.training_set_joined(tweets, traffic, weather)
    assert rows(one) == rows(joined, *one.columns) and one.count() == 4


def test_labels_split_and_error(spark):
    frame = spark.createDataFrame([(3, 1, 0.5), (0, 8, 0.25)], "vehicles INT, people INT, predict DOUBLE")
    labelled = frame.withColumn("label", imaging.label_value())
    assert rows(labelled, "label") == [(0.25,), (0.5,)]
    error = imaging.model_error(labelled).first()
    assert (error.mae, error.mse) == (0.25, 0.0625)
    train, test = imaging.train_test_split(spark.range(2000), "id")
    assert train.count() + test.count() == 2000 and 120 < test.count() < 280
    assert train.intersect(test).count() == 0
