import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from cityflow.operators import correlation
from frames import rows


@pytest.fixture
def buckets(spark):
    rng = random.Random(1)
    values = [(b, f, rng.random() + (b if f == "a" else 0)) for b in range(200) for f in ("a", "b", "flat") if rng.random() < 0.8]
    values = [(b, f, 1.0 if f == "flat" else v) for b, f, v in values]
    return spark.createDataFrame(values, "bucket LONG, feature STRING, value DOUBLE"), values


def test_correlation_of_later_values(buckets):
    frame, values = buckets
    at = {(b, f): v for b, f, v in values}
    got = {(r.first, r.second, r.lag): r for r in correlation.lagged_correlation(frame, [0, 5]).collect()}
    assert set(got) == {(a, b, 5) for a in ("a", "b", "flat") for b in ("a", "b", "flat") if a != b} | {("a", "b", 0), ("a", "flat", 0), ("b", "flat", 0)}
    xy = np.array([(at[b, "a"], at[b + 5, "b"]) for b in range(200) if (b, "a") in at and (b + 5, "b") in at])
    row = got["a", "b", 5]
    assert row.n == len(xy) and row.correlation == pytest.approx(np.corrcoef(xy.T)[0, 1])
    assert got["a", "flat", 0].correlation is None


def test_fluctuation_over_days(buckets):
    frame, values = buckets
    at = {(b, f): v for b, f, v in values}
    got = correlation.fluctuation(frame).collect()
    assert len(got) == len(values)
    for r in got:
        for hours in (24, 48, 72):
            span = [at[b, r.feature] for b in range(r.bucket - hours + 1, r.bucket + 1) if (b, r.feature) in at]
            assert r[f"mean_{hours}h"] == pytest.approx(np.mean(span))
            assert r[f"range_{hours}h"] == pytest.approx(max(span) - min(span))


def test_buckets_are_aligned(spark):
    at = datetime(2019, 4, 1, 10, 59, 59)
    records = spark.createDataFrame(
        [(at, 1.0, None), (at + timedelta(seconds=2), 3.0, 5.0), (at + timedelta(minutes=30), 5.0, None)],
        "ts TIMESTAMP, temp DOUBLE, uv DOUBLE")
    got = rows(correlation.aligned_buckets(records, ["temp", "uv"]))
    first = got[0][0]
    assert got == [(first, "temp", 1.0), (first + 1, "temp", 4.0), (first + 1, "uv", 5.0)]
