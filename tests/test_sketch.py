import numpy as np
import pytest

from cityflow.functions import sketch


def test_quantiles_lie_within_the_bound(spark):
    rng = np.random.default_rng(1)
    groups = {"wide": np.exp(rng.normal(0, 6, 4000)), "signed": rng.normal(0, 3, 3001), "zero": np.zeros(5), "one": np.array([-7.5])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("zero", None), ("zero", float("nan")), (None, 2.0)]
    frame = spark.createDataFrame(rows, "k STRING, v DOUBLE")
    quantiles = [0.0, 0.01, 0.3, 0.5, 0.99, 1.0]
    got = sketch.sketch_quantiles(sketch.quantile_sketch(frame, ["k"], "v"), ["k"], quantiles).collect()
    assert len(got) == 5 * len(quantiles)
    for r in got:
        values = np.sort(groups.get(r.k, np.array([2.0])))
        exact = values[int(np.floor(r.q * (len(values) - 1)))]
        assert r.value == pytest.approx(exact, rel=0.01 + 1e-9, abs=1e-12)


def test_sketches_of_parts_add_up(spark):
    frame = spark.range(1000).selectExpr("id % 3 AS k", "CAST(id AS DOUBLE) - 300 AS v")
    whole = sketch.quantile_sketch(frame, ["k"], "v")
    parts = [sketch.quantile_sketch(frame.where(f"v % 2 = {i} OR v % 2 = -{i}"), ["k"], "v") for i in (0, 1)]
    both = sketch.merge_sketches(parts[0].union(parts[1]), ["k"])
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, whole.collect()))
    with pytest.raises(ValueError):
        sketch.growth(1.5)
