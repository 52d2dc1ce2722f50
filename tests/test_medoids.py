import math
import random

import pytest

from cityflow.operators import cluster


def plain(points):
    """The member with the least sum of distances, by comparing all pairs."""
    return min(points, key=lambda p: (sum(math.dist(p, q) for q in points), p))


@pytest.mark.parametrize("batch", [3, 32])
def test_medoids_equal_those_of_all_pairs(spark, batch):
    rng = random.Random(batch)
    groups = {
        0: [(rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(120)] + [(90.0, 90.0)],  # one far out
        1: [(rng.gauss(5, 3), 0.0) for _ in range(80)],
        2: [(1.0, 1.0)] * 5,
        3: [(0.0, 0.0), (1.0, 0.0)],  # equal sums: the first by coordinates
    }
    frame = spark.createDataFrame([(k, *p) for k, ps in groups.items() for p in ps] + [(1, None, 2.0)], "cluster INT, x DOUBLE, y DOUBLE")
    assert cluster.exact_medoids(frame, ["x", "y"], batch) == {k: plain(ps) for k, ps in groups.items()}
    assert cluster.exact_medoids(frame.limit(0), ["x", "y"]) == {}


def test_euclidean_fit_settles(spark):
    rng = random.Random(9)
    spots = [(0, 0), (10, 0), (0, 10)]
    points = [(cx + rng.gauss(0, 1), cy + rng.gauss(0, 1)) for cx, cy in spots for _ in range(40)]
    frame = spark.createDataFrame(points, "x DOUBLE, y DOUBLE")
    got = cluster.fit_medoids(frame, 3, columns=["x", "y"], cost="euclidean")
    assert got == sorted(plain(points[40 * i : 40 * i + 40]) for i in range(3))
    with pytest.raises(ValueError):
        cluster.fit_medoids(frame, 3, columns=["x", "y"], cost="cubic")


def test_few_rounds_find_the_medoid_of_many_members(spark, monkeypatch):
    """Slopes leave few candidates after a round, however many members there are; bounds by distance alone took 16 rounds."""
    rng = random.Random(4)
    points = [(float(rng.randint(1, 50)), rng.randint(90000, 210000) / 5000) for _ in range(1500)]
    frame = spark.createDataFrame([(0, *p) for p in points for _ in range(2)], "cluster INT, x DOUBLE, y DOUBLE")
    tables = []
    monkeypatch.setattr(cluster, "settle", lambda df, label, kept=cluster.settle: tables.append(label) or kept(df, label))
    assert cluster.exact_medoids(frame, ["x", "y"], 16) == {0: plain(points)}
    assert tables.count("medoid-candidates") <= 4
