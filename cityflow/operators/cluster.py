"""Nearest-centre assignment, k-means and k-medoids."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityflow.functions.vectors import distances, positions_of_min, squared_distance
from cityflow.functions.weather import rain_level
from cityflow.operators.normalize import max_scale
from cityflow.options import FEATURES, WEATHER_FEATURES, MedoidModel
from cityflow.session import settle


def assign_clusters(
    points: DataFrame,
    centers: Sequence[Sequence[float]] | None = None,
    columns: Sequence[str] = FEATURES,
) -> DataFrame:
    """Add ``clusters`` (every nearest centre, ties kept) and ``cluster`` (the first of them).

    The centres are literals of the plan: no join, no UDF.
    """
    centers = MedoidModel().centers if centers is None else centers
    near = positions_of_min(distances([F.col(c) for c in columns], centers))
    return points.withColumn("clusters", near).withColumn("cluster", F.get(F.col("clusters"), 0))


def weather_training_rows(
    weather: DataFrame, category_col: str = "precip", keep: Sequence[str] = ()
) -> DataFrame:
    """Weather table to the four numeric columns the model is trained on."""
    return weather.select(
        *keep,
        rain_level(F.col(category_col)).alias("precip"),
        *[F.col(c).cast("double").alias(c) for c in WEATHER_FEATURES[1:]],
    )


def _assembled(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(
        inputCols=list(columns), outputCol="features", handleInvalid="skip"
    ).transform(rows)


def fit_weather_clusters(
    rows: DataFrame, k: int = 6, seed: int = 5, columns: Sequence[str] = WEATHER_FEATURES
):
    """k-means on max-scaled columns: ``(model, scaled rows with a prediction, centres)``.

    The centres are brought back to the original scale and rounded (halves to even) to one
    decimal; the frame has ``k`` rows. A column of zeros stays zero. Rows that
    lack a value are left out of the fit and keep a null prediction.
    """
    rows = settle(rows, "cluster-rows")
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    zeroed = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns}
    scaled = _assembled(max_scale(rows.where(whole), columns).withColumns(zeroed), columns)
    model = KMeans(k=k, seed=seed, featuresCol="features").fit(scaled)
    spark = rows.sparkSession
    centers = spark.createDataFrame(
        [(i, *map(float, c)) for i, c in enumerate(model.clusterCenters())],
        "cluster INT, " + ", ".join(f"{c} DOUBLE" for c in columns),
    )
    tops = rows.where(whole).agg(F.struct(*[F.max(c).cast("double").alias(c) for c in columns])).scalar()
    denormalised = centers.select(
        "cluster", *[F.bround(F.col(c) * tops[c], 1).alias(c) for c in columns]
    )
    partial = rows.where(~whole).withColumns({c: F.col(c).cast("double") for c in columns})
    predicted = model.transform(scaled).unionByName(partial, allowMissingColumns=True)
    return model, predicted, denormalised


def fit_medoids(
    points: DataFrame,
    k: int = 7,
    seed: int = 5,
    max_iter: int = 20,
    columns: Sequence[str] = FEATURES,
    cost: str = "squared",
) -> list[tuple[float, ...]]:
    """k-medoids on all rows, under squared Euclidean cost or (``cost="euclidean"``) Euclidean.

    Euclidean medoids are those of :func:`exact_medoids`. Under squared cost the sum of squared distances from a member to the rest of its cluster is
    ``n * |member - mean|^2`` plus a constant, so the exact medoid is the
    member nearest to the mean: two aggregations per round, no pairs and no
    sampling. Only ``k`` centres ever reach the driver. No rows give no medoids;
    fewer than ``k`` different ones are an error, and medoids that still move
    after ``max_iter`` rounds are a warning.
    """
    if cost not in ("squared", "euclidean"):
        raise ValueError(f"cost must be 'squared' or 'euclidean', not {cost!r}")
    rows = settle(points.select(*columns).dropna(), "points")
    if rows.isEmpty():
        return []
    seeds = KMeans(k=k, seed=seed, maxIter=5).fit(_assembled(rows, columns)).clusterCenters()
    medoids = _nearest_members(rows, [tuple(map(float, c)) for c in seeds], columns)
    for _ in range(max_iter):
        assigned = assign_clusters(rows, medoids, columns)
        if cost == "euclidean":
            updated = sorted(set(exact_medoids(assigned, columns).values()))
            if updated == medoids:
                break
            medoids = updated
            continue
        means = assigned.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in columns]).collect()
        updated = _nearest_members(
            assigned.drop("clusters"),
            [tuple(m[c] for c in columns) for m in sorted(means, key=lambda m: m["cluster"])],
            columns,
            [m["cluster"] for m in sorted(means, key=lambda m: m["cluster"])],
        )
        if updated == medoids:
            break
        medoids = updated
    else:
        warnings.warn(f"medoids still move after {max_iter} rounds", RuntimeWarning, stacklevel=2)
    if len(medoids) < k:
        raise ValueError(f"{len(medoids)} different medoids found, not {k}")
    return medoids


def exact_medoids(
    assigned: DataFrame, columns: Sequence[str] = FEATURES, batch: int = 32
) -> dict[int, tuple[float, ...]]:
    """Per ``cluster`` the member with the least sum of Euclidean distances to all members.

    Exact, without comparing all pairs. The sum is a convex function of the place:
    once the sum S and the slope g at a member c are known, every other member x
    has a sum of S + g (x - c) at least, and (the triangle inequality, summed up)
    one of |S - n d(x, c)| at least. Members whose bound lies above the best sum
    are out. A round sums up ``batch`` members per cluster in one pass: half of
    them next to where the sum falls to from the best one (at first the mean),
    where slopes are small, and those of least bound. Only those come to the
    driver, and equal members are one row with their number. Members with equal
    sums are told apart by their coordinates; rows that lack a value don't count.
    """
    columns = list(columns)
    given = assigned.select("cluster", *columns).dropna()
    rows = settle(given.groupBy("cluster", *columns).agg(F.count(F.lit(1)).alias("_times")), "members")
    times = F.sum("_times")
    members = rows.groupBy("cluster").agg(
        times.alias("n"), *[(F.sum(F.col(c) * F.col("_times")) / times).alias(c) for c in columns]
    )
    sizes = {r["cluster"]: r for r in members.collect()}
    if not sizes:
        return {}
    near = {k: np.array([float(r[c]) for c in columns]) for k, r in sizes.items()}
    best: dict[int, tuple[float, tuple[float, ...]]] = {}
    left = rows.select("cluster", *columns, F.lit(0.0).alias("_low"))
    while True:
        chosen = _chosen(left, near, columns, batch)
        if not chosen:
            return {k: p for k, (_, p) in best.items()}
        sums = _distance_sums(rows, chosen, columns)
        for k, found in sums.items():
            at = min((s, tuple(map(float, p))) for p, s, _, _ in found)
            if k not in best or at < best[k]:
                best[k] = at
                near[k] = next(fall for p, _, _, fall in found if tuple(map(float, p)) == at[1])
        known = {
            k: (np.array([p for p, *_ in found]), np.array([s for _, s, _, _ in found]),
                np.array([g for _, _, g, _ in found]), sizes[k]["n"], best[k][0] * (1 + 1e-9))
            for k, found in sums.items()
        }
        left = settle(_not_out(left, known, columns), "medoid-candidates")


def _chosen(left: DataFrame, near: dict, columns: list[str], batch: int) -> dict[int, np.ndarray]:
    """Per cluster up to ``batch`` candidates, those next to its place in ``near`` and those of least bound."""
    spark = left.sparkSession
    places = spark.createDataFrame([(k, *map(float, p)) for k, p in near.items()], ["_k", *[f"_to_{c}" for c in columns]])
    way = sum((F.pow(F.col(c) - F.col(f"_to_{c}"), 2) for c in columns), F.lit(0.0))
    seen = left.join(F.broadcast(places), F.col("cluster") == F.col("_k")).select("cluster", *columns, "_low", way.alias("_way"))

    def first(order: list[str], n: int) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("cluster").orderBy(*order, *columns))
        return seen.withColumn("_rank", place).where(F.col("_rank") <= n).select("cluster", *columns)

    half = max(1, batch // 2)
    found = first(["_way"], half)
    if batch > half:
        found = found.union(first(["_low", "_way"], batch - half)).distinct()
    chosen: dict[int, list] = {}
    for r in found.collect():
        chosen.setdefault(r["cluster"], []).append([float(r[c]) for c in columns])
    return {k: np.array(sorted(p)) for k, p in chosen.items()}


def _points(batch: pa.RecordBatch, columns: list[str], clusters: dict):
    """The rows of a batch by cluster: ``cluster, row numbers, coordinates``."""
    own = batch.column("cluster").to_numpy(zero_copy_only=False)
    places = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in columns])
    for k in clusters:
        at = np.flatnonzero(own == k)
        if len(at):
            yield k, at, places[at]


def _distance_sums(rows: DataFrame, chosen: dict, columns: list[str]) -> dict[int, list[tuple]]:
    """Per cluster ``(place, sum of distances, slope there, where the sum falls to)`` of the chosen members.

    The slope is that of the distances to other members, and the last the mean of
    those weighted by their nearness (Weiszfeld's step).
    """
    dims = len(columns)

    def run(batches):
        for batch in batches:
            times = batch.column("_times").to_numpy()
            out: dict[str, list] = {"cluster": [], "i": [], "sums": []}
            for k, at, own in _points(batch, columns, chosen):
                for i, c in enumerate(chosen[k]):
                    apart = np.sqrt(((own - c) ** 2).sum(axis=1))
                    weight = times[at] * np.divide(1.0, apart, out=np.zeros(len(apart)), where=apart > 0)
                    out["cluster"].append(k)
                    out["i"].append(i)
                    # distances, weights, and offsets by weight
                    out["sums"].append([float((times[at] * apart).sum()), float(weight.sum()), *(weight @ (own - c)).tolist()])
            yield pa.RecordBatch.from_pydict(
                out, pa.schema([("cluster", pa.int32()), ("i", pa.int32()), ("sums", pa.list_(pa.float64()))])
            )

    parts = rows.mapInArrow(run, "cluster int, i int, sums array<double>")
    whole = parts.groupBy("cluster", "i").agg(*[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(dims + 2)])
    sums: dict[int, list[tuple]] = {}
    for r in whole.collect():
        place = chosen[r["cluster"]][r["i"]]
        pull = np.array([r[f"s{j}"] for j in range(2, dims + 2)])
        fall = place + pull / r["s1"] if r["s1"] > 0 else place
        sums.setdefault(r["cluster"], []).append((place, r["s0"], -pull, fall))
    return sums


def _not_out(left: DataFrame, known: dict, columns: list[str]) -> DataFrame:
    """The candidates not summed up yet whose bound, raised by what is ``known``, reaches the best sum."""

    def run(batches):
        for batch in batches:
            low = batch.column("_low").to_numpy().copy()
            keep = np.zeros(batch.num_rows, dtype=bool)
            for k, at, own in _points(batch, columns, known):
                places, sums, slopes, n, best = known[k]
                bound, new = low[at], np.ones(len(at), dtype=bool)
                for c, s, g in zip(places, sums, slopes):
                    off = own - c
                    apart = np.sqrt((off**2).sum(axis=1))
                    bound = np.maximum(bound, np.maximum(s + off @ g, np.abs(s - n * apart)))
                    new &= apart > 0
                low[at] = bound
                keep[at] = new & (bound <= best)
            kept = [batch.column(c) for c in ("cluster", *columns)]
            whole = pa.RecordBatch.from_arrays([*kept, pa.array(low)], names=["cluster", *columns, "_low"])
            yield whole.filter(pa.array(keep))

    return left.mapInArrow(run, left.schema)


def _nearest_members(rows, targets, columns, clusters=None) -> list[tuple[float, ...]]:
    """For each target the row nearest to it, among the target's cluster if one is named.

    Equally near rows are told apart by their coordinates.
    """
    point = F.struct(*[F.col(c).alias(c) for c in columns])
    picks = []
    for i, target in enumerate(targets):
        dist = squared_distance([F.col(c) for c in columns], target)
        candidate = F.struct(dist.alias("d"), point.alias("p"))
        if clusters is not None:
            candidate = F.when(F.col("cluster") == clusters[i], candidate)
        picks.append(F.min(candidate).alias(f"m{i}"))
    found = rows.agg(*picks).first()
    medoids = [tuple(found[f"m{i}"]["p"]) for i in range(len(targets))]
    return sorted(set(medoids))
