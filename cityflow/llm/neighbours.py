"""Embedding near-dedup by collision-counting projections.

Vectors are projected on many random lines. On a line, a vector's window holds
those whose projection lies within ``width`` of its own; a pair that shares
windows on enough lines is verified by its cosine. Any line may miss: the one
that orders a cell is looked along twice as far. For a pair at the
threshold the number of shared windows is binomial, so the least count is
chosen from the wanted recall.

One line alone separates little: a window that keeps a pair at cosine 0.9 keeps
half of all others. So windows are only looked at within cells: in each of
several tables, a cell is a product of intervals on a few lines, and the number
of tables is again chosen from the wanted recall.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.components import components
from cityflow.llm.pairs import arranged, merge, spread, whole_groups, windows
from cityflow.session import settle

LINES = 32


def phi(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def in_cell(distance: float, width: float) -> float:
    """Chance that two points at a distance fall into one interval of a line's grid."""
    r = width / distance
    return 2 * phi(r) - 1 - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


@dataclass(frozen=True)
class Plan:
    """Lines per cell, tables, window width and least count for ``n`` vectors.

    ``reach`` is the window of the line that orders a cell: 1 in 15,000 pairs at
    the threshold lies further apart. ``width`` holds for the count over all lines.
    """

    per_cell: int
    tables: int
    interval: float
    width: float
    count: int
    reach: float

    @staticmethod
    def of(n: int, cosine: float, recall: float = 0.995, mates: float = 8.0, interval: float = 2.0) -> Plan:
        """Cells get so many lines that a random vector has about ``mates`` others in its cell."""
        near, far = math.sqrt(2 - 2 * cosine), math.sqrt(2)
        p, q = in_cell(near, interval), in_cell(far, interval)
        per_cell = max(1, math.ceil(math.log(max(n, 2) / mates) / -math.log(q)))
        tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - p**per_cell)))
        width = 2 * near
        hit = 2 * phi(width / near) - 1
        chance, count = 0.0, 0
        while count < LINES:
            chance += math.comb(LINES, count) * hit**count * (1 - hit) ** (LINES - count)
            if chance > (1 - recall) / 10:
                break
            count += 1
        return Plan(per_cell, tables, interval, width, count, 4 * near)


def directions(size: int, columns: int, label: int) -> np.ndarray:
    return np.random.default_rng([label, size, columns]).standard_normal((size, columns))


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of vectors that are not null, not zero, and hold finite numbers only."""
    v = F.col("embedding")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    return vectors.select("vec_id", v.alias("v")).where(
        v.isNotNull() & F.coalesce(good, F.lit(False)) & F.coalesce(some, F.lit(False))
    )


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors.astype(np.float64)
    scaled = scaled / np.abs(scaled).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def by_length(column: pa.Array):
    """Positions and matrix of the vectors of each length in an Arrow list column."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy()
    sizes = np.diff(offsets)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield int(size), at, flat[offsets[at][:, None] + np.arange(size)]


def cells(classes: DataFrame, plan: Plan) -> DataFrame:
    """``rep, keys``: the cell of each vector in every table."""

    def run(batches):
        for batch in batches:
            keys = np.zeros((batch.num_rows, plan.tables), dtype=np.int32)
            for size, at, matrix in by_length(batch.column("v")):
                lines = directions(size, plan.tables * plan.per_cell, 1)
                shift = np.random.default_rng([2, size]).random(lines.shape[1])
                place = np.floor(unit(matrix) @ lines / plan.interval + shift).astype(np.int64)
                place = place.reshape(len(at), plan.tables, plan.per_cell)
                mixed = np.full((len(at), plan.tables), size, dtype=np.uint64)
                for k in range(plan.per_cell):
                    mixed = (mixed ^ place[:, :, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    mixed ^= mixed >> np.uint64(29)
                keys[at] = (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)
            flat = pa.ListArray.from_arrays(
                np.arange(0, keys.size + 1, plan.tables, dtype=np.int32), keys.reshape(-1)
            )
            yield pa.RecordBatch.from_arrays([batch.column("rep"), flat], names=["rep", "keys"])

    return classes.select("rep", "v").mapInArrow(run, "rep long, keys array<int>")


def links(classes: DataFrame, plan: Plan, cosine: float, limit: int = 4096) -> DataFrame:
    """``rep, other, n``: per cell, the copies newly linked to each class, and a star of links.

    A pair found in several tables counts in the first table it shares only:
    each row carries its cells of all tables. ``n`` is the number of vectors
    linked to ``rep`` in the cell, ``other`` the smallest class of its part there.
    """
    keyed = settle(cells(classes, plan), "cells")
    placed = keyed.select("rep", F.posexplode("keys").alias("table", "cell"))
    placed = placed.select("rep", "table", F.xxhash64("table", "cell").alias("key"))
    # only ids travel until it is known which cells have more than one vector
    whole = classes.join(keyed, "rep")
    rows = arranged(spread(placed, "key", "rep", limit).join(whole, "rep"))

    def compare(batches):
        for part in whole_groups(batches, rows=8192):
            part = part.combine_chunks()
            lists = part.column("v").combine_chunks()
            found = []
            for size, at, matrix in by_length(lists):
                found.append(compare_group(part, at, unit(matrix), size))
            rep = np.concatenate([f[0] for f in found])
            other = np.concatenate([f[1] for f in found])
            n = np.concatenate([f[2] for f in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep), pa.array(other), pa.array(n)], names=["rep", "other", "n"]
            )

    def compare_group(part, at, vectors, size):
        take = lambda c: part.column(c).to_numpy(zero_copy_only=False)[at]
        group, rep, table, side, cross, copies = map(take, ("group", "rep", "table", "side", "cross", "copies"))
        keys = np.stack(part.column("keys").to_numpy(zero_copy_only=False)[at]) if len(at) else np.zeros((0, plan.tables))
        spots = (vectors @ directions(size, LINES, 3)).astype(np.float32)
        order = np.lexsort((spots[:, 0], group))
        group, rep, table, side, cross, copies, keys, spots, vectors = (
            a[order] for a in (group, rep, table, side, cross, copies, keys, spots, vectors)
        )
        total = np.zeros(len(rep), dtype=np.int64)
        labels = np.arange(len(rep))
        for left, right in windows(group, spots[:, 0], plan.reach):
            keep = ~cross[left] | (side[left] != side[right])
            left, right = left[keep], right[keep]
            shared = (np.abs(spots[left] - spots[right]) <= plan.width).sum(axis=1)
            left, right = left[shared >= plan.count], right[shared >= plan.count]
            near = np.einsum("ij,ij->i", vectors[left], vectors[right]) >= cosine
            left, right = left[near], right[near]
            if not len(left):
                continue
            first = (keys[left] == keys[right]).argmax(axis=1)
            fresh = first == table[left]
            left, right = left[fresh], right[fresh]
            np.add.at(total, left, copies[right])
            np.add.at(total, right, copies[left])
            labels = merge(labels, left, right)
        hit = np.flatnonzero(total)
        # positions follow the window order; a part is named by its smallest class
        least = rep.copy()
        np.minimum.at(least, labels, rep)
        return rep[hit], least[labels[hit]], total[hit]

    return rows.mapInArrow(compare, "rep long, other long, n long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, recall: float = 0.995, limit: int = 4096) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors``.

    Equal vectors form one class and link with each other (a copy has cosine 1),
    classes link by cosine in double precision. Vectors that are null, zero,
    hold null or non-finite components link with nothing; vectors of
    different lengths never link. A null vec_id is carried: its row links, but
    names no component unless no id is known, where the component is null.
    Repeated rows count as other vectors, and so do rows that repeat an id. An empty table gives an empty result.
    """
    good = usable(vectors)
    # a class is named by a number of its own, fixed as the table is written: one
    # vec_id may have several vectors; the smallest id counts at the end only
    classes = settle(
        good.groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
        .withColumn("rep", F.monotonically_increasing_id())
        .select("rep", "least", "copies", "v"),
        "classes",
    )
    plan = Plan.of(classes.count(), cosine, recall)
    narrow = classes.select("rep", "copies", "v")
    found = settle(links(narrow, plan, cosine, limit), "vector-links")
    parts = components(found.where("rep <> other").select("rep", "other"))
    linked = found.groupBy("rep").agg(F.sum("n").alias("n"))
    named = (
        classes.join(linked, "rep", "left")
        .join(parts, F.col("rep") == F.col("node"), "left")
        .select("v", "least", F.coalesce("component", "rep").alias("part"),
                (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    smallest = named.groupBy("part").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "part").select("v", "component_id", "n_links")
    ids = vectors.select("vec_id", F.col("embedding").alias("v"))
    out = ids.join(named, "v", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
