"""Comparing the members of many groups without one task holding an unbounded group.

``spread`` brings rows of a key together; a key with more rows than ``limit``
is cut into blocks, and each pair of blocks becomes a group of its own, so the
largest group a task sees has twice ``limit`` rows however hot the key is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(rows: DataFrame, key: str, ident: str, limit: int = 8192) -> DataFrame:
    """Rows whose ``key`` occurs more than once, without ``key``; see ``arranged``.

    Adds ``group`` (long), ``side`` (block of the row) and ``cross`` (the group
    pairs two blocks: only pairs of different sides belong to it).
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("in_key")).where("in_key > 1")
    blocks = F.ceil(F.col("in_key") / limit).cast("int")
    sided = (
        rows.join(counts, key)
        .withColumn("blocks", blocks)
        .withColumn("side", F.pmod(F.hash(ident), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    low, high = F.least("side", "other"), F.greatest("side", "other")
    return (
        sided.withColumn("group", F.xxhash64(key, low, high))
        .withColumn("cross", low != high)
        .drop("in_key", "blocks", "other", key)
    )


def arranged(rows: DataFrame) -> DataFrame:
    """Rows of a group in one partition, one after the other."""
    return rows.repartition("group").sortWithinPartitions("group")


def whole_groups(
    batches: Iterable[pa.RecordBatch], key: str = "group", rows: int = 20_000
) -> Iterator[pa.Table]:
    """The sorted stream again, in tables that never cut a group in two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        joined = pa.Table.from_batches(held)
        keys = joined.column(key).to_numpy()
        # the last group starts where its key is first seen
        cut = int(np.argmax(keys == keys[-1])) if keys[0] != keys[-1] else 0
        if cut:
            yield joined.slice(0, cut)
        held = joined.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def windows(
    group: np.ndarray, line: np.ndarray, width: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions in one group whose ``line`` values differ by ``width`` at most.

    Rows must be sorted by (group, line). Yields the pairs by distance in the
    order: all neighbours, all at two places, and so on until a window is left.
    """
    left = np.arange(len(group))
    for step in range(1, len(group)):
        left = left[left + step < len(group)]
        right = left + step
        near = (group[left] == group[right]) & (line[right] - line[left] <= width)
        left = left[near]  # a row past its window at this distance is past it further on
        if not len(left):
            return
        yield left, left + step


def merge(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each position over the given links."""
    while True:
        least = np.minimum(labels[left], labels[right])
        new = labels.copy()
        np.minimum.at(new, labels[left], least)
        np.minimum.at(new, labels[right], least)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, labels):
            return labels
        labels = new
