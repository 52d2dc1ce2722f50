"""Connected components by alternating stars, each round a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.session import settle


#: Tasks that share one node's links; a hub's go to all of them.
SHARES = 64


def with_least(pairs: DataFrame) -> DataFrame:
    """``u, v, m``: every pair with the least ``v`` of its ``u``.

    Pairs are dealt by ``u`` and a share of ``v``: minima of shares are combined
    per node and carried back to the shares, at most ``SHARES`` rows a node, so
    that no task holds all links of a hub.
    """
    dealt = pairs.withColumn("share", F.pmod(F.hash("v"), F.lit(SHARES)))
    parts = dealt.groupBy("u", "share").agg(F.min("v").alias("m"))
    whole = parts.groupBy("u").agg(F.min("m").alias("m"), F.collect_set("share").alias("shares"))
    back = whole.select("u", "m", F.explode("shares").alias("share"))
    return dealt.join(back, ["u", "share"]).select("u", "v", "m")


def large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = with_least(edges.union(edges.select("v", "u")))
    return both.where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Hang a node's smaller neighbours, and the node itself, on the smallest of them."""
    down = with_least(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    moved = down.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(down.where("v = m").select("u", "v"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` (longs) of every node that has a link: the smallest node it reaches.

    Loops, repeated links and an empty frame are fine; rows with a null end are
    ignored. Each round only sees narrow id pairs, a hub's dealt to many tasks.
    Raises if the links have not become stars after ``max_rounds``.
    """
    current = settle(edges.toDF("u", "v").where("u <> v").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        current = settle(small_star(large_star(current)).distinct(), "stars")
        mark = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if mark == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
