"""Mixing sources to target weights.

Words are summed per source, targets are filled up to the sources' weights, and
a source's repetition rate is target / size. Each document is then emitted
floor(rate) times, plus once more if a hash of its id, read as a number in
[0, 1), lies below the rate's fraction: a Bernoulli draw that every run repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityflow.llm.common import WORD
from cityflow.session import settle

SEED = "mix-1"


def words(text: str | Column = "text") -> Column:
    """Number of words of a text; null: 0."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: str | Column = "doc_id", seed: str = SEED) -> Column:
    """A number in [0, 1) from 52 bits of a hash of seed and id; a null id counts as one id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.concat(F.lit(seed + ":"), F.coalesce(column.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def cycled_weights(sizes: DataFrame, cycle: int = 3) -> DataFrame:
    """Adds ``weight``: 1, 2 … ``cycle``, repeating, over sources by code point, null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    return sizes.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("long"))


def targets(sizes: DataFrame, cap: int = 3) -> DataFrame:
    """Adds ``target`` to rows ``source, source_size, weight``: one row per source.

    All words are shared by weight; a source stops at ``cap`` times its size and
    the excess goes to the others by weight, until none is above. That is the
    level L with sum(min(cap * size, L * weight)) = sum(size): sources in order
    of cap * size / weight fill up first, so L is found from running sums over
    the sources (a table of one row per source, not of documents).
    """
    total = Window.partitionBy()
    room = F.col("source_size") * cap
    ratio = room / F.col("weight")
    upto = Window.orderBy("ratio", "weight", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    level = (F.col("all_size") - F.col("room_to") + F.col("room")) / (
        F.col("all_weight") - F.col("weight_to") + F.col("weight")
    )
    ranked = (
        sizes.withColumn("room", room)
        .withColumn("ratio", ratio)
        .withColumn("all_size", F.sum("source_size").over(total))
        .withColumn("all_weight", F.sum("weight").over(total))
        .withColumn("room_to", F.sum("room").over(upto))
        .withColumn("weight_to", F.sum("weight").over(upto))
        # the level if just those before this source are full; it rises while sources fill
        # up and falls after, so the true one is the greatest
        .withColumn("level", level)
        .withColumn("full", F.col("ratio") <= F.col("level"))
    )
    found = F.max(F.when(~F.col("full"), F.col("level"))).over(total)
    return ranked.withColumn("found", found).select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("full"), F.col("room").cast("double"))
        .otherwise(F.col("found") * F.col("weight"))
        .alias("target"),
    )


def plan(docs: DataFrame, cap: int = 3, cycle: int = 3, seed: str = SEED) -> DataFrame:
    """``row`` (the document), ``size``, ``source_size``, ``target``, ``copies`` per document.

    Null texts have size 0; documents without a source form a source of their
    own; sources without words take no words. Rows that repeat an id repeat its
    draw. An empty table gives an empty result. ``row`` keeps any columns, so
    their names cannot clash with those made here.
    """
    sized = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").alias("id"),
        F.col("source").alias("source"),
        words().alias("size"),
    )
    sizes = docs.groupBy("source").agg(F.sum(words()).alias("source_size"))
    goal = settle(targets(cycled_weights(sizes, cycle), cap), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    extra = F.when(draw("id", seed) < rate - whole, 1).otherwise(0)
    goal = goal.withColumnRenamed("source", "goal_source")
    return sized.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).select(
        "row", "id", "size", "source_size", "target", (whole + extra).cast("long").alias("copies")
    )


def mix(docs: DataFrame, cap: int = 3, cycle: int = 3, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every document as often as its draw says, columns unchanged."""
    planned = plan(docs, cap, cycle, seed).where("copies > 0")
    return planned.select(
        "row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    ).select("row.*")


def report(docs: DataFrame, cap: int = 3, cycle: int = 3, seed: str = SEED) -> DataFrame:
    """What the mix takes of each document: ``doc_id, size, source_size, target, taken, copies``."""
    narrow = docs.select("doc_id", "text", "source")
    return plan(narrow, cap, cycle, seed).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


#: The report in SQL, over a table or subquery named by ``{docs}``.
REPORT_SQL = """
sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM {docs}),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, 3 * source_size AS room, CAST(3 * source_size AS DOUBLE) / weight AS ratio,
    CAST(sum(source_size) OVER () AS BIGINT) AS all_size, CAST(sum(weight) OVER () AS BIGINT) AS all_weight,
    CAST(sum(3 * source_size) OVER upto AS BIGINT) AS room_to, CAST(sum(weight) OVER upto AS BIGINT) AS weight_to
  FROM sizes
  WINDOW upto AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
levelled AS (
  SELECT *, CAST(all_size - room_to + room AS DOUBLE) / (all_weight - weight_to + weight) AS level FROM ranked),
goals AS (
  SELECT source, source_size, CASE WHEN ratio <= level THEN CAST(room AS DOUBLE)
    ELSE max(CASE WHEN ratio > level THEN level END) OVER () * weight END AS target
  FROM levelled),
rates AS (
  SELECT d.*, g.source_size, g.target,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
    CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
      / 4503599627370496.0::DOUBLE AS draw
  FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
report AS (
  SELECT doc_id, size, source_size, target,
    size * CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken,
    CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies
  FROM rates)
"""
