"""Selective enrichment of a stream from a lookup table, in either operator order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LEVEL = 1000


def selected(value: Column, selectivity: float, max_level: int = MAX_LEVEL) -> Column:
    """True for the top ``selectivity`` share of a 0..``max_level`` scale."""
    return value >= F.lit(max_level - int(selectivity * max_level))


def unique_lookup(lookup: DataFrame, key: str) -> DataFrame:
    """The lookup with an error raised for any key that occurs twice."""
    record = F.struct(*[c for c in lookup.columns if c != key])
    repeated = F.raise_error(
        F.concat(F.lit("repeated lookup key: "), F.first(F.col(key)).cast("string"))
    )
    once = F.when(F.count(F.lit(1)) > 1, repeated).otherwise(F.lit(True))
    checked = lookup.groupBy(key).agg(F.first(record).alias("_rec"), once.alias("_once"))
    return checked.filter("_once").select(key, "_rec.*")


def _copies(records: DataFrame, salt: int) -> DataFrame:
    """Each record once per ``_salt`` from 0.

    By a join with the numbers, not by exploding them: Spark's estimate of the
    size then counts the copies, and only copies that are small are broadcast.
    """
    numbers = records.sparkSession.range(salt).select(F.col("id").cast("int").alias("_salt"))
    return records.crossJoin(F.broadcast(numbers))


def enrich(
    stream: DataFrame,
    lookup: DataFrame,
    key: str,
    on_missing: str = "drop",
    on_repeat: str = "error",
    salt: int = 1,
) -> DataFrame:
    """Inner join of a stream with a lookup keyed uniquely by ``key``.

    No broadcast is forced: Spark broadcasts the lookup while it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides,
    splitting skewed partitions at run time. Where adaptive splitting is not
    available, as in a streaming query, ``salt`` spreads every key over that
    many partitions at the price of that many copies of the lookup.

    ``on_missing="fail"`` raises for a stream row without a record;
    ``on_repeat="any"`` skips the uniqueness check of a trusted lookup.
    """
    if on_missing not in ("drop", "fail"):
        raise ValueError(f"on_missing must be 'drop' or 'fail', not {on_missing!r}")
    if on_repeat not in ("error", "any"):
        raise ValueError(f"on_repeat must be 'error' or 'any', not {on_repeat!r}")
    records = unique_lookup(lookup, key) if on_repeat == "error" else lookup
    keys = [key]
    left, right = stream, records
    if salt > 1:
        keys = [key, "_salt"]
        # by draw, not by value: equal rows spread too, and any draw joins alike
        spread = F.floor(F.rand(7) * salt).cast("int")
        left = stream.withColumn("_salt", spread)
        right = _copies(records, salt)
    if on_missing == "drop":
        return left.join(right, keys, "inner").drop("_salt")
    found = left.join(right.withColumn("_found", F.lit(True)), keys, "left")
    missing = F.raise_error(F.concat(F.lit("no record for key "), F.col(key).cast("string")))
    present = F.when(F.col("_found").isNull(), missing.cast("boolean")).otherwise(F.lit(True))
    return found.filter(present).drop("_found", "_salt")


NO_RECORD = "no record"


def enrich_or_fault(stream: DataFrame, lookup: DataFrame, key: str, salt: int = 1) -> DataFrame:
    """Every row of the stream with its record, or with ``fault`` set where there is none.

    Works on batches and streams (the lookup is a batch frame). A null key has no
    record. Repeated lookup keys are an error; ``salt`` as in :func:`enrich`.
    """
    records = unique_lookup(lookup, key).withColumn("_found", F.lit(True))
    left, keys = stream, [key]
    if salt > 1:
        keys = [key, "_salt"]
        left = stream.withColumn("_salt", F.floor(F.rand(7) * salt).cast("int"))
        records = _copies(records, salt)
    fault = F.when(F.col("_found").isNull(), F.lit(NO_RECORD)).alias("fault")
    joined = left.join(records, keys, "left")
    kept = [c for c in joined.columns if c not in ("_found", "_salt")]
    return joined.select(*kept, fault)


def filter_after_join(
    stream: DataFrame, lookup: DataFrame, key: str, value: str,
    before: float, after: float, max_level: int = MAX_LEVEL, **options,
) -> DataFrame:
    """Filter, enrich, filter again, as written; the optimizer moves the second filter down."""
    kept = stream.filter(selected(F.col(value), before, max_level))
    return enrich(kept, lookup, key, **options).filter(
        selected(F.col(value), after, max_level)
    )


def filter_before_join(
    stream: DataFrame, lookup: DataFrame, key: str, value: str,
    before: float, after: float, max_level: int = MAX_LEVEL, **options,
) -> DataFrame:
    """Both filters ahead of the join."""
    kept = stream.filter(selected(F.col(value), before, max_level)).filter(
        selected(F.col(value), after, max_level)
    )
    return enrich(kept, lookup, key, **options)


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def selectivity_sweep(
    stream: DataFrame, lookup: DataFrame, key: str, value: str,
    steps: Sequence[float], max_level: int = MAX_LEVEL, **options,
) -> DataFrame:
    """Enriched rows per selectivity, all steps counted in one pass over one join.

    ``selectivity`` is the share filtered out, as such sweeps are plotted.
    """
    widest = stream.filter(selected(F.col(value), max(steps), max_level))
    joined = enrich(widest, lookup, key, **options)
    counts = [
        F.struct(
            F.lit(round(1.0 - s, 1)).alias("selectivity"),
            F.count_if(selected(F.col(value), s, max_level)).alias("tuples"),
        )
        for s in steps
    ]
    return joined.agg(F.array(*counts).alias("steps")).select(F.inline("steps"))
