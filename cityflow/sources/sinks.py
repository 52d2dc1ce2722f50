"""Where results go: batch writers here, streaming writers in ``cityflow.streaming``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_sharded(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """One file per partition, no extra shuffle."""
    df.write.mode(mode).format(fmt).save(path)


def write_count(counts: DataFrame, path: str) -> None:
    """A one-row count as a single text file."""
    counts.select(F.col(counts.columns[0]).cast("string").alias("value")).coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """Scores as CSV with a header."""
    scores.write.mode("overwrite").option("header", True).csv(path)


def tap(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """Row count (and any further aggregates) measured while the frame is being used.

    Costs no job of its own; read the values from the observation afterwards.
    """
    seen = Observation(name)
    extra = [expr.alias(label) for label, expr in metrics.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra), seen


def to_payload(df: DataFrame, text: str = "text") -> DataFrame:
    """Text column to the binary ``value`` column a broker sink expects."""
    return df.select(F.encode(F.col(text), "UTF-8").alias("value"))


def radio_table_rows(samples: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Radio samples in the nested warehouse shape; rows lacking a required field are left out.

    ``keep`` names columns that stay beside it, such as the one the table is partitioned by.
    """
    complete = samples.filter(F.col("data").isNotNull() & F.col("localdatetime").isNotNull())
    return complete.select(
        *keep, "data", F.struct("localdatetime", "center_freq", "sample_rate").alias("attribute")
    )
