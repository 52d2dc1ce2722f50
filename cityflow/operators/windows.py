"""Hopping, tumbling and chained event-time windows.

Spark aligns windows to the epoch, as the feeds expect. A hopping window copies
each row into ``size / slide`` windows; `paned` first folds rows into panes
that never straddle a window edge and copies only the folded rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.options import Hop


def window_of(hop: Hop, ts: str | Column = "ts") -> Column:
    if hop.size == hop.slide:
        return F.window(ts, hop.size_text)
    return F.window(ts, hop.size_text, hop.slide_text)


@dataclass(frozen=True)
class Total:
    """Sum of a numeric expression (null where nothing was summed)."""

    of: Column

    def parts(self, name: str) -> dict[str, Column]:
        return {f"{name}__s": F.sum(self.of)}

    def merged(self, name: str) -> Column:
        return F.sum(f"{name}__s")


@dataclass(frozen=True)
class Mean:
    """Average of a numeric expression over its non-null values."""

    of: Column

    def parts(self, name: str) -> dict[str, Column]:
        return {f"{name}__s": F.sum(self.of), f"{name}__n": F.count(self.of)}

    def merged(self, name: str) -> Column:
        return F.try_divide(F.sum(f"{name}__s"), F.sum(f"{name}__n"))


@dataclass(frozen=True)
class Count:
    """Number of non-null values; null, not zero, where there is none."""

    of: Column

    def parts(self, name: str) -> dict[str, Column]:
        return {f"{name}__n": F.count(self.of)}

    def merged(self, name: str) -> Column:
        return F.nullif(F.sum(f"{name}__n"), F.lit(0).cast("long"))


def _direct(measure: Total | Mean | Count) -> Column:
    if isinstance(measure, Total):
        return F.sum(measure.of)
    if isinstance(measure, Mean):
        return F.avg(measure.of)
    return F.nullif(F.count(measure.of), F.lit(0).cast("long"))


def hopping(
    df: DataFrame,
    hop: Hop,
    keys: Sequence[str],
    measures: Mapping[str, Total | Mean | Count],
    ts: str = "ts",
    paned: bool | None = None,
) -> DataFrame:
    """Aggregate ``measures`` per window and ``keys``; one row per non-empty group.

    ``paned=None`` uses panes in a batch where they save copying: when a row
    would fall into more than two windows. There both forms give the same rows,
    and both aggregate before they shuffle, so a hot key or window reaches its
    reducer as one partial row per task.

    A stream is never paned unless asked: a pane closes before the last window it
    feeds, so a row late for its pane is lost to windows that are still open.
    ``paned=True`` on a stream holds less state, needs append mode, and loses no
    row only if the watermark allows a lateness of ``hop.size`` more than rows have.
    """
    if paned is None:
        paned = hop.fan_out > 2 and not df.isStreaming
    if not paned:
        aggs = [_direct(m).alias(name) for name, m in measures.items()]
        return df.groupBy(window_of(hop, ts), *keys).agg(*aggs)
    parts = [
        part.alias(label) for name, m in measures.items() for label, part in m.parts(name).items()
    ]
    panes = df.groupBy(F.window(ts, f"{hop.pane} seconds").alias("pane"), *keys).agg(*parts)
    merged = [m.merged(name).alias(name) for name, m in measures.items()]
    return panes.groupBy(window_of(hop, F.window_time("pane")), *keys).agg(*merged)


def rewindow(windowed: DataFrame, tumble: Hop, aggs: Sequence[Column], window: str = "window"):
    """Aggregate window results again by the time their window closed.

    A result carries the last instant of its window, so a hop ending exactly on
    a tumbling edge belongs to the earlier tumbling window.
    """
    closed = F.window_time(window)
    return windowed.groupBy(window_of(tumble, closed).alias("outer_window")).agg(*aggs)


def tumbling_counts(df: DataFrame, tumble: Hop, keys: Sequence[str] = (), ts: str = "ts"):
    """Row count per tumbling window."""
    return df.groupBy(window_of(tumble, ts), *keys).agg(F.count(F.lit(1)).alias("n"))
