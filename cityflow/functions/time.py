"""Timestamp encodings, local time, bucket keys, repetition and window bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cityflow.options import LOCAL_OFFSET_HOURS, LOCAL_ZONE

STAMP = "yyyy-MM-dd HH:mm:ss"
MINUTE_STAMP = "yyyy-MM-dd-HH-mm"
SECOND_STAMP = "yyyy-MM-dd-HH-mm-ss"


def event_time(text: Column, encoding: str) -> Column:
    """Text to timestamp; null on bad input.

    ``encoding`` is ``rfc3339``, ``epoch_ms``, ``epoch_s``, or one of the
    dashed forms ``minute`` (``yyyy-MM-dd-HH-mm``) and ``second``, or ``stamp``
    (``yyyy-MM-dd HH:mm:ss``), or ``http`` (a Date header, with or without its
    name and weekday).
    """
    if encoding == "rfc3339":
        return text.try_cast("timestamp")
    if encoding == "epoch_ms":
        return F.timestamp_millis(text.try_cast("long"))
    if encoding == "epoch_s":
        return F.timestamp_seconds(text.try_cast("double"))
    if encoding == "http":
        bare = F.regexp_replace(text, r"^(Date: )?([A-Za-z]{3}, )?", "")
        return F.try_to_timestamp(bare, F.lit("dd MMM yyyy HH:mm:ss z"))
    patterns = {"minute": MINUTE_STAMP, "second": SECOND_STAMP, "stamp": STAMP}
    if encoding not in patterns:
        raise ValueError(f"unknown timestamp encoding: {encoding}")
    return F.try_to_timestamp(text, F.lit(patterns[encoding]))


def local_time(ts: Column, mode: str = "zone", zone: str = LOCAL_ZONE) -> Column:
    """UTC to local time: ``zone`` follows daylight saving, ``fixed`` is always UTC-4."""
    if mode == "zone":
        return F.from_utc_timestamp(ts, zone)
    if mode == "fixed":
        return ts + F.make_dt_interval(F.lit(0), F.lit(LOCAL_OFFSET_HOURS))
    raise ValueError(f"unknown local time mode: {mode}")


def bucket_key(ts: Column) -> Column:
    """Ten-minute bucket: ``yyyy-MM-dd-HH-mm`` without its last digit."""
    return F.substring(F.date_format(ts, MINUTE_STAMP), 1, 15)


def repeats(ts: str, every: int = 10, span: int = 600) -> Column:
    """A reading's times when it is repeated every ``every`` seconds for ``span`` seconds."""
    return F.expr(
        f"sequence({ts}, {ts} + INTERVAL {span - every} SECONDS, INTERVAL {every} SECONDS)"
    )


def window_start(window: str = "window") -> Column:
    return F.date_format(F.col(f"{window}.start"), STAMP)


def window_end(window: str = "window") -> Column:
    return F.date_format(F.col(f"{window}.end"), STAMP)
