"""Radio channel statistics: parsing, signal detection, mean power and congestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.functions.text import attribute, number, payload_text
from cityflow.functions.time import window_end, window_start
from cityflow.operators.windows import Mean, Total, hopping, window_of
from cityflow.options import PEAK_THRESHOLD, RADIO_HOP, Hop


def parse_samples(messages: DataFrame, legacy_defaults: bool = False) -> DataFrame:
    """Messages to radio samples, with the reason why a sample is unusable, if any.

    A message lacking its payload becomes -1.0 under ``legacy_defaults`` and is
    reported as ``missing data`` otherwise. Where ``ts`` is there, a null one is a fault.
    """
    text = payload_text()
    if legacy_defaults:
        text = F.coalesce(text, F.lit("-1.0"))
    freq_text = attribute("center_freq")
    fault = (
        F.when(text.isNull(), "missing data")
        .when(number(text).isNull(), "bad data")
        .when(freq_text.isNull(), "missing center_freq")
        .when(number(freq_text).isNull(), "bad center_freq")
    )
    if "ts" in messages.columns:  # without a time a sample belongs to no window
        fault = fault.when(F.col("ts").isNull(), "bad timestamp")
    kept = [c for c in messages.columns if c not in ("data", "attributes")]
    return messages.select(
        *kept,
        F.coalesce(attribute("localdatetime"), F.lit("")).alias("localdatetime"),
        number(freq_text).alias("center_freq"),
        number(attribute("sample_rate")).alias("sample_rate"),
        number(text).alias("data"),
        fault.alias("fault"),
    )


def good_samples(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("fault").isNull()).drop("fault")


def bad_samples(parsed: DataFrame) -> DataFrame:
    """Quarantine: samples that cannot be keyed or measured."""
    return parsed.filter(F.col("fault").isNotNull())


def is_signal(threshold: float) -> Column:
    """At or above the threshold. Spark orders NaN above every number; it is no signal."""
    return (F.col("data") >= F.lit(threshold)) & ~F.isnan("data")


def detect_signals(samples: DataFrame, threshold: float = PEAK_THRESHOLD) -> DataFrame:
    """Samples at or above the threshold."""
    return samples.filter(is_signal(threshold))


def mark_peaks(signals: DataFrame) -> DataFrame:
    """Every detected signal counts as one peak."""
    return signals.withColumn("peak", F.lit(1.0))


def _peak(threshold: float) -> Column:
    return F.when(is_signal(threshold), F.lit(1.0))


def channel_stats(
    samples: DataFrame, threshold: float = PEAK_THRESHOLD, hop: Hop = RADIO_HOP
) -> DataFrame:
    """Mean power and peak count per window and frequency, in one pass.

    Every sample counts towards the mean, so the mean side is never empty and
    the outer join of both sides is one conditional aggregation: one scan and
    one shuffle. ``congestion`` is null where no sample was a peak.
    """
    return hopping(
        samples,
        hop,
        ["center_freq"],
        {"channel_avg": Mean(F.col("data")), "congestion": Total(_peak(threshold))},
    )


def channel_average(samples: DataFrame, hop: Hop = RADIO_HOP) -> DataFrame:
    return samples.groupBy(window_of(hop), "center_freq").agg(F.avg("data").alias("channel_avg"))


def channel_congestion(peaks: DataFrame, hop: Hop = RADIO_HOP) -> DataFrame:
    return peaks.groupBy(window_of(hop), "center_freq").agg(F.sum("peak").alias("congestion"))


def join_channel_sides(congestion: DataFrame, average: DataFrame) -> DataFrame:
    """Full outer join of two independently produced sides on window and frequency.

    Both sides hold one row per group by now, so no key can be hot. On streams
    the window carries the watermark that lets unmatched rows out.
    """
    return average.join(congestion, ["window", "center_freq"], "full_outer")


def channel_stats_joined(
    samples: DataFrame, threshold: float = PEAK_THRESHOLD, hop: Hop = RADIO_HOP
) -> DataFrame:
    """`channel_stats` by way of `join_channel_sides`."""
    peaks = mark_peaks(detect_signals(samples, threshold))
    return join_channel_sides(channel_congestion(peaks, hop), channel_average(samples, hop))


def with_bounds(stats: DataFrame) -> DataFrame:
    """Window bounds as UTC strings."""
    return stats.withColumn("start", window_start()).withColumn("end", window_end())


def result_json(stats: DataFrame) -> DataFrame:
    """One JSON document per channel result, keyed by frequency.

    Each side is a list holding one element, or none where the side is absent.
    """

    def side(value: str) -> Column:
        one = F.array(
            F.struct(
                F.col(value).alias("value"), window_start().alias("start"), window_end().alias("end")
            )
        )
        return F.when(F.col(value).isNotNull(), one).otherwise(F.array())

    # Hertz are printed as a plain decimal where one digit says it all.
    hertz = F.col("center_freq")
    plain = F.format_string("%.1f", hertz)
    freq = F.when(plain.cast("double") == hertz, plain).otherwise(hertz.cast("string"))
    both = F.struct(
        side("congestion").alias("congestion"), side("channel_avg").alias("average")
    )
    return stats.select(F.to_json(F.create_map(freq, both)).alias("value"))


def sample_channels(
    frames: DataFrame, delay: Hop, attribute_name: str = "average", value: str = "data"
) -> DataFrame:
    """One row per ``delay`` and frequency: the average, max or min of what arrived."""
    functions = {"average": F.avg, "max": F.max, "min": F.min}
    if attribute_name not in functions:
        raise ValueError(f"attribute must be one of {sorted(functions)}, not {attribute_name!r}")
    return frames.groupBy(window_of(delay), "center_freq").agg(
        functions[attribute_name](value).alias("data")
    )
