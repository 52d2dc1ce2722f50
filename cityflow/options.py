"""Typed parameters and their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field
from math import gcd


@dataclass(frozen=True)
class Hop:
    """A hopping window in whole seconds; ``slide == size`` is a tumbling window."""

    size: int
    slide: int

    @property
    def size_text(self) -> str:
        return f"{self.size} seconds"

    @property
    def slide_text(self) -> str:
        return f"{self.slide} seconds"

    @property
    def fan_out(self) -> int:
        """Windows that one row falls into, at most."""
        return -(-self.size // self.slide)

    @property
    def pane(self) -> int:
        """Longest tumbling window that never straddles a window edge."""
        return gcd(self.size, self.slide)


RADIO_HOP = Hop(60, 50)
FEATURE_HOP = Hop(30, 10)
FEATURE_HOP_LONG = Hop(45, 5)
POINT_TUMBLE = Hop(60, 60)
TWEET_TUMBLE = Hop(5, 5)

PEAK_THRESHOLD = 1.0

# Order of the coordinates of a feature point.
FEATURES = ("tweets", "precip", "temp", "uv", "wind", "traffic")
WEATHER_FEATURES = ("precip", "temp", "uv", "wind")


@dataclass(frozen=True)
class Bounds:
    """``low`` maps to 0 and ``high`` to 1; values outside are not clamped."""

    low: float
    high: float


@dataclass(frozen=True)
class NormalizerBounds:
    """Per-feature bounds fitted on ten-minute training buckets.

    Tweets are counted per window, so they are first brought to the training
    bucket: ``count * bucket_minutes / window_minutes``. With ``invert`` the
    tweet scale runs downwards (320 tweets map to 0, one tweet maps to 1).
    """

    # They must equal the published model's.
    tweets: Bounds = Bounds(1.0, 320.0)
    precip: Bounds = Bounds(0.0, 1.0)
    temp: Bounds = Bounds(44.035, 76.665)
    uv: Bounds = Bounds(0.0, 8.0)
    wind: Bounds = Bounds(0.23, 19.605)
    traffic: Bounds = Bounds(0.0362919, 0.2750302)
    bucket_minutes: float = 10.0
    window_minutes: float = 0.5
    invert: bool = True


@dataclass(frozen=True)
class MedoidModel:
    """Cluster centres in normalised feature space, in :data:`FEATURES` order."""

    # They must equal the published model's.
    centers: tuple[tuple[float, ...], ...] = field(
        default=(
            (0.102, 0.2, 0.43, 0.0, 0.297, 0.124),
            (0.248, 0.1, 0.346, 0.125, 0.173, 0.564),
            (0.491, 0.6, 0.568, 0.375, 0.355, 0.589),
            (0.529, 0.1, 0.526, 0.375, 0.446, 0.544),
            (0.473, 0.2, 0.434, 0.0, 0.118, 0.311),
            (0.611, 0.0, 0.672, 0.875, 0.418, 0.81),
            (0.397, 0.1, 0.426, 0.0, 0.434, 0.541),
        )
    )


# longitude/latitude boxes as sw_lon, sw_lat, ne_lon, ne_lat.
CITY_BOX = (-73.961967, 40.810504, -73.952234, 40.818940)
CITY_BOX_EXTENDED = (-73.964927, 40.807030, -73.952234, 40.818940)

LOCAL_ZONE = "America/New_York"
LOCAL_OFFSET_HOURS = -4
