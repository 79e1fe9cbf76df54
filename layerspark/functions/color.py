"""Colour expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Green of the ramp, grey for a missing value, smallest span.
RAMP_GREEN = 80
MISSING_GREY = 128
MIN_SPAN = 1e-9


def pack(*channels: Column | str) -> Column:
    """Colour list from three or four channel columns."""
    return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("smallint") for c in channels])


def ramp(value: Column, low: Column, high: Column) -> Column:
    """Blue (low) to red (high), truncated to whole channel values; grey when missing."""
    missing = value.isNull() | F.isnan(value)
    t = F.least(
        F.greatest((value - low) / F.greatest(high - low, F.lit(MIN_SPAN)), F.lit(0.0)), F.lit(1.0)
    )

    def channel(scaled: Column) -> Column:
        # "missing" is tested first, so a NaN never reaches the cast.
        return F.when(missing, F.lit(MISSING_GREY)).otherwise(F.floor(scaled * 255.0)).cast("smallint")

    green = F.when(missing, F.lit(MISSING_GREY)).otherwise(F.lit(RAMP_GREEN)).cast("smallint")
    return F.array(channel(t), green, channel(F.lit(1.0) - t))


def shift_channel(color: Column, delta: int, channel: int) -> Column:
    """Move one channel by ``delta``, modulo 256."""
    return F.transform(
        color,
        lambda c, i: F.when(i == channel, F.pmod(c.cast("int") + F.lit(delta), F.lit(256)))
        .otherwise(c)
        .cast("smallint"),
    )
