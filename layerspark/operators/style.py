"""Colours and trip times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerspark.functions import color
from layerspark.operators.skew import GROUP_ROWS, exact_percentiles

# Percentiles of the colour ramp, start of the trip clock.
RAMP_LOW, RAMP_HIGH = 0.02, 0.98
TRIP_START = -16777216
_UNIT_MICROS = {"us": 1, "ms": 1_000, "s": 1_000_000}


def ramp_bounds(
    df: DataFrame,
    value: str,
    low: float = RAMP_LOW,
    high: float = RAMP_HIGH,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row: the exact low and high percentile of the value; NaN and null left out."""
    return exact_percentiles(df, [], value, [low, high], ["low", "high"], group_rows)


def color_ramp(
    df: DataFrame, value: str, name: str = "get_fill_color", bounds: DataFrame | None = None
) -> DataFrame:
    """Blue-to-red colour of a value between its percentile bounds.

    The bounds enter as a scalar subquery: computed once, no join.
    """
    bounds = ramp_bounds(df, value) if bounds is None else bounds
    edge = bounds.select(F.struct("low", "high").alias("b")).scalar()
    return (
        df.withColumn("_b", edge)
        .withColumn(name, color.ramp(F.col(value).cast("double"), F.col("_b.low"), F.col("_b.high")))
        .drop("_b")
    )


def recolor(df: DataFrame, column: str, delta: int, channel: int = 1) -> DataFrame:
    return df.withColumn(column, color.shift_channel(F.col(column), delta, channel))


def trip_clock(times: Column, unit: str) -> Column:
    """Whole units since the epoch of each time in a list."""
    if unit not in _UNIT_MICROS:
        raise ValueError(f"unit must be one of {sorted(_UNIT_MICROS)}")
    per = _UNIT_MICROS[unit]
    return F.transform(
        times,
        lambda t: F.floor(F.unix_micros(t.cast("timestamp")) / F.lit(per)).cast("long")
        if per > 1
        else F.unix_micros(t.cast("timestamp")),
    )


def finest_unit(df: DataFrame, column: str) -> str:
    """Finest of us, ms and s in which all times of a trip layer lie within a 32-bit float."""
    micros = F.transform(F.col(column), lambda t: F.unix_micros(t.cast("timestamp")))
    edges = df.select(F.array_min(micros).alias("a"), F.array_max(micros).alias("b")).agg(F.min("a"), F.max("b"))
    first, last = edges.first()
    span = 0 if first is None else last - first
    return next((u for u, per in (("us", 1), ("ms", 1000)) if span // per + 1 <= 1 << 25), "s")


def trip_times_to_float(
    df: DataFrame, column: str = "timestamps", unit: str | None = None, name: str = "get_timestamps"
) -> DataFrame:
    """Trip times as 32-bit floats that start at the fixed clock start.

    A float holds whole numbers exactly only within 2**24 of zero, so a span of
    more than 2**25 units fails with the unit to choose instead of losing order.
    Without a ``unit`` the finest one in which the span fits is taken.
    """
    if unit is None:
        unit = finest_unit(df, column)
    clocked = df.withColumn("_clock", trip_clock(F.col(column), unit))
    spans = clocked.agg(
        F.coalesce(F.min(F.array_min("_clock")), F.lit(0).cast("long")).alias("first"),
        F.coalesce(F.max(F.array_max("_clock")), F.lit(0).cast("long")).alias("last"),
    )
    span = spans.select(F.struct("first", "last").alias("s")).scalar()
    fits = (F.col("_s.last") - F.col("_s.first")) <= F.lit(1 << 25)
    text = f"trip times span more than 2**25 {unit}: choose a coarser unit (ms or s)"
    shifted = F.transform("_clock", lambda t: (t - F.col("_s.first") + F.lit(TRIP_START)).cast("float"))
    return (
        clocked.withColumn("_s", span)
        .withColumn(name, F.when(fits, shifted).otherwise(F.raise_error(F.lit(text))))
        .drop("_clock", "_s")
    )
