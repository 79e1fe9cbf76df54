"""Choosing rows: value filters, brushes, views, thinning, budgets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerspark.functions import geo
from layerspark.functions.hashing import stable_bucket
from layerspark.functions.widths import row_width

# Most values and most categories a data filter compares.
MAX_FILTER_VALUES = 4
MAX_CATEGORIES = 4


def range_filter(
    df: DataFrame,
    ranges: Mapping[str, tuple[float, float]],
    soft: Mapping[str, tuple[float, float]] | None = None,
    weight: str = "filter_weight",
) -> DataFrame:
    """Rows whose value lies in its range, bounds included, for one to four values.

    With a soft range inside the range, a weight falls from 1 at its edge to 0 at
    the edge of the range; weights of several values are multiplied.
    """
    if not 1 <= len(ranges) <= MAX_FILTER_VALUES:
        raise ValueError("a range filter compares 1 to 4 values")
    out = df
    for column, (low, high) in ranges.items():
        value = F.col(column)
        # NaN compares above every number, so the upper bound removes it.
        out = out.where(value.between(F.lit(low), F.lit(high)))
    if soft:
        total = F.lit(1.0)
        for column, (soft_low, soft_high) in soft.items():
            low, high = ranges[column]
            if not low <= soft_low <= soft_high <= high:
                raise ValueError(f"the soft range of {column!r} must lie inside its range")
            value, part = F.col(column).cast("double"), F.lit(1.0)
            if soft_low > low:
                part = F.least(part, (value - F.lit(low)) / F.lit(soft_low - low))
            if high > soft_high:
                part = F.least(part, (F.lit(high) - value) / F.lit(high - soft_high))
            total = total * part
        out = out.withColumn(weight, total)
    return out


def category_filter(df: DataFrame, keep: Mapping[str, Sequence]) -> DataFrame:
    """Rows whose category is among those kept; with several columns all must match."""
    if not 0 <= len(keep) <= MAX_CATEGORIES:
        raise ValueError("a category filter compares at most 4 columns")
    for column, values in keep.items():
        df = df.where(F.col(column).isin(list(values)))
    return df


def brush(
    df: DataFrame,
    center: tuple[float, float],
    radius_m: float,
    target: str = "source",
    source: tuple[str, str] = ("lon", "lat"),
    dest: tuple[str, str] | None = None,
    custom: tuple[str, str] | None = None,
) -> DataFrame:
    """Features within the radius of a pointer position.

    ``target`` says which point counts: ``source``, ``target``, ``source_target``
    (either end) or ``custom`` (a point of its own per row). A box test on the
    plain columns goes to the scan, the exact distance follows.
    """
    ends = {"source": [source], "target": [dest], "source_target": [source, dest], "custom": [custom]}
    if target not in ends or any(e is None for e in ends[target]):
        raise ValueError(f"brush target {target!r} needs its columns")
    box = geo.radius_box(center[0], center[1], radius_m)
    near = None
    for lon, lat in ends[target]:
        exact = geo.haversine_m(F.col(lon), F.col(lat), F.lit(center[0]), F.lit(center[1]))
        hit = geo.in_box(F.col(lon), F.col(lat), box) & (exact <= F.lit(float(radius_m)))
        near = hit if near is None else near | hit
    return df.where(near)


def in_view(
    df: DataFrame,
    view: Mapping[str, float],
    lon: str = "lon",
    lat: str = "lat",
    aspect: float = 1.0,
) -> DataFrame:
    """Rows inside the box a view state shows."""
    box = geo.view_box(view["longitude"], view["latitude"], view["zoom"], aspect)
    return df.where(geo.in_box(F.col(lon), F.col(lat), box))


def declutter(
    df: DataFrame,
    cell_degrees: float,
    priority: str,
    group: str | None = None,
    lon: str = "lon",
    lat: str = "lat",
    id_col: str = "feature_id",
) -> DataFrame:
    """One feature per grid cell and group: the highest priority, then the lowest id.

    Spark keeps the best row of each cell before the shuffle as well (window
    group limit), so a crowded cell does not gather in one task. Rows without a
    place share no cell with anything and are left out.
    """
    placed = df.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    keys = [
        *([F.col(group)] if group else []),
        F.floor((F.col(lon) + F.lit(180.0)) / F.lit(cell_degrees)),
        F.floor((F.col(lat) + F.lit(90.0)) / F.lit(cell_degrees)),
    ]
    best = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(priority), F.asc(id_col))
    return placed.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")


def fit_to_budget(
    df: DataFrame,
    max_bytes: int,
    id_col: str = "feature_id",
    width: Column | None = None,
    hex_digits: int = 4,
) -> DataFrame:
    """Fewer rows, so that the layer fits: the same rows in every run.

    Ids fall into 16**hex_digits buckets by hash. Bytes per bucket (a table of that
    fixed size) are summed in bucket order, and whole buckets are kept while the
    running total fits; a layer that fits is kept whole.
    """
    bucketed = df.withColumn("_bucket", stable_bucket(F.col(id_col), hex_digits))
    size = row_width(df.schema) if width is None else width
    sizes = bucketed.groupBy("_bucket").agg(F.sum(size.cast("double")).alias("_bytes"))
    running = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_over = (
        sizes.withColumn("_total", F.sum("_bytes").over(running))
        .where(F.col("_total") > F.lit(float(max_bytes)))
        .agg(F.coalesce(F.min("_bucket"), F.lit(16**hex_digits)).alias("cut"))
    )
    return bucketed.where(F.col("_bucket") < first_over.scalar()).drop("_bucket")


def coarsen(df: DataFrame, geometry: str, digits: int) -> DataFrame:
    """Coordinates rounded to some digits; repeated neighbours on a line dropped.

    A line that shrinks to one place keeps its two ends, so that it stays a line.
    """
    field = df.schema[geometry]
    depth = 0
    dtype = field.dataType
    while hasattr(dtype, "elementType"):
        depth, dtype = depth + 1, dtype.elementType
    rounded = _round(F.col(geometry), depth, digits)
    if depth == 2 and str((field.metadata or {}).get("ARROW:extension:name", "")).endswith("linestring"):
        rounded = _without_repeats(rounded)
    elif depth == 3:
        rounded = F.transform(rounded, _without_ring_repeats)
    return df.withColumn(geometry, rounded.alias(geometry, metadata=field.metadata or {}))


def to_float32(df: DataFrame, geometry: str) -> DataFrame:
    """Coordinates as 32-bit floats: half the bytes, about a metre of precision."""
    field = df.schema[geometry]
    kind = field.dataType.simpleString().replace("double", "float")
    return df.withColumn(
        geometry, F.col(geometry).cast(kind).alias(geometry, metadata=field.metadata or {})
    )


def _round(column: Column, depth: int, digits: int) -> Column:
    if depth == 1:
        return F.transform(column, lambda x: F.round(x, digits))
    return F.transform(column, lambda inner: _round(inner, depth - 1, digits))


def _without_repeats(line: Column) -> Column:
    kept = F.filter(line, lambda v, i: (i == 0) | (v != F.get(line, i - 1)))
    return F.when(F.size(kept) >= 2, kept).otherwise(F.array(line[0], F.element_at(line, -1)))


def _without_ring_repeats(ring: Column) -> Column:
    kept = F.filter(ring, lambda v, i: (i == 0) | (v != F.get(ring, i - 1)))
    return F.when(F.size(kept) >= 4, kept).otherwise(ring)
