"""Grid cells: statistics joined to cells, points rolled up to cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerspark.functions import geo
from layerspark.operators.skew import GROUP_ROWS, exact_percentiles

# Statistics of a roll-up, and its two percentiles.
STATISTICS = ("mean", "std", "min", "max", "p10", "p90")
LOW_SHARE, HIGH_SHARE = 0.1, 0.9


def attach_stats(cells: DataFrame, stats: DataFrame, key: str = "cell_id") -> DataFrame:
    """Cells with their statistics; cells without any are left out.

    The strategy is left to Catalyst and AQE: broadcast when one side turns out
    small, otherwise a sort-merge join whose overfull partitions are split.
    """
    return cells.join(stats, key, "inner")


def cell_rollup(
    df: DataFrame,
    cell: str,
    value: str,
    prefix: str = "",
    percentiles: bool = True,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Count and six statistics of a value per cell; null and NaN values are left out.

    The plain statistics combine before the shuffle, so a crowded cell costs one
    row per task; the percentiles go through ``exact_percentiles``, which ranks
    crowded cells without gathering them.
    """
    v = F.col(value).cast("double")
    clean = df.where(F.col(cell).isNotNull() & v.isNotNull() & ~F.isnan(v))
    plain = [
        F.count(F.lit(1)).alias(f"{prefix}count"),
        F.avg(v).alias(f"{prefix}mean"),
        F.stddev_pop(v).alias(f"{prefix}std"),
        F.min(v).alias(f"{prefix}min"),
        F.max(v).alias(f"{prefix}max"),
    ]
    if not percentiles:
        return clean.groupBy(cell).agg(*plain)
    names = [f"{prefix}p10", f"{prefix}p90"]
    return exact_percentiles(
        clean, [cell], value, [LOW_SHARE, HIGH_SHARE], names, group_rows, also=plain
    )


def geohash_rollup(
    df: DataFrame,
    length: int,
    value: str,
    lon: str = "lon",
    lat: str = "lat",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Roll-up per geohash; the text is made after grouping on the numeric code."""
    coded = df.select(geo.geohash_code(lon, lat, length).alias("_code"), value)
    rolled = cell_rollup(coded, "_code", value, group_rows=group_rows)
    return rolled.withColumn("cell", geo.geohash_text("_code", length)).drop("_code")


def h3_rollup(
    df: DataFrame, cell: str, resolution: int, value: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Roll-up of H3 cells (BIGINT, or hexadecimal text) to a coarser resolution."""
    ids: Column = F.col(cell)
    if dict(df.dtypes)[cell] == "string":
        ids = geo.h3_from_text(ids)
    coarse = df.select(geo.h3_parent(ids, resolution).alias("cell"), value)
    return cell_rollup(coarse, "cell", value, group_rows=group_rows)


def cell_layer(df: DataFrame, lon: str, lat: str, length: int) -> DataFrame:
    """Geohash of each point, as the accessor of a geohash layer."""
    return df.withColumn("get_geohash", geo.geohash(lon, lat, length))
