"""Synthetic layers, made by expressions on an id column: no data passes the driver."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerspark.functions import geo

# The box of generated points, clusters and jitter, grid extent and gap.
BOX = (-122.6, 37.6, -122.3, 37.9)
CLUSTERS = 20
JITTER = 0.01
GRID_SPAN = 0.4
GRID_FILL = 0.9
GRID_SHIFT = 0.05
HASH_DIGITS = 13


def uniform(id_col: Column, seed: int, stream: int) -> Column:
    """Number in [0, 1) from an id: the same in every run, engine and partitioning.

    The leading 52 bits of a digest of seed, stream and id, so that neighbouring ids
    and different streams have nothing in common.
    """
    text = F.concat(F.lit(f"{seed}/{stream}/"), id_col.cast("long").cast("string"))
    digits = F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(16**HASH_DIGITS))


def scatter_points(
    df: DataFrame, id_col: str, seed: int = 0, box: tuple[float, float, float, float] = BOX
) -> DataFrame:
    """Uniform places in a box with a colour (0 to 254 per channel) and a radius in [20, 200)."""
    i = F.col(id_col)
    west, south, east, north = box
    channel = lambda stream: F.floor(uniform(i, seed, stream) * F.lit(255.0)).cast("smallint")
    return df.withColumns(
        {
            "lon": F.lit(west) + uniform(i, seed, 0) * F.lit(east - west),
            "lat": F.lit(south) + uniform(i, seed, 1) * F.lit(north - south),
            "r": channel(2),
            "g": channel(3),
            "b": channel(4),
            "radius": (F.lit(20.0) + uniform(i, seed, 5) * F.lit(180.0)).cast("float"),
        }
    )


def gen_points(
    spark: SparkSession, n: int, seed: int = 0, box: tuple[float, float, float, float] = BOX
) -> DataFrame:
    return scatter_points(spark.range(n).withColumnRenamed("id", "feature_id"), "feature_id", seed, box)


def clustered_points(
    df: DataFrame,
    id_col: str,
    clusters: int = CLUSTERS,
    jitter: float = JITTER,
    seed: int = 0,
    box: tuple[float, float, float, float] = BOX,
) -> DataFrame:
    """Places around random centres with normal jitter; centres are expressions, not a join."""
    i = F.col(id_col)
    west, south, east, north = box
    cluster = F.floor(uniform(i, seed, 0) * F.lit(float(clusters))).cast("long")
    center_lon = F.lit(west) + uniform(cluster, seed + 1, 1) * F.lit(east - west)
    center_lat = F.lit(south) + uniform(cluster, seed + 1, 2) * F.lit(north - south)
    # Two independent normal numbers from two uniform ones.
    size = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(i, seed, 3)))
    angle = F.lit(2 * math.pi) * uniform(i, seed, 4)
    return df.withColumns(
        {
            "cluster": cluster,
            "lon": center_lon + size * F.cos(angle) * F.lit(jitter),
            "lat": center_lat + size * F.sin(angle) * F.lit(jitter),
        }
    )


def gen_clustered(
    spark: SparkSession,
    n: int,
    clusters: int = CLUSTERS,
    jitter: float = JITTER,
    seed: int = 0,
) -> DataFrame:
    ids = spark.range(n).withColumnRenamed("id", "feature_id")
    return clustered_points(ids, "feature_id", clusters, jitter, seed)


def square_grid(
    df: DataFrame, id_col: str, side: int, shift_seed: int = 0, name: str = "geometry"
) -> DataFrame:
    """Small squares on a ``side`` wide grid, numbered row by row from 0."""
    step = GRID_SPAN / side
    i = F.col(id_col).cast("long")
    column, row = F.pmod(i, F.lit(side).cast("long")), F.floor(i / F.lit(side))
    west = F.lit(BOX[0] + GRID_SHIFT * shift_seed) + column * F.lit(step)
    south = F.lit(BOX[1]) + row * F.lit(step)
    ring = geo.square_ring(west, south, GRID_FILL * step)
    return df.withColumn(name, geo.as_geometry(F.array(ring), name, "polygon"))


def gen_square_grid(spark: SparkSession, n: int, shift_seed: int = 0) -> DataFrame:
    """The first ``n`` squares of the smallest square grid that holds them."""
    side = max(1, math.ceil(math.sqrt(n)))
    ids = spark.range(n).withColumnRenamed("id", "feature_id")
    return square_grid(ids, "feature_id", side, shift_seed)
