"""From map clicks and hovers back to source rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerspark.functions.text import tooltip_text
from layerspark.operators import near
from layerspark.session import broadcast_if_small, materialize
from layerspark.sinks.rows import StoredRows


def resolve_picks(
    picks: DataFrame, sub_layers: DataFrame, broadcast_rows: int = 100_000
) -> DataFrame:
    """Layer id and row index of each pick.

    A sub-layer that is not listed stands for a layer of its own id. A pick
    without an index counts as -1 from its offset, as a pointer just off a
    feature does, and is flagged. Rows where nothing was picked (no sub-layer)
    stay, with neither layer nor index. The list of sub-layers has a row per batch, so it is broadcast
    only when it is small.
    """
    offsets = sub_layers.select("sub_layer_id", F.col("layer_id").alias("_layer"), "row_offset")
    joined = picks.join(broadcast_if_small(offsets, broadcast_rows), "sub_layer_id", "left")
    picked = F.col("sub_layer_id").isNotNull()
    index = F.when(picked, F.coalesce("row_offset", F.lit(0)) + F.coalesce("batch_index", F.lit(-1)))
    return (
        joined.withColumn("layer_id", F.coalesce("_layer", "sub_layer_id"))
        .withColumn("row_index", index.cast("long"))
        .withColumn("no_index", picked & F.col("batch_index").isNull())
        .withColumn("known_layer", F.col("_layer").isNotNull())
        .drop("_layer", "row_offset")
    )


def lookup_rows(
    picks: DataFrame,
    layer: DataFrame | StoredRows,
    on: Sequence[str] = ("layer_id", "row_index"),
    how: str = "inner",
) -> DataFrame:
    """Source row of each pick, by layer and row index or by feature id.

    A stored layer finds the rows by its own bounds, without numbering it again.
    """
    if isinstance(layer, StoredRows):
        if how != "inner" or list(on) != [layer.within, "row_index"]:
            raise ValueError("a stored layer is looked up by layer and row index")
        return layer.lookup(picks)
    return picks.join(layer, list(on), how)


def hover_rows(
    picks: DataFrame,
    layer: DataFrame | StoredRows,
    columns: Sequence[str],
    on: Sequence[str] = ("layer_id", "row_index"),
) -> DataFrame:
    """Hover text of each picked row."""
    if isinstance(layer, StoredRows):
        found = layer.lookup(picks, columns)
    else:
        found = lookup_rows(picks, layer.select(*on, *columns), on)
    return with_tooltip(found, columns).drop(*columns)


def with_tooltip(df: DataFrame, columns: Sequence[str], name: str = "tooltip") -> DataFrame:
    parts = [(c, F.col(f"`{c}`"), df.schema[c].dataType) for c in columns]
    return df.withColumn(name, tooltip_text(parts))


def nearest_feature(
    points: DataFrame,
    layer: DataFrame,
    radius_m: float,
    point_id: str = "point_id",
    id_col: str = "feature_id",
    lon: str = "lon",
    lat: str = "lat",
    cell_rows: int = 16,
    max_levels: int = 9,
    block_places: int = near.BLOCK_PLACES,
    block_points: int = near.BLOCK_POINTS,
) -> DataFrame:
    """Nearest feature within the radius of each point; ties go to the lowest id.

    The map is split 4 x 4 again and again into blocks of a bounded number of places. Each point
    is sent to its own block, and then only to blocks that may hold a feature nearer than the one
    found there. Within a block, cells are split until none holds more than ``cell_rows``
    places, and points descend through the occupied cells that can still hold the nearest
    feature. Blocks are no smaller than the radius / 4**``max_levels``. Features at one place
    count once; a coordinate that is null or not finite has no place.
    """
    known = (F.abs(F.col(lon)) < F.lit(float("inf"))) & (F.abs(F.col(lat)) < F.lit(float("inf")))
    # One row per place, combined before the shuffle: the lowest id wins any tie there. A file
    # may have far more rows than its bytes say, so they are dealt to tasks by number before that.
    placed = layer.where(known).select(id_col, lon, lat)
    rows = placed.count()
    if rows > near.TASK_ROWS * layer.sparkSession.sparkContext.defaultParallelism:
        placed = near.spread(placed, rows, id_col, lon, lat)
    places = placed.groupBy(F.col(lon).alias("f_lon"), F.col(lat).alias("f_lat")).agg(F.min(id_col).alias("_f"))
    asked = points.where(known).select(
        F.col(point_id).alias("_p"), F.col(lon).alias("p_lon"), F.col(lat).alias("p_lat")
    )
    grid = near.Grid(asked, radius_m, max_levels)
    cells = grid.cells(F.col("f_lon"), F.col("f_lat"), max_levels)
    places = materialize(places.withColumns(dict(zip(("_x", "_y"), cells, strict=True))), "places")
    blocks = near.Blocks(grid, places, block_places)
    places = blocks.blocked(places)

    radius = F.lit(float(radius_m))
    at = grid.cells(F.col("p_lon"), F.col("p_lat"), max_levels)
    asked = asked.withColumns(dict(zip(("_x", "_y"), at, strict=True))).withColumn("bound", radius)
    own = blocks.nearest(blocks.blocked(asked), places, cell_rows, block_points)
    own = materialize(own, "near")
    bound = F.least(F.coalesce("best.distance_m", radius), radius)
    rest = materialize(blocks.others(own.withColumn("bound", bound).drop("best")), "rest")
    others = blocks.nearest(rest, places, cell_rows, block_points)
    found = own.select("_p", "best").unionByName(others.select("_p", "best"))
    found = found.where(F.col("best.distance_m") <= radius).groupBy("_p").agg(F.min("best").alias("best"))
    return found.select(
        F.col("_p").alias(point_id), F.col("best.id").alias(id_col), F.col("best.distance_m").alias("distance_m")
    )
