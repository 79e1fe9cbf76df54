"""From attribute columns to the columns of a layer table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerspark.functions import color, geo
from layerspark.operators.order import row_index
from layerspark.operators.skew import hot_keys, split_hot
from layerspark.session import broadcast_if_small
from layerspark.spec import LayerSpec, check_layer, geometry_columns

# Vertices of one part of a path.
PATH_VERTICES = 100_000


def points_from_lonlat(
    df: DataFrame, lon: str = "lon", lat: str = "lat", z: str | None = None, name: str = "geometry"
) -> DataFrame:
    """Point geometry from coordinate columns, flat or with height."""
    return df.withColumn(name, geo.as_geometry(geo.point(lon, lat, z), name, "point"))


def arcs_from_pairs(df: DataFrame, source: Sequence[str], target: Sequence[str]) -> DataFrame:
    """Source and target positions of an arc layer."""
    return df.withColumn("get_source_position", geo.point(*source)).withColumn(
        "get_target_position", geo.point(*target)
    )


def attach_colors(df: DataFrame, *channels: str, name: str = "color") -> DataFrame:
    return df.withColumn(name, color.pack(*channels))


def tooltip_columns(
    available: Sequence[str], request: bool | Sequence[str], used: Sequence[str]
) -> list[str]:
    """Hover columns of one layer.

    ``True`` is every free column by name; a list keeps its order, without
    repeats and without names this layer lacks. Names taken by the id, geometry
    or accessors are not free.
    """
    free = dict.fromkeys(sorted(available))
    for taken in used:
        free.pop(taken, None)
    asked = {True: free, False: ()}[request] if isinstance(request, bool) else request
    out: dict[str, None] = {}
    for name in asked:
        if name in free:
            out.setdefault(name)
    return list(out)


def select_layer(df: DataFrame, spec: LayerSpec) -> DataFrame:
    """Only what the layer needs, in one projection: id, geometry, accessors, hover columns."""
    # Columns bound under their accessor name count as accessors, not attributes.
    per_row = spec.row_accessors()
    check_layer(df.schema, spec)
    geometry = [c for c in geometry_columns(df.schema, spec.layer_type) if c not in per_row]
    hover = layer_tooltip(df, spec)
    return df.select(
        spec.id_col,
        *[F.col(f"`{c}`") for c in geometry],
        *[column.alias(name) for name, column in per_row.items()],
        *[F.col(f"`{c}`") for c in hover],
    )


def layer_tooltip(df: DataFrame, spec: LayerSpec) -> list[str]:
    """Hover columns the spec resolves to on this table."""
    per_row = spec.row_accessors()
    geometry = geometry_columns(df.schema, spec.layer_type)
    return tooltip_columns(df.columns, spec.tooltip, [spec.id_col, *geometry, *per_row])


def path_from_vertices(
    df: DataFrame,
    path_id: str,
    order: Sequence[str],
    lon: str = "lon",
    lat: str = "lat",
    time: str | None = None,
    max_vertices: int = PATH_VERTICES,
) -> DataFrame:
    """Paths as parts with their vertices in order, and their times if asked.

    A row is a part of a path, whatever the path's length: ``part_id`` (path id and
    part number) is the id of its feature, beside ``path_id`` and ``part`` 0, 1, ....
    Parts have ``max_vertices`` vertices at most and share the one where they meet, so
    that no task ever holds a whole huge path and the drawn line is the same. Vertices
    without coordinates are left out. ``order`` must tell the vertices of a path apart.
    """
    if max_vertices < 2:
        raise ValueError("a path part needs at least two vertices")
    keep = [path_id, *order, lon, lat, *([time] if time else [])]
    vertices = df.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(
        *dict.fromkeys(keep)
    )
    hot = hot_keys(vertices, [path_id], max_vertices)
    whole = vertices.withColumn("part", F.lit(0).cast("long"))
    if hot is not None:
        cold, long = split_hot(vertices, [path_id], hot)
        cut = _cut(long.drop("_n"), path_id, order, max_vertices)
        whole = cold.withColumn("part", F.lit(0).cast("long")).unionByName(cut)
    vertex = F.struct(
        *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
        F.array(F.col(lon), F.col(lat)).alias("xy"),
        *([F.col(time).alias("t")] if time else []),
    )
    gathered = whole.groupBy(path_id, "part").agg(F.array_sort(F.collect_list(vertex)).alias("_v"))
    path = geo.as_geometry(F.transform("_v", lambda v: v["xy"]), "geometry", "linestring")
    part_id = F.concat_ws("/", F.col(path_id).cast("string"), F.col("part").cast("string"))
    out = [F.col(path_id), F.col("part"), part_id.alias("part_id"), path]
    if time:
        out.append(F.transform("_v", lambda v: v["t"]).alias("timestamps"))
    return gathered.select(*out)


def _cut(df: DataFrame, path_id: str, order: Sequence[str], max_vertices: int) -> DataFrame:
    """Part number of each vertex; a vertex where two parts meet appears in both."""
    indexed = row_index(df, [path_id, *order], name="path")
    ends = indexed.groupBy(path_id).agg(F.min("row_index").alias("_start"), F.max("row_index").alias("_last"))
    # One row per long path: at most (rows / max_vertices), and counted.
    placed = indexed.join(broadcast_if_small(ends), path_id)
    place, step = F.col("row_index") - F.col("_start"), max_vertices - 1
    part = F.floor(place / F.lit(step)).cast("long")
    meets = (place % step == 0) & (place > 0)
    # A last vertex on a meeting point only closes the part before it.
    closes = meets & (F.col("row_index") == F.col("_last"))
    parts = (
        F.when(closes, F.array(part - 1)).when(meets, F.array(part - 1, part)).otherwise(F.array(part))
    )
    return placed.withColumn("part", F.explode(parts)).drop("row_index", "_start", "_last")


def stack_layers(layers: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Several layers in one table; columns a layer lacks are null."""
    tagged = [
        df.withColumn("layer_id", F.lit(layer_id)).withColumn("position", F.lit(i))
        for i, (layer_id, df) in enumerate(layers)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def layer_ids(count: int) -> list[str]:
    """Ids of layers given by position."""
    return [f"layer-{i}" for i in range(count)]


def vertex_rows(paths: DataFrame, path_id: str, *lists: str) -> DataFrame:
    """One row per vertex with its position, from parallel lists."""
    zipped = F.arrays_zip(F.col("geometry"), *[F.col(c) for c in lists])
    rows = paths.select(path_id, "part", F.posexplode(zipped).alias("vertex", "_z"))
    return rows.select(
        path_id,
        "part",
        F.col("vertex").cast("long").alias("vertex"),
        F.col("_z.geometry")[0].alias("lon"),
        F.col("_z.geometry")[1].alias("lat"),
        *[F.col(f"_z.{c}").alias(c) for c in lists],
    )


def coordinate_columns(geometry: Column, lon: str = "lon", lat: str = "lat") -> list[Column]:
    return [geometry[0].alias(lon), geometry[1].alias(lat)]
