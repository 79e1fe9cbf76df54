"""Registered queries: one or more per operator, over whole tables.

Results are flattened to scalar columns, so that another engine's rows compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerspark.functions import geo
from layerspark.operators import (
    cells,
    contract,
    measure,
    order,
    picks,
    select,
    shape,
    size,
    style,
    version,
)
from layerspark.plans import fixtures as fx
from layerspark.plans.render import manifest_of, write_map
from layerspark.session import materialize, scratch_path
from layerspark.sinks import encode as enc
from layerspark.sinks import files
from layerspark.sources import clustered_points, scan_cell_stats, scan_layer, scatter_points, square_grid
from layerspark.spec import Extension, LayerSpec, MapSpec
from layerspark.streaming import events as ev
from layerspark.streaming import feed
from layerspark.streaming import throttling as th

Query = Callable[[SparkSession, str], DataFrame]

RADIUS_M = 500.0
BRUSH_CENTER = (-122.45, 37.75)
BRUSH_RADIUS_M = 3000.0
VIEW = {"longitude": -122.45, "latitude": 37.75, "zoom": 12.0}
HOUR_MS = 3_600_000
BUDGET_MB = 0.05
PART_VERTICES = 25
# Rolled-up values are divided by a prime, so that no mean falls on a decimal tie,
# which engines round differently.
SCORE_PRIME = 10007


def xy(df: DataFrame, column: str, lon: str = "geom_x", lat: str = "geom_y") -> DataFrame:
    return df.withColumns({lon: F.col(column)[0], lat: F.col(column)[1]}).drop(column)


def rgb(df: DataFrame, column: str, names: str = "rgb") -> DataFrame:
    channels = {n: F.col(column)[i].cast("int") for i, n in enumerate(names)}
    return df.withColumns(channels).drop(column)


def scored(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.col("value") / F.lit(float(SCORE_PRIME)))


def point_spec(layer_id: str = "layer-0", **kw) -> LayerSpec:
    accessors = kw.pop("accessors", {"get_radius": F.col("radius"), "get_fill_color": [255, 0, 0]})
    return LayerSpec(layer_id, "scatterplot", accessors=accessors, **kw)


def place_points(spark: SparkSession, sf: str) -> DataFrame:
    return shape.points_from_lonlat(fx.places(spark, sf))


# Sources ------------------------------------------------------------------


def q_scan_layer(spark, sf):
    return scan_layer(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_totalprice"])


def q_scan_cell_stats(spark, sf):
    """Two grid levels written as one table by level, then one of them scanned."""
    names = {"mean": "dem_mean", "std": "dem_std", "min": "dem_min", "max": "dem_max", "p10": "dem_p10", "p90": "dem_p90"}
    levels = []
    for level, length in (("L05", 5), ("L06", 6)):
        rolled = cells.geohash_rollup(scored(fx.places(spark, sf)), length, "score")
        levels.append(rolled.withColumnsRenamed({**names, "cell": "cell_id"}).withColumn("level", F.lit(level)))
    path = scratch_path(spark, "cell_stats")
    levels[0].unionByName(levels[1]).write.partitionBy("level").parquet(path)
    stats = scan_cell_stats(spark, path, "L06")
    return stats.select("cell_id", *[F.round(c, 8).alias(c) for c in names.values()])


def q_gen_points(spark, sf):
    ids = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("feature_id"))
    points = scatter_points(ids, "feature_id", seed=3)
    return points.withColumns({c: F.col(c).cast("int") for c in "rgb"}).withColumn(
        "radius", F.round(F.col("radius").cast("double"), 3)
    )


def q_gen_clustered(spark, sf):
    ids = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("feature_id"))
    points = clustered_points(ids, "feature_id", seed=3)
    return points.withColumns({c: F.round(c, 9) for c in ("lon", "lat")})


def q_square_grid(spark, sf):
    ids = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("feature_id"))
    ring = square_grid(ids, "feature_id", fx.GRID_SIDE).select("feature_id", F.col("geometry")[0].alias("ring"))
    corners = ring.select("feature_id", F.posexplode("ring").alias("corner", "xy"))
    return xy(corners, "xy", "x", "y")


# Projections --------------------------------------------------------------


def q_layer_select(spark, sf):
    spec = point_spec(tooltip=("category", "name", "missing", "category"))
    return xy(shape.select_layer(place_points(spark, sf), spec), "geometry")


def q_tooltip_all(spark, sf):
    return xy(shape.select_layer(place_points(spark, sf), point_spec(tooltip=True)), "geometry")


def q_tooltip_text(spark, sf):
    df = fx.table(spark, sf, "events").select("event_id", "event_type", "props", "user_id", "value")
    told = picks.with_tooltip(df, ["event_type", "props", "user_id", "value"])
    return told.select("event_id", "tooltip")


def q_points_3d(spark, sf):
    df = shape.points_from_lonlat(fx.places_nulls(spark, sf), z="radius")
    return df.select(
        "feature_id",
        F.size("geometry").alias("dims"),
        *[F.get("geometry", F.lit(i)).alias(n) for i, n in enumerate("xyz")],
    )


def q_trip_paths(spark, sf):
    paths = shape.path_from_vertices(fx.trip_vertices(spark, sf), "user_id", ["ts", "event_id"], time="ts")
    rows = shape.vertex_rows(paths, "user_id", "timestamps")
    return rows.withColumn("t", F.unix_micros("timestamps")).drop("timestamps")


def q_trip_parts(spark, sf):
    """Paths cut after a few vertices, as very long ones are."""
    paths = shape.path_from_vertices(
        fx.trip_vertices(spark, sf), "user_id", ["ts", "event_id"], max_vertices=PART_VERTICES
    )
    return shape.vertex_rows(paths, "user_id")


def q_trip_times(spark, sf):
    paths = shape.path_from_vertices(fx.trip_vertices(spark, sf), "user_id", ["ts", "event_id"], time="ts")
    timed = style.trip_times_to_float(paths, "timestamps", "s")
    rows = shape.vertex_rows(timed, "user_id", "get_timestamps")
    return rows.select("user_id", "vertex", F.col("get_timestamps").cast("long").alias("t"))


def q_arcs(spark, sf):
    arcs = shape.arcs_from_pairs(fx.arc_ends(spark, sf), ("src_lon", "src_lat"), ("dst_lon", "dst_lat"))
    flat = xy(arcs.drop("src_lon", "src_lat", "dst_lon", "dst_lat"), "get_source_position", "src_x", "src_y")
    return xy(flat, "get_target_position", "dst_x", "dst_y")


def q_attach_colors(spark, sf):
    df = shape.attach_colors(fx.colours(fx.places(spark, sf)), "r", "g", "b", name="get_fill_color")
    return rgb(df.select("feature_id", "get_fill_color"), "get_fill_color")


def q_color_ramp(spark, sf):
    df = style.color_ramp(fx.places_nulls(spark, sf), "value").select("feature_id", "get_fill_color")
    return rgb(df, "get_fill_color")


def q_ramp_bounds(spark, sf):
    found = style.ramp_bounds(fx.places_nulls(spark, sf), "value")
    return found.select(F.round("low", 4).alias("low"), F.round("high", 4).alias("high"))


def q_ramp_bounds_hot(spark, sf):
    """The same bounds by the two-pass ranking that very large tables take."""
    found = style.ramp_bounds(fx.places_nulls(spark, sf), "value", group_rows=100)
    return found.select(F.round("low", 4).alias("low"), F.round("high", 4).alias("high"))


def q_recolor(spark, sf):
    df = shape.attach_colors(fx.colours(fx.places(spark, sf)), "r", "g", "b", name="get_fill_color")
    moved = style.recolor(df.select("feature_id", "get_fill_color"), "get_fill_color", 200, 1)
    return rgb(moved, "get_fill_color")


# Filters and contracts ------------------------------------------------------


def q_null_geometry(spark, sf):
    df = shape.points_from_lonlat(fx.places_nulls(spark, sf))
    return contract.null_geometry(df, ["geometry"], "report")


def q_null_geometry_drop(spark, sf):
    df = shape.points_from_lonlat(fx.places_nulls(spark, sf))
    return xy(contract.null_geometry(df, ["geometry"], "drop").select("feature_id", "geometry"), "geometry")


def q_contract_report(spark, sf):
    df = shape.points_from_lonlat(fx.places_nulls(spark, sf))
    df = df.select("feature_id", "geometry", F.col("value").alias("get_elevation"))
    return contract.check_rows(df, LayerSpec("layer-0", "scatterplot"))


def q_contract_trips(spark, sf):
    paths = shape.path_from_vertices(fx.trip_vertices(spark, sf), "user_id", ["ts", "event_id"], time="ts")
    timed = style.trip_times_to_float(paths, "timestamps", "s").withColumnRenamed("user_id", "feature_id")
    return contract.check_rows(
        timed.select("feature_id", "geometry", "get_timestamps"), LayerSpec("layer-0", "trip")
    )


def q_finite_report(spark, sf):
    return contract.check_finite(fx.places_nulls(spark, sf), ["lon", "lat", "value"])


def q_finite_drop(spark, sf):
    df = contract.check_finite(fx.places_nulls(spark, sf), ["value"], "drop")
    return df.select("feature_id", "value")


def q_range_filter(spark, sf):
    df = select.range_filter(fx.places_nulls(spark, sf), {"value": (50_000.0, 200_000.0), "radius": (40.0, 150.0)})
    return df.select("feature_id", "value", F.col("radius").cast("double").alias("radius"))


def q_range_filter_soft(spark, sf):
    df = select.range_filter(
        fx.places(spark, sf), {"value": (50_000.0, 200_000.0)}, {"value": (80_000.0, 150_000.0)}
    )
    return df.select("feature_id", F.round("filter_weight", 9).alias("filter_weight"))


def q_category_filter(spark, sf):
    df = select.category_filter(fx.places(spark, sf), {"category": ["1-URGENT", "5-LOW"], "name": ["O", "F"]})
    return df.select("feature_id", "category", "name")


def q_brush(spark, sf):
    return select.brush(fx.places(spark, sf), BRUSH_CENTER, BRUSH_RADIUS_M).select("feature_id", "lon", "lat")


def q_brush_arcs(spark, sf):
    arcs = fx.arc_ends(spark, sf)
    return select.brush(
        arcs, BRUSH_CENTER, BRUSH_RADIUS_M, "source_target", ("src_lon", "src_lat"), ("dst_lon", "dst_lat")
    )


def q_in_view(spark, sf):
    return select.in_view(fx.places_nulls(spark, sf), VIEW).select("feature_id", "lon", "lat")


def q_declutter(spark, sf):
    df = select.declutter(fx.places_nulls(spark, sf), 0.01, "value", group="category")
    return df.select("feature_id", "category", "lon", "lat")


def q_fit_to_budget(spark, sf):
    df = place_points(spark, sf).select("feature_id", "geometry", "radius")
    half = df.agg(F.count(F.lit(1)) * 14).first()[0]
    return select.fit_to_budget(df, half).select("feature_id")


def q_coarsen(spark, sf):
    df = select.coarsen(place_points(spark, sf).select("feature_id", "geometry"), "geometry", 3)
    return xy(df, "geometry")


def q_coarsen_paths(spark, sf):
    paths = shape.path_from_vertices(fx.trip_vertices(spark, sf), "user_id", ["ts", "event_id"])
    thin = select.coarsen(paths, "geometry", 0)
    return shape.vertex_rows(thin, "user_id").drop("part")


def q_float_geometry(spark, sf):
    """Coordinates as 32-bit floats, widened again to show what is left of them."""
    df = select.to_float32(place_points(spark, sf).select("feature_id", "geometry"), "geometry")
    flat = xy(df, "geometry")
    return flat.select("feature_id", *[F.col(c).cast("double").alias(c) for c in ("geom_x", "geom_y")])


def q_check_budget(spark, sf):
    """Sizes that the budget check compares: one row per layer."""
    sizes = [
        size.layer_bytes(place_points(spark, sf).select("feature_id", "geometry", "radius"), "layer-0"),
        size.layer_bytes(fx.h3_cells(spark, sf), "layer-1"),
    ]
    return sizes[0].unionByName(sizes[1])


def q_budget_verdict(spark, sf):
    """The layers of ``check_budget`` against a limit that they exceed."""
    return contract.budget_verdict(q_check_budget(spark, sf), BUDGET_MB)


# Joins ----------------------------------------------------------------------


def q_attach_stats(spark, sf):
    stats = cells.cell_rollup(fx.part_stats(spark, sf), "cell_id", "quantity", percentiles=False)
    joined = cells.attach_stats(fx.grid(spark, sf), stats)
    return joined.select(
        "cell_id",
        "west",
        "south",
        "count",
        "min",
        "max",
        F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"),
    )


def q_resolve_picks(spark, sf):
    picked = fx.interactions(spark, sf).where(F.col("kind") != "view_state")
    out = picks.resolve_picks(picked, fx.sub_layers(spark, sf))
    return out.select("event_id", "layer_id", "row_index", "no_index", "known_layer", "lon", "lat")


def q_lookup_rows(spark, sf):
    picked = q_resolve_picks(spark, sf).select("event_id", "layer_id", "row_index")
    return picks.lookup_rows(picked, fx.stored_layer(spark, sf))


def q_hover_rows(spark, sf):
    picked = q_resolve_picks(spark, sf).select("event_id", "layer_id", "row_index")
    return picks.hover_rows(picked, fx.stored_layer(spark, sf), ["name", "category", "value"])


def _nearest(spark, sf, **kw):
    points = fx.interactions(spark, sf).select(F.col("event_id").alias("point_id"), "lon", "lat")
    near = picks.nearest_feature(points, fx.places_nulls(spark, sf), RADIUS_M, **kw)
    return near.withColumn("distance_m", F.round("distance_m", 3))


def q_nearest_feature(spark, sf):
    return _nearest(spark, sf)


def q_nearest_feature_dense(spark, sf):
    """The same answer by the descent that crowded cells take."""
    return _nearest(spark, sf, cell_rows=1, max_levels=4)


def _flat_verdicts(df: DataFrame) -> DataFrame:
    return df.withColumn("changed_columns", F.array_join("changed_columns", ","))


def _versions(spark, sf):
    """Two versions of a map: what stayed, was recoloured, restyled, moved, added, dropped."""
    old = place_points(spark, sf)
    redone = shape.points_from_lonlat(fx.places_recolour(spark, sf))
    moved = shape.points_from_lonlat(fx.places_moved(spark, sf))
    valued = {"get_elevation": F.col("value")}
    base = lambda name, **kw: point_spec(name, accessors=valued, **kw)
    prev = [
        (old, base("same")),
        (old, base("values")),
        (old, base("shapes")),
        (old, base("style")),
        (old, base("hover")),
        (old, base("gone")),
    ]
    curr = [
        (old, base("same")),
        (redone, base("values")),
        (moved, base("shapes")),
        (old, base("style", props={"opacity": 0.5})),
        (old, base("hover", tooltip=("name",))),
        (old, base("fresh")),
    ]
    return prev, curr


def q_diff_layers(spark, sf):
    """Verdict per layer of two map versions."""
    prev, curr = _versions(spark, sf)

    def manifest(layers):
        rows = [manifest_of(df, spec, i) for i, (df, spec) in enumerate(layers)]
        out = rows[0]
        for row in rows[1:]:
            out = out.unionByName(row)
        return out

    return _flat_verdicts(version.diff_layers(manifest(prev), manifest(curr)))


def q_diff_rows(spark, sf):
    prev = fx.places(spark, sf).where(F.col("feature_id") % 1000 != 1)
    curr = fx.places_moved(spark, sf).where(F.col("feature_id") % 1000 != 2)
    curr = curr.withColumn("value", F.when(F.col("feature_id") % 7 == 0, F.lit(0.0)).otherwise(F.col("value")))
    return _flat_verdicts(
        version.diff_rows(prev, curr, geometry=["lon", "lat"], accessors=["value", "category"])
    )


def q_changed_rows(spark, sf):
    prev, curr = fx.places(spark, sf), fx.places_moved(spark, sf)
    diff = version.diff_rows(prev, curr, geometry=["lon", "lat"], accessors=["value"])
    return version.changed_rows(curr, diff, ["lon"])


# Aggregations ---------------------------------------------------------------


def q_viewport(spark, sf):
    found = size.viewport(fx.places_nulls(spark, sf))
    rounded = {c: F.round(c, 6) for c in ("longitude", "latitude", "zoom")}
    return found.withColumns(rounded)


def q_layer_bytes(spark, sf):
    """23 bytes per row for a point, a colour and a radius (and 8 for the id)."""
    df = shape.attach_colors(fx.colours(place_points(spark, sf)), "r", "g", "b", name="get_fill_color")
    return size.layer_bytes(df.select("feature_id", "geometry", "get_fill_color", "radius"), "layer-0")


def q_encoding_tier(spark, sf):
    sizes = (
        fx.table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("_d")).agg(
            (F.count(F.lit(1)) * 23_000).alias("bytes")
        )
    )
    sizes = sizes.select(F.date_format("_d", "yyyy-MM-dd").alias("layer_id"), "bytes")
    return size.choose_encoding(sizes)


def q_format_sizes(spark, sf):
    df = fx.places(spark, sf).select("feature_id", "category", "name")
    return size.format_sizes(df).withColumn("ratio", F.round("ratio", 6))


def q_column_fingerprints(spark, sf):
    df = fx.places(spark, sf).select("feature_id", "lon", "lat", "value", "category", "name")
    return version.column_fingerprints(df, algo="md5")


def q_geometry_fingerprint(spark, sf):
    spec = LayerSpec("layer-0", "geohash", accessors={"get_geohash": F.col("name")})
    df = fx.places(spark, sf).select("feature_id", F.col("name").alias("get_geohash"))
    return version.geometry_fingerprint(df, spec, "md5")


def q_geohash_cell(spark, sf):
    df = cells.cell_layer(fx.places_nulls(spark, sf), "lon", "lat", 7)
    return df.select("feature_id", "get_geohash")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 8) for c in cells.STATISTICS})


def q_geohash_rollup(spark, sf):
    return _rounded(cells.geohash_rollup(scored(fx.places_nulls(spark, sf)), 5, "score"))


def q_geohash_rollup_hot(spark, sf):
    """The same roll-up with every cell of more than a few rows ranked in two passes."""
    return _rounded(cells.geohash_rollup(scored(fx.places_nulls(spark, sf)), 5, "score", group_rows=20))


def q_h3_rollup(spark, sf):
    return _rounded(cells.h3_rollup(scored(fx.h3_cells(spark, sf)), "cell", 8, "score"))


def q_h3_cells(spark, sf):
    ids = fx.h3_cells(spark, sf).select("feature_id", geo.h3_from_text("cell").alias("cell"))
    return ids.select(
        "feature_id",
        "cell",
        geo.h3_resolution("cell").alias("resolution"),
        geo.h3_parent("cell", 7).alias("parent"),
        geo.h3_to_text(geo.h3_parent("cell", 7)).alias("parent_text"),
    )


def q_bench_summary(spark, sf):
    out = measure.bench_summary(fx.wire_runs(spark, sf), plain="N")
    return out.withColumn("ratio", F.round("ratio", 6))


def q_break_even(spark, sf):
    runs = fx.table(spark, sf, "lineitem").select(
        F.lit(1).alias("n"),
        F.col("l_partkey").cast("string").alias("mode"),
        F.col("l_quantity").alias("encode_ms"),
        F.col("l_extendedprice").alias("wire_bytes"),
    )
    out = measure.break_even(measure.bench_summary(runs, plain="1"))
    return out.select("mode", "bytes_saved", "added_ms", F.round("break_even_mbps", 9).alias("break_even_mbps")).withColumn(
        "bytes_saved", F.round("bytes_saved", 2)
    )


def q_span_totals(spark, sf):
    log = fx.table(spark, sf, "events").select(F.col("event_type").alias("span"), F.col("value").alias("ms"))
    out = measure.span_totals(log)
    return out.withColumns({c: F.round(c, 2) for c in ("total_ms", "long_total_ms")})


# Windows and set operations ---------------------------------------------------


def q_row_offsets(spark, sf):
    return fx.sub_layers(spark, sf).select("layer_id", "batch_id", "num_rows", "row_offset")


def q_byte_offsets(spark, sf):
    """Layers per order priority, maps per order status; bytes at 23 per row."""
    layers = (
        fx.places(spark, sf)
        .groupBy(F.col("name").alias("map_id"), F.col("category").alias("layer_id"))
        .agg((F.count(F.lit(1)) * 23).alias("byte_length"))
        .withColumn("position", F.substring("layer_id", 1, 1).cast("int"))
    )
    return order.byte_offsets(layers)


def q_row_index(spark, sf):
    return order.row_index(fx.places(spark, sf).select("feature_id", "name")).select("feature_id", "row_index")


def q_assign_batches(spark, sf):
    batched = order.assign_batches(fx.places(spark, sf).select("feature_id"), 1000)
    return order.batch_table(batched, "layer-0")


def q_sort_for_encoding(spark, sf):
    """Rows in geohash order: neighbours in the file are neighbours on the map."""
    coded = fx.places(spark, sf).withColumn("code", geo.geohash_code("lon", "lat", 6))
    lying = order.sort_for_encoding(coded, "code", "feature_id").select("feature_id", "code")
    return order.row_positions(lying).withColumnRenamed("row_index", "position")


def q_hilbert_order(spark, sf):
    """Rows along a Hilbert curve; rows without a place first."""
    lying = order.hilbert_order(fx.places_nulls(spark, sf).select("feature_id", "lon", "lat"), name="code")
    return order.row_positions(lying.select("feature_id", "code")).withColumnRenamed("row_index", "position")


def q_stack_layers(spark, sf):
    first = fx.places(spark, sf).select("feature_id", "name", "value")
    second = fx.h3_cells(spark, sf)
    ids = shape.layer_ids(2)
    return shape.stack_layers([(ids[0], first), (ids[1], second)])


# Sinks ------------------------------------------------------------------------


def q_layer_parquet(spark, sf):
    """A layer written by Spark's Parquet writer and read back."""
    df = shape.attach_colors(fx.colours(place_points(spark, sf)), "r", "g", "b", name="get_fill_color")
    path = scratch_path(spark, "layer_parquet")
    files.write_layer_parquet(df.select("feature_id", "geometry", "get_fill_color", "name"), path)
    return rgb(xy(spark.read.parquet(path), "geometry"), "get_fill_color")


def q_encoded_batches(spark, sf):
    """Batches of an encoded layer: rows per batch."""
    df = shape.attach_colors(fx.colours(place_points(spark, sf)), "r", "g", "b", name="get_fill_color")
    layer = df.select("feature_id", "geometry", "get_fill_color", "radius")
    path = scratch_path(spark, "layer_arrow")
    files.write_layer_arrow(layer, path, "layer-0", "ipc-zstd", rows_per_batch=2000)
    return spark.read.parquet(path).select("layer_id", "batch_id", "num_rows", "encoding")


def q_encoded_values(spark, sf):
    """An encoded layer, decoded again: every value of every batch, in three encodings."""
    df = shape.attach_colors(fx.colours(place_points(spark, sf)), "r", "g", "b", name="get_fill_color")
    layer = df.select("feature_id", "geometry", "get_fill_color", "radius", "name")
    path = scratch_path(spark, "layers")
    kinds = ("ipc", "ipc-zstd", "parquet")
    encoded = [enc.encode_layer(layer, kind, kind, rows_per_batch=1500 * (i + 1)) for i, kind in enumerate(kinds)]
    files.write_layers_partitioned(encoded, path)
    stored = spark.read.parquet(path)
    decoded = [
        enc.decode_layer(stored.where(F.col("layer_id") == kind), layer.schema).withColumn("encoding", F.lit(kind))
        for kind in kinds
    ]
    values = decoded[0].unionByName(decoded[1]).unionByName(decoded[2])
    return rgb(xy(values, "geometry"), "get_fill_color")


def q_layers_partitioned(spark, sf):
    """Two layers with different encodings in one table: rows per layer."""
    first = place_points(spark, sf).select("feature_id", "geometry", "name")
    second = fx.h3_cells(spark, sf).select("feature_id", geo.h3_from_text("cell").alias("get_hexagon"))
    path = scratch_path(spark, "layers")
    files.write_layers_partitioned(
        [
            enc.encode_layer(first, "layer-0", "parquet", rows_per_batch=4000),
            enc.encode_layer(second, "layer-1", "ipc", rows_per_batch=500),
        ],
        path,
    )
    stored = spark.read.parquet(path)
    return stored.groupBy("layer_id", "encoding").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("num_rows").alias("num_rows")
    )


def q_records_json(spark, sf):
    return files.records_json(fx.places(spark, sf).select("feature_id", "name", "category"), "feature_id")


def _map_layers(spark, sf):
    ramped = style.color_ramp(place_points(spark, sf), "value")
    first = LayerSpec(
        "places",
        "scatterplot",
        accessors={"get_fill_color": F.col("get_fill_color"), "get_radius": F.col("radius")},
        props={"radius_units": "meters"},
        extensions=(Extension("data-filter", {"filter_size": 1}),),
        tooltip=("category", "name"),
    )
    second = LayerSpec("cells", "h3-hexagon", accessors={"get_hexagon": F.col("cell_id")}, compression="parquet")
    hexes = fx.h3_cells(spark, sf).withColumn("cell_id", geo.h3_from_text("cell"))
    return [(ramped, first), (hexes, second)]


def q_manifest(spark, sf):
    """Manifest of a map of two layers, written with their files."""
    view = MapSpec({"longitude": -122.45, "latitude": 37.75, "zoom": 10.0, "pitch": 0.0, "bearing": 0.0})
    manifest = write_map(spark, _map_layers(spark, sf), scratch_path(spark, "map"), view)
    return manifest.select(
        "map_id",
        "version",
        "position",
        "layer_id",
        "layer_type",
        "props",
        "extensions",
        "tooltip",
        "num_rows",
        "bytes",
        "view_state",
    )


def q_manifest_files(spark, sf):
    """What the manifest says of each layer's files, next to the files themselves."""
    path = scratch_path(spark, "map")
    manifest = write_map(spark, _map_layers(spark, sf), path, rows_per_batch=2000)
    files_of = [spark.read.parquet(r["data_path"]) for r in manifest.select("data_path").collect()]
    stored = files_of[0].unionByName(files_of[1]).groupBy("layer_id").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum(F.octet_length("payload")).alias("payload_bytes"),
        F.countDistinct("encoding").alias("encodings"),
        F.min("encoding").alias("encoding"),
    )
    offsets = spark.read.parquet(f"{path}/sub_layers").groupBy("layer_id").agg(
        F.max("row_offset").alias("last_offset"), F.sum("num_rows").alias("sub_layer_rows")
    )
    first = F.col("position") == 0
    earlier = manifest.filter(first).select(F.max("byte_length").alias("b")).scalar()
    return manifest.join(stored, "layer_id").join(offsets, "layer_id").select(
        "layer_id",
        "num_rows",
        "batches",
        "encodings",
        (F.coalesce("body_encoding", F.lit("ipc")) == F.col("encoding")).alias("encoding_agrees"),
        (F.col("byte_length") == F.col("payload_bytes")).alias("length_agrees"),
        (F.col("byte_offset") == F.when(first, 0).otherwise(earlier)).alias("offset_agrees"),
        F.size("column_fps").alias("fingerprints"),
        F.col("geometry_fp").isNotNull().alias("has_geometry_fp"),
        "last_offset",
        "sub_layer_rows",
        "time_unit",
    )


def q_refresh_map(spark, sf):
    """The same map again, recoloured by other values: what was written anew."""
    path = scratch_path(spark, "map")
    layers = _map_layers(spark, sf)
    before = write_map(spark, layers, path)
    before = materialize(before, "manifest")
    redone = [(style.recolor(layers[0][0], "get_fill_color", 7), layers[0][1]), layers[1]]
    after = write_map(spark, redone, path, previous=before)
    old = before.select("layer_id", F.col("data_path").alias("old_path"))
    return after.join(old, "layer_id").select(
        "layer_id",
        (F.col("data_path") == F.col("old_path")).alias("kept_data"),
        F.array_join("patch_columns", ",").alias("patched"),
    )


# Streaming ----------------------------------------------------------------------


def q_gate(spark, sf):
    """Flags per session, from the events themselves: users with an even id report hovers."""
    happened = fx.interactions(spark, sf)
    flags = happened.select("session", F.lit("hovered").alias("kind"), (F.col("session") % 2 == 0).alias("enabled"))
    return ev.gate(happened, flags.distinct(), scope=["session"]).select("event_id", "session", "kind")


def q_gate_stream(spark, sf):
    """The same gate in ``foreachBatch``, flags read anew per micro-batch."""
    out = scratch_path(spark, "gated")
    stream = _event_stream(spark, sf)

    def write(batch, batch_id):
        batch.select("event_id", "session", "kind").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def read_flags(session):
        kinds = fx.interactions(session, sf).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
        return kinds.select("kind", (F.col("kind") != "clicked").alias("enabled"))

    run = stream.writeStream.foreachBatch(ev.gated_writer(read_flags, write))
    _finish(run.option("checkpointLocation", scratch_path(spark, "gate")).trigger(availableNow=True).start())
    return spark.read.parquet(out).select("event_id", "session", "kind")


def q_throttle(spark, sf):
    happened = fx.interactions(spark, sf).select("event_id", "ts", "session")
    return th.throttle(happened, ["session"], HOUR_MS).select("event_id", "session")


def q_throttle_pieces(spark, sf):
    """The same events with runs cut into small pieces, as very long runs are."""
    happened = fx.interactions(spark, sf).select("event_id", "ts", "session")
    return th.throttle(happened, ["session"], 24 * HOUR_MS, run_rows=15).select("event_id", "session")


def q_throttle_kinds(spark, sf):
    happened = fx.interactions(spark, sf).select("event_id", "ts", "session", "kind")
    return th.throttle_interactions(happened, 12 * HOUR_MS).select("event_id", "session", "kind")


def q_throttle_stream(spark, sf):
    stream = _event_stream(spark, sf).select("event_id", "ts", "session")
    passed = th.throttle_stream(stream, ["session"], HOUR_MS)
    return _run_to_table(spark, passed, "append").select("event_id", "session")


def q_throttle_kinds_stream(spark, sf):
    """The stream twin: clicks pass, hovers and views are throttled apart."""
    stream = _event_stream(spark, sf).select("event_id", "ts", "session", "kind")
    passed = th.throttle_interactions_stream(stream, 12 * HOUR_MS)
    return _run_to_table(spark, passed, "append").select("event_id", "session", "kind")


def q_latest_view(spark, sf):
    return _views(ev.latest_view(fx.interactions(spark, sf)))


def q_latest_view_stream(spark, sf):
    out = scratch_path(spark, "views")
    stream = ev.latest_view(_event_stream(spark, sf))

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run = stream.writeStream.foreachBatch(write).outputMode("update")
    _finish(run.option("checkpointLocation", scratch_path(spark, "views_cp")).trigger(availableNow=True).start())
    # Updates of a session overwrite each other: the last one stands.
    return _views(ev.latest_view(spark.read.parquet(out), kind=None))


def _views(df: DataFrame) -> DataFrame:
    return df.select(
        "session",
        "event_id",
        F.unix_micros("ts").alias("t"),
        *[F.col(f"view_state.{c}").alias(c) for c in ("longitude", "latitude", "zoom", "bearing")],
    )


def q_picks_to_rows(spark, sf):
    layer = fx.stored_layer(spark, sf)
    rows = ev.picks_to_rows(fx.interactions(spark, sf), layer.sub_layers(), layer)
    return rows.select("event_id", "layer_id", "row_index", "feature_id", "name")


def q_picks_to_rows_stream(spark, sf):
    """Source rows of streamed picks, looked up per micro-batch."""
    out = scratch_path(spark, "picked")
    layer = fx.stored_layer(spark, sf)
    offsets = layer.sub_layers()
    columns = ["event_id", "layer_id", "row_index", "feature_id", "name"]

    def write(rows, batch_id):
        rows.select(*columns).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run = _event_stream(spark, sf).writeStream.foreachBatch(ev.rows_writer(offsets, layer, write))
    _finish(run.option("checkpointLocation", scratch_path(spark, "picked_cp")).trigger(availableNow=True).start())
    return spark.read.parquet(out).select(*columns)


def q_layer_change_feed(spark, sf):
    """Three announced versions of one layer and the verdict on each."""
    folder = scratch_path(spark, "feed")
    for name, make in (("a", fx.places), ("b", fx.places_recolour), ("c", fx.places_moved)):
        make(spark, sf).write.parquet(f"{folder}/data/{name}")
    announced = spark.createDataFrame(
        [(1, f"{folder}/data/a"), (2, f"{folder}/data/b"), (3, f"{folder}/data/c"), (4, f"{folder}/data/c")],
        "version int, path string",
    )
    announced.coalesce(1).write.parquet(f"{folder}/announced")
    stream = spark.readStream.schema(announced.schema).parquet(f"{folder}/announced")
    spec = point_spec(accessors={"get_elevation": F.col("value")})

    def load(session, path):
        return shape.points_from_lonlat(session.read.parquet(path))

    _finish(feed.layer_change_feed(stream, spec, load, folder, f"{folder}/checkpoint"))
    verdicts = feed.read_verdicts(spark, folder)
    return _flat_verdicts(verdicts).select("version", "layer_id", "verdict", "changed_columns")


def _event_stream(spark, sf):
    schema = fx.table(spark, sf, "events").schema
    return fx.as_interactions(ev.read_events(spark, sf, schema, "events.parquet"))


def _run_to_table(spark, stream: DataFrame, mode: str) -> DataFrame:
    out = scratch_path(spark, "stream")
    writer = stream.writeStream.format("parquet").option("path", out).outputMode(mode)
    _finish(writer.option("checkpointLocation", scratch_path(spark, "stream_cp")).trigger(availableNow=True).start())
    return spark.read.schema(stream.schema).parquet(out)


def _finish(query) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Places coloured by value: the layer table a map would show."""
    ramped = style.color_ramp(shape.points_from_lonlat(fx.places_nulls(spark, sf)), "value")
    placed = contract.null_geometry(ramped, ["geometry"], "drop")
    spec = LayerSpec(
        "places",
        "scatterplot",
        accessors={"get_fill_color": F.col("get_fill_color"), "get_radius": F.col("radius")},
        tooltip=("category", "name"),
    )
    layer = rgb(xy(shape.select_layer(placed, spec), "geometry"), "get_fill_color")
    return layer.withColumn("get_radius", F.col("get_radius").cast("double"))


def registry() -> dict[str, Query]:
    found = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}
    return {"flagship": flagship, **found}

