"""Preparing and refreshing the layers of a map, end to end."""

from __future__ import annotations

import hashlib
import math
import warnings
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType

from layerspark.functions.widths import row_width
from layerspark.operators.contract import check_budget, list_depth, row_rules
from layerspark.operators.order import row_offsets
from layerspark.operators.shape import layer_tooltip, select_layer
from layerspark.operators.size import MAX_ZOOM, encoding_for, requested_encoding
from layerspark.operators.style import finest_unit, trip_times_to_float
from layerspark.operators.version import (
    diff_layers,
    fingerprint_map,
    hashed_rows,
    joined_fingerprint,
    props_fingerprint,
)
from layerspark.sinks.encode import PAYLOAD_SCHEMA, ROWS_PER_BATCH, encode_layer
from layerspark.sinks.manifest import manifest_frame, manifest_row, write_manifest
from layerspark.spec import (
    GEOMETRY_ACCESSORS,
    GEOMETRY_KEY,
    LayerSpec,
    MapSpec,
    geometry_columns,
)

LAYERS_AT_ONCE = 8
# Units of trip times, finest first.
UNITS = ("us", "ms", "s")
EDGES = ("west", "south", "east", "north")
KEEP_DATA = ("unchanged", "tooltip_only", "props_only")


def prepare_layer(df: DataFrame, spec: LayerSpec, time_unit: str | None = None) -> DataFrame:
    """Layer table of a spec: checked, pruned, trip times as floats."""
    layer = select_layer(df, spec)
    return trip_times_to_float(layer, "get_timestamps", time_unit) if has_clock(layer, spec) else layer


def has_clock(layer: DataFrame, spec: LayerSpec) -> bool:
    """Whether the layer's trip times are points in time, to be counted in a unit."""
    if spec.layer_type != "trip" or "get_timestamps" not in layer.columns:
        return False
    times = layer.schema["get_timestamps"].dataType
    return isinstance(times, ArrayType) and not isinstance(times.elementType, NumericType)


def trip_unit(df: DataFrame, spec: LayerSpec, before: str | None = None) -> str | None:
    """Unit of a layer's trip times, None without a clock.

    The unit of the version before stays as long as the times fit it, so that a refresh
    does not change every time; else the finest that fits.
    """
    layer = select_layer(df, spec)
    if not has_clock(layer, spec):
        return None
    finest = finest_unit(layer, "get_timestamps")
    return finest if before is None else max(finest, before, key=UNITS.index)


def profile_layer(layer: DataFrame, spec: LayerSpec, algo: str = "xxhash64") -> DataFrame:
    """Size, encoding, fingerprints and broken rules of a prepared layer: one pass, one row."""
    geometry = geometry_columns(layer.schema, spec.layer_type)
    rules = row_rules(layer.schema, spec)
    tests = [broken.alias(f"_r{i}") for i, broken in enumerate(rules.values())]
    edges = [e.alias(n) for n, e in zip(EDGES, row_edges(layer, spec), strict=True)]
    rows = hashed_rows(layer, spec.id_col, algo, [row_width(layer.schema).alias("_w"), *edges, *tests])
    counts = [x for i, name in enumerate(rules) for x in (F.lit(name), F.count(F.when(F.col(f"_r{i}"), 1)))]
    facts = rows.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.coalesce(F.ceil(F.sum("_w")), F.lit(0)).cast("long").alias("bytes"),
        fingerprint_map(layer.columns).alias("column_fps"),
        F.create_map(*counts).alias("broken"),
        *[(F.min if n in ("west", "south") else F.max)(n).alias(n) for n in EDGES],
    )
    return facts.select(
        F.lit(spec.layer_id).alias("layer_id"),
        "num_rows",
        "bytes",
        encoding_for(F.col("bytes"), requested_encoding(spec.compression)).alias("encoding"),
        joined_fingerprint(geometry, F.col("column_fps")).alias("geometry_fp"),
        F.lit(props_fingerprint(spec)).alias("props_fp"),
        "column_fps",
        "broken",
        *EDGES,
    )


def row_edges(layer: DataFrame, spec: LayerSpec) -> list[Column]:
    """West, south, east, north of each row's shape; null for cells and arcs, as for no shape."""
    names = [
        f.name for f in layer.schema.fields if (f.metadata or {}).get(GEOMETRY_KEY) and f.name not in spec.accessors
    ]
    if not names or spec.layer_type in GEOMETRY_ACCESSORS:
        return [F.lit(None).cast("double")] * 4
    vertices, depth = F.col(names[0]), list_depth(layer.schema[names[0]].dataType)
    for _ in range(depth - 2):
        vertices = F.flatten(vertices)
    if depth == 1:
        lon, lat = F.get(vertices, F.lit(0)), F.get(vertices, F.lit(1))
        known = ~(F.isnan(lon) | F.isnan(lat))
        lon, lat = F.when(known, lon), F.when(known, lat)
        return [lon, lat, lon, lat]
    lon, lat = F.transform(vertices, lambda v: v[0]), F.transform(vertices, lambda v: v[1])
    return [F.array_min(lon), F.array_min(lat), F.array_max(lon), F.array_max(lat)]


def auto_view(profiles: Sequence[dict[str, Any]]) -> dict[str, float]:
    """View that shows every layer with shapes of its own; 0, 0, 0 with a warning without any."""
    known = [p for p in profiles if p["west"] is not None]
    view = {"longitude": 0.0, "latitude": 0.0, "zoom": 0.0, "pitch": 0.0, "bearing": 0.0}
    if not known:
        warnings.warn(
            "no view state can be derived: cell and arc layers have no bounds; pass a view state",
            stacklevel=3,
        )
        return view
    west, south = min(p["west"] for p in known), min(p["south"] for p in known)
    east, north = max(p["east"] for p in known), max(p["north"] for p in known)
    span = max(east - west, north - south)
    zoom = MAX_ZOOM if span <= 0 else min(max(math.log2(360.0 / span), 0.0), MAX_ZOOM)
    return {**view, "longitude": (west + east) / 2, "latitude": (south + north) / 2, "zoom": zoom}


def manifest_of(
    df: DataFrame, spec: LayerSpec, position: int = 0, algo: str = "xxhash64"
) -> DataFrame:
    """What a version comparison needs to know of one layer: one row."""
    layer = prepare_layer(df, spec)
    hover = layer_tooltip(df, spec)
    geometry = geometry_columns(layer.schema, spec.layer_type)
    facts = hashed_rows(layer, spec.id_col, algo).agg(
        F.count(F.lit(1)).alias("num_rows"), fingerprint_map(layer.columns).alias("column_fps")
    )
    return facts.select(
        F.lit(spec.layer_id).alias("layer_id"),
        F.lit(position).alias("position"),
        "num_rows",
        "column_fps",
        joined_fingerprint(geometry, F.col("column_fps")).alias("geometry_fp"),
        F.lit(props_fingerprint(spec)).alias("props_fp"),
        F.lit(",".join(hover) if hover else None).cast("string").alias("tooltip"),
    )


def write_map(
    spark: SparkSession,
    layers: Sequence[tuple[DataFrame, LayerSpec]],
    path: str,
    map_spec: MapSpec | None = None,
    previous: DataFrame | None = None,
    max_mb: float | None = None,
    rows_per_batch: int = ROWS_PER_BATCH,
    time_unit: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """Write a map's layers and manifest below ``path`` and return the manifest.

    Per layer one aggregate pass decides everything. With the ``previous``
    manifest, a layer with the same rows keeps its files (a new manifest row is
    all it needs), one with the same shapes gets a patch of its changed columns,
    and only new shapes are encoded again.
    """
    ids = [spec.layer_id for _, spec in layers]
    if len(set(ids)) != len(ids):
        raise ValueError("layer ids of a map must differ")
    known_units = {}
    if previous is not None and "time_unit" in previous.columns:
        known_units = {r["layer_id"]: r["time_unit"] for r in previous.select("layer_id", "time_unit").collect()}

    def unit_of(i: int) -> str | None:
        df, spec = layers[i]
        found = trip_unit(df, spec, known_units.get(spec.layer_id)) if time_unit is None else time_unit
        return found if spec.layer_type == "trip" else None

    units = _together(unit_of, len(layers))
    tables = [prepare_layer(df, spec, unit) for (df, spec), unit in zip(layers, units, strict=True)]
    profiles = _together(lambda i: profile_layer(tables[i], layers[i][1]).first().asDict(), len(layers))
    if map_spec is None or map_spec.view_state is None:
        map_spec = MapSpec(auto_view(profiles), map_spec.options if map_spec else {})
    prepared, rows = [], []
    for position, ((df, spec), layer, facts) in enumerate(zip(layers, tables, profiles, strict=True)):
        if strict:
            _refuse_broken(facts["broken"], spec)
        hover = layer_tooltip(df, spec)
        known = {k: facts[k] for k in ("num_rows", "bytes", "column_fps", "geometry_fp", "props_fp")}
        known["time_unit"] = units[position]
        rows.append(
            manifest_row(
                spec, position, facts["encoding"], hover, {**known, "byte_length": 0}, map_spec
            )
        )
        prepared.append((layer, spec, facts["encoding"]))
    verdicts, old = _compare(spark, rows, previous)

    fresh: list[str] = []

    def begin(target: str) -> str:
        """Notes a folder that this map makes."""
        if not _folder(spark, target).exists():
            fresh.append(target)
        return target

    def store(i: int) -> None:
        row, (layer, spec, encoding) = rows[i], prepared[i]
        verdict, changed = verdicts.get(spec.layer_id, ("new", []))
        before = old.get(spec.layer_id)
        if verdict in KEEP_DATA:
            for key in ("data_path", "patch_path", "patch_columns", "byte_length", "body_encoding"):
                row[key] = before[key]
            return
        # The folder is named after the content, so versions never overwrite each other.
        tag = _content_tag(row)
        if verdict == "accessors_only":
            # A column that only the old version had needs no data: the manifest drops it.
            columns = sorted((set(changed) | set(before["patch_columns"] or [])) & set(layer.columns))
            target = begin(f"{path}/patches/{spec.layer_id}/{tag}")
            slim = layer.select(spec.id_col, *[c for c in columns if c != spec.id_col])
            length = _encode(slim, spec, row, encoding, target, rows_per_batch)
            row.update(
                data_path=before["data_path"],
                patch_path=target,
                patch_columns=columns,
                byte_length=before["byte_length"] + length,
                body_encoding=before["body_encoding"],
            )
        else:
            target = begin(f"{path}/layers/{spec.layer_id}/{tag}")
            row["data_path"] = target
            row["byte_length"] = _encode(layer, spec, row, encoding, target, rows_per_batch)

    try:
        _together(store, len(rows))
        if max_mb is not None:
            # What is sent is what counts, so the check waits for the encoded bytes.
            sizes = [(r["layer_id"], r["byte_length"]) for r in rows]
            check_budget(spark.createDataFrame(sizes, "layer_id string, bytes long"), max_mb)
    except Exception:
        # A refused or failed map leaves no file; those of earlier versions stay.
        for target in fresh:
            _folder(spark, target).delete()
        raise
    sub_layers(spark, rows).write.mode("overwrite").parquet(f"{path}/sub_layers")
    manifest = manifest_frame(spark, rows)
    write_manifest(manifest, f"{path}/manifest")
    return manifest


class _folder:
    """A folder in whatever file system its path names, as Spark's writer sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.system = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.system.exists(self.path)

    def delete(self) -> None:
        self.system.delete(self.path, True)


def sub_layers(spark: SparkSession, rows: Sequence[dict[str, Any]]) -> DataFrame:
    """Batches of a map's layers with their row offsets, read from the encoded files without payloads."""
    stored = spark.read.schema(PAYLOAD_SCHEMA)
    tables = [stored.parquet(r["data_path"]).select("layer_id", "batch_id", "num_rows") for r in rows]
    batches = row_offsets(reduce(DataFrame.unionByName, tables))
    name = F.concat_ws("-", "layer_id", F.col("batch_id").cast("string"))
    return batches.select("layer_id", "batch_id", name.alias("sub_layer_id"), "num_rows", "row_offset")


def _together(task: Callable[[int], Any], count: int) -> list[Any]:
    """Jobs of independent layers side by side, so that small layers do not wait for big ones."""
    if count == 1:
        return [task(0)]
    with ThreadPoolExecutor(max_workers=min(count, LAYERS_AT_ONCE)) as pool:
        return list(pool.map(task, range(count)))


def _encode(
    layer: DataFrame, spec: LayerSpec, row: dict[str, Any], encoding: str, target: str, per_batch: int
) -> int:
    encoded = encode_layer(
        layer, spec.layer_id, encoding, per_batch, spec.id_col, num_rows=row["num_rows"], num_bytes=row["bytes"]
    )
    encoded.write.mode("overwrite").option("compression", "none").parquet(target)
    written = layer.sparkSession.read.schema(PAYLOAD_SCHEMA).parquet(target)
    return written.agg(F.coalesce(F.sum("byte_length"), F.lit(0)).alias("b")).first()["b"]


def _compare(
    spark: SparkSession, rows: list[dict[str, Any]], previous: DataFrame | None
) -> tuple[dict[str, tuple[str, list[str]]], dict[str, dict[str, Any]]]:
    """Verdict per layer, and the previous manifest by layer: both one row per layer."""
    if previous is None:
        return {}, {}
    found = diff_layers(previous, manifest_frame(spark, rows)).collect()
    old = {r["layer_id"]: r.asDict() for r in previous.collect()}
    return {r["layer_id"]: (r["verdict"], r["changed_columns"]) for r in found}, old


def _refuse_broken(broken: dict[str, int], spec: LayerSpec) -> None:
    bad = {k: v for k, v in broken.items() if v and not k.endswith("_null")}
    if bad:
        text = ", ".join(f"{k}: {v} rows" for k, v in sorted(bad.items()))
        raise ValueError(f"layer {spec.layer_id!r} breaks its contract ({text})")


def _content_tag(row: dict[str, Any]) -> str:
    text = f"{row['num_rows']}|{row['body_encoding']}|" + "|".join(f"{k}:{v}" for k, v in sorted(row["column_fps"].items()))
    return hashlib.sha256(text.encode()).hexdigest()[:16]
