"""The manifest: one row per layer of a map."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from layerspark.operators.order import byte_offsets
from layerspark.spec import FORMAT_VERSION, LayerSpec, MapSpec, to_json

MANIFEST_SCHEMA = """
    map_id string, version int, position int, layer_id string, layer_type string, props string,
    extensions string, tooltip string, body_encoding string, num_rows long, bytes long,
    byte_length long, data_path string, patch_path string, patch_columns array<string>,
    geometry_fp string, props_fp string, column_fps map<string,string>,
    view_state string, map_options string, time_unit string
"""


def manifest_row(
    spec: LayerSpec,
    position: int,
    encoding: str,
    tooltip: list[str],
    facts: Mapping[str, Any],
    map_spec: MapSpec | None = None,
    map_id: str = "map",
) -> dict[str, Any]:
    """Manifest entry of one layer; empty extensions and hover columns are left out (null),
    and so is the encoding of plain Arrow."""
    extensions = spec.wire_extensions()
    view = map_spec.view_state if map_spec else None
    return {
        "map_id": map_id,
        "version": FORMAT_VERSION,
        "position": position,
        "layer_id": spec.layer_id,
        "layer_type": spec.layer_type,
        "props": to_json(spec.wire_props(), f"layer {spec.layer_id!r} props"),
        "extensions": to_json(extensions, "extensions") if extensions else None,
        "tooltip": to_json(tooltip, "tooltip") if tooltip else None,
        "body_encoding": None if encoding == "ipc" else encoding,
        "view_state": None if view is None else to_json(dict(view), "view_state"),
        "map_options": to_json(dict(map_spec.options) if map_spec else {}, "map_options"),
        "patch_path": None,
        "patch_columns": None,
        "data_path": None,
        "time_unit": None,
        **facts,
    }


def manifest_frame(spark: SparkSession, rows: list[dict[str, Any]]) -> DataFrame:
    """Manifest table with byte offsets in list order. One row per layer: driver-sized."""
    return byte_offsets(spark.createDataFrame(rows, MANIFEST_SCHEMA))


def write_manifest(manifest: DataFrame, path: str, mode: str = "overwrite") -> None:
    manifest.coalesce(1).write.mode(mode).parquet(path)
