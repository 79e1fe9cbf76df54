"""Layer configuration and the schema contract of a layer table."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column
from pyspark.sql.types import StructType

# Layer types, extension types, accessors that carry geometry, and
# the Arrow metadata key and prefix of geometry columns.
LAYER_TYPES = (
    "scatterplot",
    "path",
    "polygon",
    "solid-polygon",
    "heatmap",
    "h3-hexagon",
    "s2",
    "a5",
    "geohash",
    "arc",
    "column",
    "point-cloud",
    "trip",
)
GEOMETRY_ACCESSORS = {
    "h3-hexagon": ("get_hexagon",),
    "s2": ("get_s2_token",),
    "a5": ("get_pentagon",),
    "geohash": ("get_geohash",),
    "arc": ("get_source_position", "get_target_position"),
}
EXTENSION_TYPES = ("brushing", "collision-filter", "data-filter", "path-style")
ENCODINGS = ("ipc", "ipc-zstd", "parquet")
COMPRESSION_ENCODING = {None: "ipc", "zstd": "ipc-zstd", "parquet": "parquet", "auto": "auto"}
GEOMETRY_KEY = "ARROW:extension:name"
GEOMETRY_PREFIX = "geoarrow."
COLUMN_MARKER = "@@arrowColumn"
PROP_NAMES = {"_current_time": "currentTime"}
FORMAT_VERSION = 1


def geometry_metadata(kind: str) -> dict[str, str]:
    """Column metadata that marks a geometry column: point, linestring, polygon, ..."""
    return {GEOMETRY_KEY: GEOMETRY_PREFIX + kind}


@dataclass(frozen=True)
class Extension:
    """A layer extension and its own settings; unset settings are left out."""

    type: str
    props: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class LayerSpec:
    """One layer: its type, accessors, extensions and hover columns.

    An accessor given as a Column has one value per row and becomes a column of
    the layer table; any other value is a constant and becomes a prop; ``None``
    is unset and left out. ``props`` holds further constants.
    """

    layer_id: str
    layer_type: str
    accessors: Mapping[str, Any] = field(default_factory=dict)
    props: Mapping[str, Any] = field(default_factory=dict)
    extensions: tuple[Extension, ...] = ()
    tooltip: bool | tuple[str, ...] = False
    compression: str | None = "auto"
    id_col: str = "feature_id"

    def row_accessors(self) -> dict[str, Column]:
        """Accessors with a value per row, in name order."""
        return {k: v for k, v in sorted(self.accessors.items()) if isinstance(v, Column)}

    def wire_props(self) -> dict[str, Any]:
        """Constants and column markers under their camel-case names."""
        values = {**self.props, **self.accessors}
        out: dict[str, Any] = {}
        for name in sorted(values):
            value = values[name]
            if isinstance(value, Column):
                out[prop_name(name)] = {COLUMN_MARKER: name}
            elif value is not None:
                out[prop_name(name)] = value
        return out

    def wire_extensions(self) -> list[dict[str, Any]]:
        return [
            {
                "type": e.type,
                "props": {prop_name(k): v for k, v in sorted(e.props.items()) if v is not None},
            }
            for e in self.extensions
        ]

    def with_props(self, **props: Any) -> LayerSpec:
        return replace(self, props={**self.props, **props})


@dataclass(frozen=True)
class MapSpec:
    """View state and map options that go next to the layers."""

    view_state: Mapping[str, float] | None = None
    options: Mapping[str, Any] = field(default_factory=dict)


def prop_name(name: str) -> str:
    """Camel-case name of a setting, with the fixed exceptions."""
    if name in PROP_NAMES:
        return PROP_NAMES[name]
    return re.sub("_+(.?)", lambda found: found[1].upper(), name)


def to_json(value: Any, where: str) -> str:
    """JSON text with sorted keys; NaN and infinity are refused with advice."""
    bad = _non_finite(value, where)
    if bad:
        raise ValueError(
            f"{bad} is NaN or infinite, and JSON has no such number; set it by hand, or leave rows "
            "without a shape out of what it is computed from"
        )
    try:
        return json.dumps(value, sort_keys=True, allow_nan=False)
    except TypeError as error:
        raise ValueError(f"{where} cannot be written as JSON: {error}") from error


def _non_finite(value: Any, where: str) -> str | None:
    if isinstance(value, float) and not math.isfinite(value):
        return where
    if isinstance(value, Mapping):
        parts = [(f"{where}.{k}", v) for k, v in value.items()]
    elif isinstance(value, (list, tuple)):
        parts = [(f"{where}[{i}]", v) for i, v in enumerate(value)]
    else:
        return None
    return next((hit for name, v in parts if (hit := _non_finite(v, name))), None)


def geometry_columns(schema: StructType, layer_type: str) -> list[str]:
    """Columns that decide a layer's shapes: marked columns, then geometry accessors."""
    names = [
        f.name
        for f in schema.fields
        if str((f.metadata or {}).get(GEOMETRY_KEY, "")).startswith(GEOMETRY_PREFIX)
    ]
    for name in GEOMETRY_ACCESSORS.get(layer_type, ()):
        if name in schema.names and name not in names:
            names.append(name)
    return names


def check_layer(schema: StructType, spec: LayerSpec) -> None:
    """Refuse a layer that cannot be shown, before any job runs."""
    where = f"layer {spec.layer_id!r}"
    if spec.layer_type not in LAYER_TYPES:
        raise ValueError(
            f"{where}: layer type {spec.layer_type!r} is not supported; "
            f"supported types: {sorted(LAYER_TYPES)}"
        )
    for extension in spec.extensions:
        if extension.type not in EXTENSION_TYPES:
            raise ValueError(
                f"{where}: extension {extension.type!r} is not supported; "
                f"supported extensions: {sorted(EXTENSION_TYPES)}"
            )
    if spec.compression not in COMPRESSION_ENCODING:
        raise ValueError(
            f"{where}: no encoding is known for compression {spec.compression!r}; "
            f"known: {list(COMPRESSION_ENCODING)}"
        )
    if spec.id_col not in schema.names:
        raise ValueError(f"{where}: id column {spec.id_col!r} is missing")
    needed = GEOMETRY_ACCESSORS.get(spec.layer_type)
    if needed is None and not geometry_columns(schema, spec.layer_type):
        raise ValueError(f"{where} has no geometry column")
    per_row = spec.row_accessors()
    for name in needed or ():
        if name not in per_row:
            raise ValueError(
                f"{where}: {name!r} must be a column with one value per row; "
                f"a {spec.layer_type!r} layer cannot be shown without it"
            )
    to_json({**spec.wire_props(), "extensions": spec.wire_extensions()}, f"{where} props")
