"""Writing layer tables, encoded batches and manifests."""

from layerspark.sinks.encode import decode_layer, decode_payload, encode_layer
from layerspark.sinks.files import (
    records_json,
    write_layer_arrow,
    write_layer_parquet,
    write_layers_partitioned,
    write_records_json,
)
from layerspark.sinks.manifest import manifest_row, write_manifest
from layerspark.sinks.rows import StoredRows, write_rows

__all__ = [
    "StoredRows",
    "decode_layer",
    "decode_payload",
    "encode_layer",
    "manifest_row",
    "records_json",
    "write_layer_arrow",
    "write_layer_parquet",
    "write_layers_partitioned",
    "write_manifest",
    "write_records_json",
    "write_rows",
]
