"""Layer files: Parquet by Spark's writer, encoded batches, row JSON."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from layerspark.operators.order import canonical_order
from layerspark.sinks.encode import ROWS_PER_BATCH, encode_layer

# One row group per file up to this many bytes.
ROW_GROUP_BYTES = 512 * 1024 * 1024


def write_layer_parquet(
    df: DataFrame,
    path: str,
    id_col: str = "feature_id",
    sort: bool = True,
    mode: str = "overwrite",
) -> None:
    """ZSTD Parquet in id order by Spark's own writer; dictionaries for text only."""
    ordered = canonical_order(df, id_col) if sort else df
    writer = (
        ordered.write.mode(mode)
        .option("compression", "zstd")
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
    )
    for field in ordered.schema.fields:
        for leaf, is_text in _leaves(field.name, field.dataType):
            writer = writer.option(f"parquet.enable.dictionary#{leaf}", str(is_text).lower())
    writer.parquet(path)


def write_layer_arrow(
    df: DataFrame,
    path: str,
    layer_id: str,
    encoding: str = "ipc-zstd",
    rows_per_batch: int = ROWS_PER_BATCH,
    id_col: str = "feature_id",
    mode: str = "overwrite",
) -> None:
    """Encoded batches, one row each; the bytes are compressed already."""
    encoded = encode_layer(df, layer_id, encoding, rows_per_batch, id_col)
    encoded.write.mode(mode).option("compression", "none").parquet(path)


def write_layers_partitioned(encoded: Sequence[DataFrame], path: str, mode: str = "overwrite") -> None:
    """Several encoded layers, each with its own encoding, in one table by layer.

    The batches of a big layer stay spread over tasks: nothing is gathered per layer.
    """
    stacked = reduce(lambda a, b: a.unionByName(b), encoded)
    stacked.write.mode(mode).option("compression", "none").partitionBy("layer_id").parquet(path)


def records_json(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """One JSON object per row, nulls written out."""
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record")
    return df.select(*([id_col] if id_col else []), record)


def write_records_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def _leaves(path: str, dtype: DataType) -> list[tuple[str, bool]]:
    if isinstance(dtype, ArrayType):
        return _leaves(f"{path}.list.element", dtype.elementType)
    if isinstance(dtype, StructType):
        return [leaf for f in dtype.fields for leaf in _leaves(f"{path}.{f.name}", f.dataType)]
    return [(path, isinstance(dtype, StringType))]
