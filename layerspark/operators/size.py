"""Layer sizes, encodings and the view that shows a layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerspark.functions.widths import row_width
from layerspark.spec import COMPRESSION_ENCODING, ENCODINGS

# Bytes from which a layer is compressed, and written as Parquet.
ZSTD_FROM_BYTES = 1_000_000
PARQUET_FROM_BYTES = 20_000_000
# Fixed value: largest zoom of the automatic view.
MAX_ZOOM = 20.0


def layer_bytes(df: DataFrame, layer_id: str | None = None) -> DataFrame:
    """Rows and uncompressed bytes of a layer: one row."""
    sized = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.ceil(F.sum(row_width(df.schema))), F.lit(0)).cast("long").alias("bytes"),
    )
    return sized.select(F.lit(layer_id).alias("layer_id"), "rows", "bytes") if layer_id else sized


def requested_encoding(compression: str | None) -> str:
    if compression not in COMPRESSION_ENCODING:
        raise ValueError(
            f"no encoding is known for compression {compression!r}; known: {list(COMPRESSION_ENCODING)}"
        )
    return COMPRESSION_ENCODING[compression]


def encoding_for(size: Column, requested: str | Column = "auto") -> Column:
    """Encoding by size for ``auto``; any other request stands whatever the size."""
    request = F.lit(requested) if isinstance(requested, str) else requested
    by_size = (
        F.when(size >= PARQUET_FROM_BYTES, "parquet").when(size >= ZSTD_FROM_BYTES, "ipc-zstd").otherwise("ipc")
    )
    return F.when(request == "auto", by_size).otherwise(request)


def choose_encoding(sizes: DataFrame, requested: str = "auto") -> DataFrame:
    """Encoding of each layer, from a table of one row per layer."""
    if requested != "auto" and requested not in ENCODINGS:
        raise ValueError(f"unknown encoding {requested!r}")
    return sizes.withColumn("encoding", encoding_for(F.col("bytes"), requested))


def format_sizes(df: DataFrame) -> DataFrame:
    """Bytes of the same rows as Arrow buffers and as row JSON, and their ratio."""
    as_json = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    sized = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.ceil(F.sum(row_width(df.schema))).cast("long").alias("arrow_bytes"),
        # One comma or bracket follows each record of a JSON list.
        F.sum(F.octet_length(as_json).cast("long") + F.lit(1)).alias("json_bytes"),
    )
    return sized.withColumn("ratio", F.col("json_bytes") / F.col("arrow_bytes"))


def viewport(
    df: DataFrame, lon: str = "lon", lat: str = "lat", strict: bool = False
) -> DataFrame:
    """Centre (mean), bounds and zoom of a layer; missing places are skipped.

    ``strict`` raises on a missing place instead. A layer without any place gives
    the view 0, 0 at zoom 0, as an unset view does.
    """
    x, y = F.col(lon), F.col(lat)
    missing = x.isNull() | y.isNull() | F.isnan(x) | F.isnan(y)
    if strict:
        text = F.lit("a null or NaN place leaves the view undefined: drop it or pass a view state")
        x = F.when(~missing, x).otherwise(F.raise_error(text))
        y = F.when(~missing, y).otherwise(F.raise_error(text))
    else:
        x, y = F.when(~missing, x), F.when(~missing, y)
    found = df.agg(
        F.avg(x).alias("longitude"),
        F.avg(y).alias("latitude"),
        F.min(x).alias("west"),
        F.min(y).alias("south"),
        F.max(x).alias("east"),
        F.max(y).alias("north"),
        F.count(F.when(missing, F.lit(1))).alias("skipped"),
    )
    span = F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"))
    return found.select(
        F.coalesce("longitude", F.lit(0.0)).alias("longitude"),
        F.coalesce("latitude", F.lit(0.0)).alias("latitude"),
        zoom_for(span).alias("zoom"),
        "west",
        "south",
        "east",
        "north",
        "skipped",
    )


def zoom_for(span: Column) -> Column:
    """Zoom at which the whole span is in view, between 0 and 20."""
    return (
        F.when(span.isNull(), F.lit(0.0))
        .when(span <= 0, F.lit(MAX_ZOOM))
        .otherwise(F.least(F.greatest(F.log2(F.lit(360.0) / span), F.lit(0.0)), F.lit(MAX_ZOOM)))
    )
