"""Row numbers and offsets without a single-partition window."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerspark.functions.geo import hilbert_index
from layerspark.functions.widths import row_width
from layerspark.session import broadcast_if_small, materialize


def row_offsets(batches: DataFrame, layer: str = "layer_id", batch: str = "batch_id") -> DataFrame:
    """Rows in earlier batches of the same layer; one input row per batch."""
    earlier = (
        Window.partitionBy(layer).orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("num_rows").over(earlier), F.lit(0)).cast("long")
    return batches.withColumn("row_offset", offset)


def byte_offsets(manifest: DataFrame) -> DataFrame:
    """Bytes of earlier layers of the same map, in list order; one input row per layer."""
    by_map = ["map_id"] if "map_id" in manifest.columns else [F.lit(0)]
    earlier = (
        Window.partitionBy(*by_map).orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("byte_length").over(earlier), F.lit(0)).cast("long")
    return manifest.withColumn("byte_offset", offset)


def row_index(
    df: DataFrame,
    order: Sequence[str] = ("feature_id",),
    partitions: int | None = None,
    name: str = "row_index",
    within: Sequence[str] = (),
    keep_part: bool = False,
) -> DataFrame:
    """Position of each row, from 0, in the order of the given columns.

    With ``within`` (columns that lead the order, such as a layer id) the
    position starts again in each group; a group may span many partitions.

    The rows are range-partitioned and sorted once; Spark's own counter then
    numbers them inside each partition while streaming. The table is written to
    the scratch folder, so that the numbers stay fixed while the per-partition
    counts (one row per partition, which bounds the broadcast) become offsets.
    Equal order keys stay in one partition: give enough columns to tell rows apart.
    ``keep_part`` keeps the number of the partition as ``_part``.
    """
    if list(order[: len(within)]) != list(within):
        raise ValueError("the columns of 'within' must lead the order")
    by = [F.col(c) for c in order]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    indexed = row_positions(ranged.sortWithinPartitions(*by), name, keep_part)
    if not within:
        return indexed
    first = indexed.groupBy(*within).agg(F.min("row_index").alias("_first"))
    grouped = indexed.join(broadcast_if_small(first), list(within))
    return grouped.withColumn("row_index", F.col("row_index") - F.col("_first")).drop("_first")


def row_positions(df: DataFrame, name: str = "row_positions", keep_part: bool = False) -> DataFrame:
    """Position of each row, from 0, in the order in which the rows of ``df`` lie now."""
    table = materialize(df.withColumn("_spot", F.monotonically_increasing_id()), name)
    # The counter holds the partition number above bit 33 and the position below.
    partition = F.shiftrightunsigned(F.col("_spot"), 33)
    counts = (
        table.groupBy(partition.alias("batch_id"))
        .agg(F.count(F.lit(1)).alias("num_rows"))
        .withColumn("layer_id", F.lit(name))
    )
    offsets = row_offsets(counts).select(F.col("batch_id").alias("_part"), "row_offset")
    place = F.col("_spot").bitwiseAND(F.lit((1 << 33) - 1))
    indexed = (
        table.withColumn("_part", partition)
        .join(F.broadcast(offsets), "_part")
        .withColumn("row_index", F.col("row_offset") + place)
        .drop("_spot", "row_offset")
    )
    return indexed if keep_part else indexed.drop("_part")


def assign_batches(
    df: DataFrame,
    rows_per_batch: int,
    order: Sequence[str] = ("feature_id",),
    partitions: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """Batch number and position, from the order columns and the rows' widths alone.

    Unlike a partition number, the batch does not depend on sampled bounds, so
    the same rows give the same batches in every run. A batch ends after
    ``rows_per_batch`` rows, or with the row that takes the running width past a
    multiple of ``bytes_per_batch``: it is at most one row wider than that.
    """
    if bytes_per_batch is None:
        indexed = row_index(df, order, partitions, "batches")
        return indexed.withColumn("batch_id", F.floor(F.col("row_index") / F.lit(rows_per_batch)).cast("long"))
    width = F.ceil(row_width(df.schema)).cast("long")
    indexed = row_index(df.withColumn("_width", width), order, partitions, "batches", keep_part=True)
    # Only positions and widths are shuffled to find where batches start.
    slim = indexed.select("_part", "row_index", "_width")
    parts = slim.groupBy(F.col("_part").alias("batch_id")).agg(F.sum("_width").alias("num_rows"))
    bytes_before = row_offsets(parts.withColumn("layer_id", F.lit("batches")))
    bytes_before = bytes_before.select(F.col("batch_id").alias("_part"), F.col("row_offset").alias("_before"))
    earlier = Window.partitionBy("_part").orderBy("row_index").rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum("_width").over(earlier), F.lit(0))
    full = F.floor(F.col("row_index") / F.lit(rows_per_batch)) + F.floor(
        (F.col("_before") + F.col("_running")) / F.lit(bytes_per_batch)
    )
    cut = slim.withColumn("_running", running).join(F.broadcast(bytes_before), "_part").withColumn("_full", full)
    starts = cut.groupBy("_full").agg(F.min(F.struct("row_index", "_part")).alias("s")).select("s.*")
    starts = starts.groupBy("_part").agg(
        F.array_sort(F.collect_list("row_index")).alias("_starts"), F.count(F.lit(1)).alias("num_rows")
    )
    none = F.array().cast("array<long>")
    found = bytes_before.join(starts, "_part", "left").select(
        F.lit("batches").alias("layer_id"),
        F.col("_part").alias("batch_id"),
        F.coalesce("num_rows", F.lit(0)).alias("num_rows"),
        F.coalesce("_starts", none).alias("_starts"),
    )
    # One row per partition, and in them one number per batch.
    found = row_offsets(found).select(F.col("batch_id").alias("_part"), "_starts", "row_offset")
    here = F.size(F.filter("_starts", lambda start: start <= F.col("row_index")))
    return (
        indexed.join(F.broadcast(found), "_part")
        .withColumn("batch_id", (F.col("row_offset") + here - 1).cast("long"))
        .drop("_part", "_width", "_starts", "row_offset")
    )


# Columns that tell rows of one id apart: a hash of the row, and where copies stand.
TIE = ("_tie", "_copy")


def with_tie(df: DataFrame) -> DataFrame:
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.withColumns({TIE[0]: hashed, TIE[1]: F.monotonically_increasing_id()})


def batch_starts(
    df: DataFrame, id_col: str, rows_per_batch: int, bytes_per_batch: int, partitions: int | None = None
) -> list[tuple]:
    """First id, and what tells its copies apart, of every batch but the first.

    Only ids, ties and widths are numbered, so the wide rows move once, when they are
    sent to their batch. Cuts follow the order of ids alone, as in ``assign_batches``. One
    small tuple per batch reaches the driver.
    """
    width = F.ceil(row_width(df.schema)).cast("long")
    key = [id_col, *TIE]
    slim = with_tie(df).select(*key, width.alias("_width"))
    indexed = row_index(slim, key, partitions, "batch_starts", keep_part=True)
    parts = indexed.groupBy(F.col("_part").alias("batch_id")).agg(F.sum("_width").alias("num_rows"))
    before = row_offsets(parts.withColumn("layer_id", F.lit("batches")))
    before = before.select(F.col("batch_id").alias("_part"), F.col("row_offset").alias("_before"))
    # Spark's counter ran in this order, so a partition's rows are still sorted by their place.
    earlier = Window.partitionBy("_part").orderBy("row_index").rowsBetween(Window.unboundedPreceding, -1)
    running = F.col("_before") + F.coalesce(F.sum("_width").over(earlier), F.lit(0))
    full = F.floor(F.col("row_index") / F.lit(rows_per_batch)) + F.floor(running / F.lit(bytes_per_batch))
    cut = indexed.join(F.broadcast(before), "_part").withColumn("_full", full)
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in key]), "row_index")
    starts = cut.groupBy("_full").agg(first.alias("k")).orderBy("_full").select("k.*").collect()
    return [tuple(r) for r in starts[1:]]


def batch_of(starts: list[tuple], kind: str):
    """Function of id and ties to the number of the batch; nulls sort first, as in Spark."""
    nulls = sum(1 for s in starts if s[0] is None)
    ids = pd.Series([s[0] for s in starts[nulls:]], dtype=object if kind == "string" else None)
    ties = [s[1:] for s in starts]

    @F.pandas_udf("long")
    def number(key: pd.Series, tie: pd.Series, copy: pd.Series) -> pd.Series:
        missing = key.isna().to_numpy()
        low, high = np.zeros(len(key), dtype=np.int64), np.full(len(key), nulls, dtype=np.int64)
        known = key[~missing]
        if len(known):
            low[~missing] = nulls + (ids.searchsorted(known, side="left") if len(ids) else 0)
            high[~missing] = nulls + (ids.searchsorted(known, side="right") if len(ids) else 0)
        # Only an id that a batch starts with needs its ties compared.
        for i in np.flatnonzero(low < high):
            low[i] = bisect_right(ties, (tie.iat[i], copy.iat[i]), int(low[i]), int(high[i]))
        return pd.Series(low)

    return number


def batch_table(batched: DataFrame, layer_id: str) -> DataFrame:
    """One row per batch of a layer: sub-layer id, rows and row offset."""
    counts = (
        batched.groupBy("batch_id")
        .agg(F.count(F.lit(1)).alias("num_rows"))
        .withColumn("layer_id", F.lit(layer_id))
    )
    return row_offsets(counts).select(
        "layer_id",
        "batch_id",
        F.concat_ws("-", "layer_id", F.col("batch_id").cast("string")).alias("sub_layer_id"),
        "num_rows",
        "row_offset",
    )


def sort_for_encoding(df: DataFrame, *keys: str) -> DataFrame:
    """Neighbouring rows next to each other, which compresses better.

    A key with very many rows should be followed by the id, so that its range
    can be split over partitions.
    """
    by = [F.col(k) for k in keys]
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def hilbert_order(
    df: DataFrame,
    lon: str = "lon",
    lat: str = "lat",
    id_col: str = "feature_id",
    bits: int = 16,
    name: str = "hilbert",
) -> DataFrame:
    """Rows along a Hilbert curve over their places, with their index on it as ``name``.

    Rows of one cell lie in id order, so that a crowded cell can be split over
    partitions; rows without a place come first. An empty table stays empty.
    """
    if name in df.columns:
        raise ValueError(f"the table has a column {name!r} already; choose another name")
    coded = df.withColumn(name, hilbert_index(f"`{lon}`", f"`{lat}`", bits))
    return sort_for_encoding(coded, f"`{name}`", f"`{id_col}`")


def canonical_order(df: DataFrame, id_col: str = "feature_id") -> DataFrame:
    """Id column first, the others by name; rows in id order."""
    others = sorted(c for c in df.columns if c != id_col)
    return sort_for_encoding(df.select(id_col, *[F.col(f"`{c}`") for c in others]), id_col)
