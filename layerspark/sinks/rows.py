"""Rows of a layer table stored with their index, so that a lookup numbers nothing.

Writing sorts the rows once by range. Each range is a slice, a folder of its own, in
which Spark's counter gives every row its seat. What turns seats into row indexes is
written beside it: ``bounds``, one row per layer and slice with the first index, and,
for layers made of batches, ``batches`` with the row offset of each. Both come from one
aggregate over three narrow columns of the files.

A lookup goes the other way: the pick's layer and index find its slice among the
bounds, by blocks of ``BLOCK_ROWS`` indexes so that it is an equal-key join, and the rows
are joined by slice and seat. The slices that were picked prune the folders read.

Rows whose order columns are all equal share a slice; give enough columns to tell rows
apart. Nulls in the order come first. An empty layer has no bounds and no batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 16
SEAT_BITS = 33


def write_rows(
    layer: DataFrame,
    path: str,
    order: Sequence[str] = ("feature_id",),
    within: str = "layer_id",
    batch: str | None = "batch_id",
    partitions: int | None = None,
    mode: str = "error",
) -> StoredRows:
    """Store ``layer`` below ``path``, indexed per value of ``within`` in the given order.

    The order starts with ``within`` and, if there are batches, with ``batch`` after it.
    """
    leading = [within] + ([batch] if batch else [])
    if list(order[: len(leading)]) != leading:
        raise ValueError(f"the order must start with {leading}")
    spark = layer.sparkSession
    by = [F.col(c) for c in order]
    ranged = layer.repartitionByRange(partitions, *by) if partitions else layer.repartitionByRange(*by)
    spot = F.monotonically_increasing_id()
    seated = ranged.sortWithinPartitions(*by).withColumn("_spot", spot)
    # The counter holds the partition number above the seat.
    seated = seated.withColumns(
        {
            "_seat": F.col("_spot").bitwiseAND(F.lit((1 << SEAT_BITS) - 1)),
            "_slice": F.shiftrightunsigned("_spot", SEAT_BITS).cast("long"),
        }
    ).drop("_spot")
    seated.write.mode(mode).partitionBy("_slice").parquet(f"{path}/rows")

    # A table without folders has no file to tell its columns.
    spark.createDataFrame([], seated.schema).write.mode(mode).parquet(f"{path}/columns")

    stored = spark.read.schema(seated.schema).parquet(f"{path}/rows")
    counts = stored.groupBy(*leading, "_slice").agg(
        F.count(F.lit(1)).alias("num_rows"), F.min("_seat").alias("first_seat")
    )
    counts = counts.select(
        *leading, "_slice", "num_rows", "first_seat", _before([within], [*leading[1:], "_slice"]).alias("row_offset")
    )
    # A slice and a layer, or a slice and a batch, meet once: as many rows as there are folders
    # and batches.
    counts.write.mode(mode).parquet(f"{path}/runs")
    return StoredRows(spark, path, within, batch)


def _before(group: list[str], order: list[str]):
    """Rows of the group in earlier runs."""
    earlier = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("num_rows").over(earlier), F.lit(0)).cast("long")


class StoredRows:
    """A layer table written by ``write_rows``."""

    def __init__(self, spark: SparkSession, path: str, within: str = "layer_id", batch: str | None = "batch_id"):
        self.spark, self.path, self.within, self.batch = spark, path, within, batch

    def rows(self) -> DataFrame:
        """Columns of the layer, and slice and seat of each row."""
        columns = self.spark.read.parquet(f"{self.path}/columns").schema
        return self.spark.read.schema(columns).parquet(f"{self.path}/rows")

    def runs(self) -> DataFrame:
        """Rows of one layer (and batch) in one slice: their number, first seat and first row index."""
        return self.spark.read.parquet(f"{self.path}/runs")

    def sub_layers(self) -> DataFrame:
        """One row per batch: sub-layer id, rows and row offset, as a list of sub-layers has them."""
        if not self.batch:
            raise ValueError("the layer was stored without batches")
        runs = self.runs().groupBy(self.within, self.batch)
        found = runs.agg(F.sum("num_rows").alias("num_rows"), F.min("row_offset").alias("row_offset"))
        name = F.concat_ws("-", F.col(self.within), F.col(self.batch).cast("string"))
        return found.select(self.within, self.batch, name.alias("sub_layer_id"), "num_rows", "row_offset")

    def indexed(self) -> DataFrame:
        """All rows with their index; the runs are one row per folder and batch."""
        keys = ["_slice", self.within, *([self.batch] if self.batch else [])]
        runs = self.runs().withColumnsRenamed({k: f"_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        joined = self.rows().join(runs, same)
        index = F.col("row_offset") + F.col("_seat") - F.col("first_seat")
        return joined.withColumn("row_index", index).drop(
            *[f"_{k}" for k in keys], "_slice", "_seat", "num_rows", "first_seat", "row_offset"
        )

    def lookup(
        self, picks: DataFrame, columns: Sequence[str] | None = None, index: str = "row_index"
    ) -> DataFrame:
        """Picks of a layer and row index with the row's columns; picks outside the layer have none.

        ``picks`` has ``within`` and ``index``; its columns come first and keep their names, so
        ``columns`` must not clash with them.
        """
        # A filter on this side tells Spark that the join may prune folders.
        runs = self.runs().filter("num_rows > 0")
        last = F.col("row_offset") + F.col("num_rows") - 1
        blocks = F.sequence(F.floor(F.col("row_offset") / BLOCK_ROWS), F.floor(last / BLOCK_ROWS))
        bounds = runs.select(
            F.col(self.within).alias("_layer"),
            F.col("_slice"),
            "first_seat",
            F.col("row_offset").alias("_first"),
            last.alias("_last"),
            F.explode(blocks).alias("_block"),
        )
        placed = picks.withColumn("_at", F.floor(F.col(index) / BLOCK_ROWS)).join(
            bounds, (F.col(self.within) == F.col("_layer")) & (F.col("_at") == F.col("_block"))
        )
        placed = placed.filter(F.col(index).between(F.col("_first"), F.col("_last")))
        placed = placed.withColumn("_seat", F.col(index) - F.col("_first") + F.col("first_seat"))
        placed = placed.select(*[F.col(f"`{c}`") for c in picks.columns], "_slice", "_seat")
        rows = self.rows()
        if columns is None:
            columns = [c for c in rows.columns if c not in ("_slice", "_seat", *picks.columns)]
        found = placed.join(rows.select("_slice", "_seat", *[F.col(f"`{c}`") for c in columns]), ["_slice", "_seat"])
        return found.drop("_slice", "_seat")
