"""Reading layer tables from Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the statistics of a cell table.
CELL_STATISTICS = ("mean", "std", "min", "max", "p10", "p90")


def scan_layer(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Layer table with only the named columns; the scan reads no others."""
    df = spark.read.parquet(path)
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def scan_cell_stats(
    spark: SparkSession, path: str, level: str, prefix: str = "dem_", key: str = "cell_id"
) -> DataFrame:
    """Statistics of one grid level, from a table partitioned by ``level``.

    The level is a partition column, so other levels are not read at all.
    """
    names = [f"{prefix}{s}" for s in CELL_STATISTICS]
    return spark.read.parquet(path).where(F.col("level") == level).select(key, *names)
