"""Layer change feed: each new version is compared with the last one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from layerspark.operators.version import diff_layers
from layerspark.plans.render import manifest_of
from layerspark.spec import LayerSpec


def layer_change_feed(
    versions: DataFrame,
    spec: LayerSpec,
    load: Callable[[SparkSession, str], DataFrame],
    folder: str,
    checkpoint: str,
    algo: str = "xxhash64",
) -> StreamingQuery:
    """Append a verdict for every announced version of a layer.

    ``versions`` is a stream with ``version`` (ordered) and ``path``; ``load`` reads
    the layer table of a path. Manifests and verdicts are written per micro-batch
    under its number, so a repeated micro-batch overwrites its own output only.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Announcements are a few rows per micro-batch; the layers themselves stay in Spark.
        for i, row in enumerate(batch.orderBy("version").toLocalIterator()):
            slot = f"{batch_id:012d}-{i:06d}"
            current = manifest_of(load(spark, row["path"]), spec, algo=algo).withColumns(
                {"version_id": F.lit(row["version"]), "slot": F.lit(slot)}
            )
            current.write.mode("overwrite").parquet(f"{folder}/manifests/{slot}")
            stored = spark.read.parquet(f"{folder}/manifests/{slot}")
            previous = _previous(spark, folder, slot, stored)
            verdict = diff_layers(previous, stored).withColumn("version", F.lit(row["version"]))
            verdict.coalesce(1).write.mode("overwrite").parquet(f"{folder}/verdicts/{slot}")

    return (
        versions.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _previous(spark: SparkSession, folder: str, slot: str, stored: DataFrame) -> DataFrame:
    """Manifest of the version before this one; empty for the first."""
    known = spark.read.schema(stored.schema).option("recursiveFileLookup", "true").parquet(
        f"{folder}/manifests"
    )
    before = known.where(F.col("slot") < slot)
    latest = before.agg(F.max("slot").alias("m"))
    return before.where(F.col("slot") == latest.scalar())


def read_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/verdicts")
