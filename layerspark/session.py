"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when a count shows at most this many rows.
BROADCAST_ROWS = 100_000


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on.

    On a cluster leave ``master`` to spark-submit; sizes such as the number of
    shuffle partitions belong to the cluster too and are passed through ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call sites per column expression cost more than building the expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application.

    Functions that run in workers import it, and a worker need not have it installed.
    Spark hands the archive to every executor; its file is only read by the driver.
    """
    context = spark.sparkContext
    name = "layerspark-package.zip"
    if any(os.path.basename(f) == name for f in context._python_includes):
        return spark
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="layerspark-"), name)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(root):
            for file in sorted(files):
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(archive)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared checkpoint folder.

    A local folder is used only when the folder is unset and Spark runs in local
    mode, as in tests; on a cluster an unset folder is an error, because
    executors do not share a local disk and may be lost with it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="layerspark-")
    return f"{base.rstrip('/')}/layerspark/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Cuts the lineage at a table that outlives any executor, and makes values
    fixed at write time (partition numbers, for instance) the same for every
    later reader. Unlike a cached DataFrame, later readers prune its columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._scratch_path = path
    return stored


def materialize_observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize``, and aggregates of the rows taken while they are written.

    Saves the query that would read the table again for a count.
    """
    seen = Observation()
    stored = materialize(df.observe(seen, *[m.alias(n) for n, m in metrics.items()]), name)
    return stored, seen.get


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables of ``materialize`` that nothing reads any more.

    Only for tables whose readers have all been written themselves: a lost executor then
    never asks for them again.
    """
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after a count; otherwise leave the join to AQE.

    The count is a plain aggregate: a limit before it would send that many rows of
    every partition to one task.
    """
    if df.count() <= max_rows:
        return F.broadcast(df)
    return df
