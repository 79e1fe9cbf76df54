"""Gating interactions, the latest view, and picks in a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerspark.operators.picks import lookup_rows, resolve_picks
from layerspark.sinks.rows import StoredRows

# Which interactions are reported unless a flag says otherwise.
DEFAULT_FLAGS = {"clicked": True, "hovered": False, "view_state": False}


def read_events(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Event stream from Parquet files in a folder."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def gate(
    events: DataFrame, flags: DataFrame | None = None, kind: str = "kind", scope: Sequence[str] = ()
) -> DataFrame:
    """Events whose kind is switched on.

    ``flags`` has a row per kind (and per ``scope``, such as a session) with a
    boolean ``enabled``; a kind without a row keeps its default. Without a scope
    there are as many flags as kinds, which bounds the broadcast; with one, the
    join is left to AQE.
    """
    default = F.lit(False)
    for name, enabled in DEFAULT_FLAGS.items():
        default = F.when(F.col(kind) == name, F.lit(enabled)).otherwise(default)
    if flags is None:
        return events.where(default)
    keys = [*scope, kind]
    side = flags.groupBy(*keys).agg(F.bool_and("enabled").alias("_enabled"))
    if not scope:
        side = F.broadcast(side.where(F.col(kind).isin(list(DEFAULT_FLAGS))))
    joined = events.join(side, keys, "left")
    return joined.where(F.coalesce("_enabled", default)).drop("_enabled")


def gated_writer(
    read_flags: Callable[[SparkSession], DataFrame],
    write: Callable[[DataFrame, int], None],
    kind: str = "kind",
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that reads the flags anew for every micro-batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write(gate(batch, read_flags(batch.sparkSession), kind), batch_id)

    return run


def latest_view(
    events: DataFrame,
    session: str = "session",
    view: str = "view_state",
    ts: str = "ts",
    tie: str = "event_id",
    kind: str | None = "kind",
) -> DataFrame:
    """Last reported view state per session; works on a table and on a stream (update mode).

    Only view reports count; clicks and hovers may carry a view of their own. Without
    ``kind`` every row is a view report.

    The last value combines before the shuffle, so a busy session costs one row per task.
    """
    place = F.struct(F.col(ts), F.col(tie))
    last = F.max_by(F.struct(F.col(ts), F.col(tie), F.col(view)), place)
    return (
        events.where((F.col(kind) == "view_state" if kind else F.lit(True)) & F.col(view).isNotNull())
        .groupBy(session)
        .agg(last.alias("_l"))
        .select(session, F.col(f"_l.{ts}").alias(ts), F.col(f"_l.{tie}").alias(tie), F.col(f"_l.{view}").alias(view))
    )


def rows_writer(
    sub_layers: DataFrame,
    layer: DataFrame | StoredRows,
    write: Callable[[DataFrame, int], None],
    kind: str = "kind",
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that turns clicks and hovers into source rows.

    A stored layer is read where its bounds say. Of another table, the picks of a
    micro-batch are kept while it runs, and their first and last row bound the layer's
    scan. Spark knows their size and broadcasts them when they are few, so that the layer
    need not be shuffled.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        picks = resolve_picks(batch.where(F.col(kind).isin("clicked", "hovered")), sub_layers)
        if isinstance(layer, StoredRows):
            write(lookup_rows(picks, layer), batch_id)
            return
        picks = picks.persist()
        try:
            first, last = picks.agg(F.min("row_index"), F.max("row_index")).first()
            near = F.lit(False) if first is None else F.col("row_index").between(first, last)
            write(lookup_rows(picks, layer.where(near)), batch_id)
        finally:
            picks.unpersist()

    return run


def picks_to_rows(
    events: DataFrame,
    sub_layers: DataFrame,
    layer: DataFrame | StoredRows,
    kind: str = "kind",
    broadcast_rows: int = 100_000,
) -> DataFrame:
    """Source row of each click and hover; a stream-static join when events are a stream."""
    picks = events.where(F.col(kind).isin("clicked", "hovered"))
    return lookup_rows(resolve_picks(picks, sub_layers, broadcast_rows), layer)
