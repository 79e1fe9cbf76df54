"""Streams against their batch twins."""

import pytest
from layerspark.plans import fixtures as fx
from plan_text import plan_of
from layerspark.streaming import (
    gate,
    gated_writer,
    latest_view,
    picks_to_rows,
    rows_writer,
    throttle,
    throttle_stream,
)
from pyspark.sql import functions as F


@pytest.fixture
def sliced(spark, sf, tmp_path):
    """The events in four files of consecutive times, taken one per micro-batch."""
    events = fx.table(spark, sf, "events").orderBy("ts")
    n = events.count()
    folder = tmp_path / "events"
    for i in range(4):
        part = events.where((F.col("event_id") >= i * n // 4) & (F.col("event_id") < (i + 1) * n // 4))
        part.coalesce(1).write.mode("append").parquet(str(folder))
    schema = events.schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    return fx.as_interactions(reader.parquet(str(folder)))


def finished(stream, tmp_path, name, mode="append"):
    out = str(tmp_path / name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / f"{name}_cp"))
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert query.exception() is None
    return query.sparkSession.read.schema(stream.schema).parquet(out) if hasattr(query, "sparkSession") else out


def test_throttle_keeps_its_state_over_micro_batches(spark, sf, sliced, tmp_path):
    slim = sliced.select("event_id", "ts", "session")
    out = finished(throttle_stream(slim, ["session"], 3_600_000, watermark="30 days"), tmp_path, "out")
    got = spark.read.parquet(out) if isinstance(out, str) else out
    want = throttle(fx.interactions(spark, sf).select("event_id", "ts", "session"), ["session"], 3_600_000)
    assert sorted(r["event_id"] for r in got.collect()) == sorted(r["event_id"] for r in want.collect())


def test_throttle_state_expires(spark, sf, sliced, tmp_path):
    """A short watermark drops state that can hold nothing back, and no event in order."""
    slim = sliced.select("event_id", "ts", "session")
    out = finished(throttle_stream(slim, ["session"], 3_600_000, watermark="0 seconds"), tmp_path, "out")
    got = spark.read.parquet(out) if isinstance(out, str) else out
    want = throttle(fx.interactions(spark, sf).select("event_id", "ts", "session"), ["session"], 3_600_000)
    assert {r["event_id"] for r in got.collect()} <= {r["event_id"] for r in fx.interactions(spark, sf).collect()}
    assert got.count() >= want.count() * 0.9


def test_gate_defaults(spark, sf):
    kinds = gate(fx.interactions(spark, sf)).select("kind").distinct().collect()
    assert [r["kind"] for r in kinds] == ["clicked"]


def test_flags_are_read_for_every_micro_batch(spark, sliced, tmp_path):
    seen = []

    def read_flags(session):
        # Hovers are switched on from the third micro-batch.
        return session.createDataFrame([("hovered", len(seen) >= 2), ("clicked", False)], "kind string, enabled boolean")

    def write(batch, batch_id):
        seen.append({r["kind"]: r["count"] for r in batch.groupBy("kind").count().collect()})

    query = (
        sliced.writeStream.foreachBatch(gated_writer(read_flags, write))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert [sorted(s) for s in seen] == [[], [], ["hovered"], ["hovered"]]


def test_latest_view_in_update_mode(spark, sf, sliced, tmp_path):
    out = str(tmp_path / "views")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (
        latest_view(sliced)
        .writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = {r["session"]: r["event_id"] for r in latest_view(spark.read.parquet(out), kind=None).collect()}
    want = {r["session"]: r["event_id"] for r in latest_view(fx.interactions(spark, sf)).collect()}
    assert got == want and len(got) > 10


def test_streamed_picks_equal_the_batch_join(spark, sf, sliced, tmp_path):
    offsets, layer = fx.sub_layers(spark, sf), tmp_path / "layer"
    fx.indexed_layer(spark, sf).write.parquet(str(layer))
    layer = spark.read.parquet(str(layer))
    out, plans = str(tmp_path / "rows"), []

    def write(rows, batch_id):
        plans.append(plan_of(rows))
        rows.select("event_id", "feature_id").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (
        sliced.writeStream.foreachBatch(rows_writer(offsets, layer, write))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("event_id", "feature_id").collect())
    want = picks_to_rows(fx.interactions(spark, sf), offsets, layer).select("event_id", "feature_id")
    assert got == sorted(tuple(r) for r in want.collect()) and got
    assert all("GreaterThanOrEqual(row_index" in p for p in plans)
