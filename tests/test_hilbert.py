"""Codes of lon/lat cells: the Hilbert curve, the row order along it, places without coordinates."""

import pytest
from layerspark.functions import geo
from layerspark.operators import cells, order
from layerspark.sources import gen_points
from plan_text import plan_of
from pyspark.sql import functions as F


def grid(spark, bits):
    """The middle of every cell, and the cell."""
    side = 1 << bits
    cells = spark.range(side * side).select((F.col("id") % side).alias("x"), F.floor(F.col("id") / side).alias("y"))
    return cells.withColumns(
        {"lon": (F.col("x") + 0.5) * 360.0 / side - 180.0, "lat": (F.col("y") + 0.5) * 180.0 / side - 90.0}
    )


@pytest.mark.parametrize("bits", [1, 2, 5])
def test_the_curve_visits_every_cell_and_only_steps_to_neighbours(spark, bits):
    rows = grid(spark, bits).select("x", "y", geo.hilbert_index("lon", "lat", bits).alias("d")).collect()
    lying = sorted(rows, key=lambda r: r["d"])
    assert [r["d"] for r in lying] == list(range(4**bits))
    assert (lying[0]["x"], lying[0]["y"]) == (0, 0)
    for a, b in zip(lying, lying[1:], strict=False):
        assert abs(a["x"] - b["x"]) + abs(a["y"] - b["y"]) == 1


def test_a_finer_curve_stays_within_the_cells_of_the_coarser(spark):
    """Two bits more turn the curve back to the same side, so prefixes agree."""
    cells = grid(spark, 5).select(
        geo.hilbert_index("lon", "lat", 5).alias("fine"), geo.hilbert_index("lon", "lat", 3).alias("coarse")
    )
    assert cells.where(F.floor(F.col("fine") / 16) != F.col("coarse")).count() == 0


def test_borders_nulls_and_the_finest_curve(spark):
    df = spark.createDataFrame(
        [(1, -180.0, -90.0), (2, 180.0, 90.0), (3, 179.999999, 89.999999), (4, None, 1.0), (5, 1.0, None), (6, 500.0, 95.0)],
        "feature_id long, lon double, lat double",
    )
    got = {r[0]: r[1] for r in df.select("feature_id", geo.hilbert_index("lon", "lat", 4)).collect()}
    assert got[1] == 0 and got[2] == got[3] == got[6]
    assert got[4] is None and got[5] is None
    finest = df.select(geo.hilbert_index("lon", "lat", 31).alias("d")).where("d IS NOT NULL").collect()
    assert all(0 <= r["d"] < 4**31 for r in finest)
    for bits in (0, 32):
        with pytest.raises(ValueError, match="1 to 31 bits"):
            geo.hilbert_index("lon", "lat", bits)


def test_order_keeps_all_rows_and_splits_a_crowded_cell(spark):
    df = spark.range(3_000).select(
        F.col("id").alias("feature_id"),
        F.when(F.col("id") % 3 == 0, 10.0).when(F.col("id") % 100 != 1, F.col("id") % 170).cast("double").alias("lon"),
        F.lit(20.0).alias("lat"),
        F.lit("kept").alias("code"),
    )
    lying = order.hilbert_order(df.repartition(4), bits=10)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merging)
    try:
        # So few rows would be merged into one partition.
        spark.conf.set(merging, "false")
        parts = lying.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(merging, before)
    got = order.row_positions(lying).orderBy("row_index").collect()
    assert [r["row_index"] for r in got] == list(range(3_000))
    keys = [(-1 if r["hilbert"] is None else r["hilbert"], r["feature_id"]) for r in got]
    assert keys == sorted(keys) and len({k for _, k in keys}) == 3_000
    assert {r["code"] for r in got} == {"kept"}
    crowded = next(r["hilbert"] for r in got if r["lon"] == 10.0)
    assert len({r["part"] for r in parts if r["hilbert"] == crowded}) > 1
    with pytest.raises(ValueError, match="choose another name"):
        order.hilbert_order(df, name="code")
    assert order.hilbert_order(df.limit(0)).count() == 0


def test_order_is_one_shuffle_without_python(spark, sf):
    plan = plan_of(order.hilbert_order(gen_points(spark, 1_000, seed=2).select("feature_id", "lon", "lat")))
    assert plan.count(") Exchange") == 1 and "Python" not in plan and "Join" not in plan


def test_places_without_coordinates_are_in_no_cell(spark):
    df = spark.createDataFrame(
        [(1, None, 1.0, 5.0), (2, 1.0, None, 5.0), (3, None, None, 5.0), (4, -180.0, -90.0, 7.0)],
        "feature_id long, lon double, lat double, value double",
    )
    coded = df.select("feature_id", geo.geohash_code("lon", "lat", 4).alias("code"), geo.geohash("lon", "lat", 4).alias("text"))
    assert {r[0]: (r[1], r[2]) for r in coded.collect()} == {1: (None, None), 2: (None, None), 3: (None, None), 4: (0, "0000")}
    rolled = cells.geohash_rollup(df, 4, "value").collect()
    assert [(r["cell"], r["count"], r["mean"]) for r in rolled] == [("0000", 1, 7.0)]
