"""What the optimizer makes of the operators."""

from layerspark.operators import cells, select, shape, size, style
from layerspark.operators.picks import resolve_picks
from layerspark.operators.version import diff_rows
from layerspark.plans import fixtures as fx
from layerspark.plans.queries import registry
from layerspark.sources import scan_cell_stats, scan_layer
from layerspark.spec import LayerSpec
from plan_text import plan_of
from pyspark.sql import functions as F


def stored(spark, sf, tmp_path):
    path = str(tmp_path / "places")
    fx.places(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_reach_the_scan(spark, sf, tmp_path):
    df = stored(spark, sf, tmp_path)
    ranged = plan_of(select.range_filter(df, {"value": (1.0, 2.0)}))
    assert "GreaterThanOrEqual(value,1.0)" in ranged and "LessThanOrEqual(value,2.0)" in ranged
    brushed = plan_of(select.brush(df, (-122.4, 37.7), 1000.0))
    assert "GreaterThanOrEqual(lat," in brushed and "GreaterThanOrEqual(lon," in brushed
    viewed = plan_of(select.in_view(df, {"longitude": -122.4, "latitude": 37.7, "zoom": 10.0}))
    assert "GreaterThanOrEqual(lon," in viewed
    kept = plan_of(select.category_filter(df, {"category": ["a", "b"]}))
    assert "In(category, [a,b])" in kept


def test_only_needed_columns_are_read(spark, sf, tmp_path):
    df = shape.points_from_lonlat(stored(spark, sf, tmp_path))
    spec = LayerSpec("l", "scatterplot", accessors={"get_radius": F.col("radius")})
    plan = plan_of(shape.select_layer(df, spec))
    assert "ReadSchema: struct<feature_id:bigint,lon:double,lat:double,radius:float>" in plan
    assert "Exchange" not in plan
    assert "struct<o_orderkey:bigint>" in plan_of(scan_layer(spark, f"{sf}/orders.parquet", ["o_orderkey"]))


def test_other_levels_are_not_read(spark, tmp_path):
    path = str(tmp_path / "stats")
    names = [f"dem_{s}" for s in ("mean", "std", "min", "max", "p10", "p90")]
    df = spark.range(10).select(F.col("id").alias("cell_id"), *[F.lit(1.0).alias(n) for n in names])
    df.withColumn("level", F.lit("L07")).unionByName(df.withColumn("level", F.lit("L08"))).write.partitionBy("level").parquet(path)
    scan = scan_cell_stats(spark, path, "L08")
    assert scan.count() == 10
    assert "PartitionFilters: [isnotnull(level" in plan_of(scan)


def test_colour_bounds_come_without_a_join(spark, sf):
    plan = plan_of(style.color_ramp(fx.places(spark, sf), "value"))
    assert "Join" not in plan and "Subquery" in plan


def test_declutter_prunes_before_the_shuffle(spark, sf):
    plan = plan_of(select.declutter(fx.places(spark, sf), 0.01, "value"))
    assert plan.count("WindowGroupLimit") >= 2


def test_row_diff_is_one_shuffle_without_a_join(spark, sf):
    diff = diff_rows(fx.places(spark, sf), fx.places_moved(spark, sf), geometry=["lon", "lat"], accessors=["value"])
    plan = plan_of(diff)
    assert "Join" not in plan
    assert plan.count(") Exchange") == 1


def test_small_side_is_broadcast_only_when_counted_small(spark, sf):
    picked, offsets = fx.interactions(spark, sf), fx.sub_layers(spark, sf)
    assert "BroadcastHashJoin" in plan_of(resolve_picks(picked, offsets))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_of(resolve_picks(picked, offsets, broadcast_rows=2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_aggregates_combine_before_the_shuffle(spark, sf):
    plan = plan_of(size.layer_bytes(shape.points_from_lonlat(fx.places(spark, sf))))
    assert "partial_sum" in plan
    rolled = plan_of(cells.cell_rollup(fx.part_stats(spark, sf), "cell_id", "quantity", percentiles=False))
    assert "partial_avg" in rolled and "HashAggregate" in rolled


def test_no_query_needs_a_cross_join(spark, sf):
    for name, query in registry().items():
        plan = plan_of(query(spark, sf))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_scratch_table_can_be_discarded(spark):
    from pathlib import Path

    from layerspark.session import discard, materialize

    table = materialize(spark.range(3).toDF("id"), "discarded")
    assert table.count() == 3
    discard(table)
    assert not Path(table._scratch_path).exists()
