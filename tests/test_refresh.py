"""What a refresh, a contract and a pick must not miss."""

import pytest
from pyspark.sql import functions as F

from layerspark.operators import contract, picks, shape, style, version
from layerspark.plans.render import write_map
from layerspark.sources import gen_points, scatter_points
from layerspark.spec import LayerSpec, MapSpec, geometry_metadata, prop_name

VIEW = MapSpec({"longitude": 0.0, "latitude": 0.0, "zoom": 1.0})


def prints(df):
    return {r.column: r.fingerprint for r in version.column_fingerprints(df).collect()}


@pytest.mark.parametrize(
    "kind,before,after",
    [
        ("struct<a:int,b:int>", "named_struct('a', null, 'b', 5)", "named_struct('a', 5, 'b', null)"),
        ("struct<a:struct<x:int>,b:int>", "named_struct('a', named_struct('x', 1), 'b', null)", "named_struct('a', null, 'b', 1)"),
        ("map<string,int>", "map('x', 1, 'y', null)", "map('y', 1, 'x', null)"),
        ("array<array<int>>", "array(array(1, 2), array(3))", "array(array(1), array(2, 3))"),
        ("array<array<int>>", "array(array(1, null), array(3))", "array(array(1), array(null, 3))"),
        ("array<struct<a:int,b:int>>", "array(named_struct('a', 1, 'b', null))", "array(named_struct('a', null, 'b', 1))"),
        ("array<int>", "array(null, 1)", "array(1, null)"),
        ("array<int>", "array()", "null"),
    ],
)
def test_fingerprints_see_moved_nulls(spark, kind, before, after):
    one = spark.sql(f"select 1L as feature_id, cast({before} as {kind}) as v")
    two = spark.sql(f"select 1L as feature_id, cast({after} as {kind}) as v")
    assert prints(one)["v"] != prints(two)["v"] and prints(one) == prints(one.repartition(3))


def test_map_order_does_not_count(spark):
    one = spark.sql("select 1L as feature_id, map('x', 1, 'y', 2) as v")
    assert prints(one) == prints(spark.sql("select 1L as feature_id, map('y', 2, 'x', 1) as v"))


def points(spark, n=50):
    return shape.points_from_lonlat(gen_points(spark, n)).select("feature_id", "geometry", "radius", "lon")


def test_refresh_rewrites_another_encoding(spark, tmp_path):
    layer = points(spark)
    plain = LayerSpec("p", "scatterplot", accessors={"get_radius": F.col("radius")}, compression=None)
    packed = LayerSpec("p", "scatterplot", accessors={"get_radius": F.col("radius")}, compression="parquet")
    first = write_map(spark, [(layer, plain)], f"{tmp_path}/m", VIEW)
    assert version.diff_layers(first, first).first().verdict == "unchanged"
    second = write_map(spark, [(layer, packed)], f"{tmp_path}/m", VIEW, previous=first)
    assert version.diff_layers(first, second).first().verdict == "encoding_changed"
    row = second.first()
    assert row.body_encoding == "parquet" and row.data_path != first.first().data_path
    assert {r.encoding for r in spark.read.parquet(row.data_path).collect()} == {"parquet"}


def test_refresh_sees_a_struct(spark, tmp_path):
    spec = LayerSpec("p", "scatterplot", tooltip=("info",))
    layer = points(spark, 3)
    made = [layer.withColumn("info", F.expr(f"named_struct({x})")) for x in ("'a', int(null), 'b', 5", "'a', 5, 'b', int(null)")]
    first = write_map(spark, [(made[0], spec)], f"{tmp_path}/m", VIEW)
    second = write_map(spark, [(made[1], spec)], f"{tmp_path}/m", VIEW, previous=first)
    assert version.diff_layers(first, second).first().changed_columns == ["info"]


def test_budget_counts_encoded_bytes(spark, tmp_path):
    layer = points(spark, 2000).withColumn("name", F.lit("the same words for every place " * 20))
    spec = LayerSpec("p", "scatterplot", tooltip=("name",), compression="parquet")
    row = write_map(spark, [(layer, spec)], f"{tmp_path}/a", VIEW, max_mb=0.5).first()
    assert row.bytes > 500_000 > row.byte_length
    with pytest.raises(ValueError, match="over budget"):
        write_map(spark, [(layer, spec)], f"{tmp_path}/b", VIEW, max_mb=row.byte_length / 2e6)


def areas(spark, sql, kind):
    column = F.col("geometry").alias("geometry", metadata=geometry_metadata(kind))
    return spark.sql(f"select 1L as feature_id, {sql} as geometry").withColumn("geometry", column)


RING = "array(array(0D, 0D), array(1D, 0D), array({x}, {y}), array(0D, 0D))"


@pytest.mark.parametrize("kind,wrap", [("polygon", "array({})"), ("multipolygon", "array(array({}))")])
def test_every_vertex_of_an_area_is_checked(spark, kind, wrap):
    spec = LayerSpec("a", "polygon" if kind == "polygon" else "polygon")
    good = areas(spark, wrap.format(RING.format(x="1D", y="1D")), kind)
    bad = areas(spark, wrap.format(RING.format(x="double('NaN')", y="999D")), kind)
    open_ring = areas(spark, wrap.format("array(array(0D, 0D), array(1D, 0D), array(1D, 1D), array(0D, 1D))"), kind)
    broken = lambda df: {k for k, v in contract.check_rows(df, spec).first().asDict().items() if v and k != "rows"}
    assert broken(good) == set()
    assert "geometry_finite" in broken(bad)
    assert broken(open_ring) == {"geometry_ring"}


def test_multi_lines_need_no_ring_and_hover_may_be_nan(spark):
    line = areas(spark, "array(array(array(0D, 0D), array(1D, 1D)), array(array(2D, 2D), array(3D, 3D)))", "multilinestring")
    spec = LayerSpec("l", "path", tooltip=("value",))
    found = contract.check_rows(line.withColumn("value", F.lit(float("nan"))), spec).first().asDict()
    assert not any(v for k, v in found.items() if k != "rows")
    short = areas(spark, "array(array(array(0D, 0D)))", "multilinestring")
    assert contract.check_rows(short, spec).first().geometry_length == 1


def test_an_empty_pick_stays(spark):
    sub = spark.createDataFrame([("s", "layer", 10)], "sub_layer_id string, layer_id string, row_offset long")
    found = spark.createDataFrame([(1, "s", 2), (2, None, None)], "event_id long, sub_layer_id string, batch_index long")
    got = {r.event_id: (r.layer_id, r.row_index, r.no_index, r.known_layer) for r in picks.resolve_picks(found, sub).collect()}
    assert got == {1: ("layer", 12, False, True), 2: (None, None, False, False)}


def test_generated_places_are_scattered(spark):
    rows = scatter_points(spark.range(2000).withColumnRenamed("id", "i"), "i", seed=1).orderBy("i").collect()
    steps = {round(b.lon - a.lon, 9) for a, b in zip(rows, rows[1:])}
    assert len(steps) > 1900
    mean = sum(r.lon for r in rows) / len(rows)
    assert abs(mean - (-122.45)) < 0.01


def test_finest_unit_that_fits(spark):
    for span, unit in ((10, "us"), (60, "ms"), (10 * 86400, "s")):
        times = spark.sql(f"select array(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:00' + interval {span} seconds) as t")
        assert style.finest_unit(times, "t") == unit
        got = style.trip_times_to_float(times, "t").first().get_timestamps
        assert got[1] - got[0] == span * {"us": 1_000_000, "ms": 1000, "s": 1}[unit]


def test_prop_names():
    assert prop_name("get_fill_color") == "getFillColor"
    assert prop_name("line_width_2d") == "lineWidth2d"
    assert prop_name("_internal_name") == "InternalName"
    assert prop_name("plain") == "plain"


def trips(spark, seconds):
    return spark.sql(
        f"select 1L as feature_id, array(array(0D, 0D), array(1D, 1D)) as geometry, "
        f"array(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:00' + interval {seconds} seconds) as at"
    )


def test_a_refresh_keeps_the_unit_of_trip_times(spark, tmp_path):
    spec = LayerSpec("t", "trip", accessors={"get_timestamps": F.col("at")})

    def write(seconds, previous=None, **kw):
        path = shape_paths(trips(spark, seconds))
        return write_map(spark, [(path, spec)], str(tmp_path), VIEW, previous=previous, **kw)

    first = write(60)
    assert first.first().time_unit == "ms"
    # A shorter span would allow microseconds, a longer one needs seconds.
    second = write(10, first)
    assert second.first().time_unit == "ms"
    assert write(10).first().time_unit == "us"
    assert write(10 * 86400, second).first().time_unit == "s"
    assert write(10, time_unit="s").first().time_unit == "s"


def shape_paths(df):
    return df.withColumn("geometry", F.col("geometry").alias("geometry", metadata=geometry_metadata("linestring")))
