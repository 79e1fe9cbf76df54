"""Checks of rows, budgets, hover text."""

import pytest
from layerspark.functions import geo
from layerspark.functions.text import display_text
from layerspark.operators import contract, select, shape, size, style
from layerspark.operators.picks import with_tooltip
from layerspark.spec import LayerSpec, geometry_metadata
from pyspark.errors import PySparkException
from pyspark.sql import functions as F


@pytest.fixture
def mixed(spark):
    rows = [(1, 0.0, 0.0), (2, None, None), (3, 1.0, 1.0)]
    return shape.points_from_lonlat(spark.createDataFrame(rows, "feature_id long, lon double, lat double"))


def test_null_geometry_policies(mixed):
    assert contract.null_geometry(mixed, ["geometry"], "keep").count() == 3
    assert contract.null_geometry(mixed, ["geometry"], "drop").count() == 2
    assert contract.null_geometry(mixed, ["geometry"], "report").first().asDict() == {"rows": 3, "null_rows": 1}
    with pytest.raises(ValueError, match="policy"):
        contract.null_geometry(mixed, ["geometry"], "other")


def test_broken_rows_are_counted_and_named(spark):
    df = spark.createDataFrame(
        [
            (1, [0.0, 0.0], [1, 2, 3]),
            (2, [0.0], [1, 2]),
            (3, [200.0, 0.0], [1, 2, 300]),
            (None, [float("nan"), 0.0], [1, 2, 3, 4]),
        ],
        "feature_id long, geometry array<double>, get_fill_color array<smallint>",
    )
    df = df.withColumn("geometry", F.col("geometry").alias("geometry", metadata=geometry_metadata("point")))
    spec = LayerSpec("layer-7", "scatterplot")
    found = contract.check_rows(df, spec).first().asDict()
    assert found == {
        "rows": 4,
        "null_id": 1,
        "geometry_null": 0,
        "geometry_length": 1,
        "geometry_range": 1,
        "geometry_finite": 1,
        "get_fill_color_length": 1,
        "get_fill_color_range": 1,
    }
    with pytest.raises(ValueError, match="layer-7.*geometry_length: 1 rows"):
        contract.assert_rows(df, spec)


def test_polygon_rings_must_close(spark):
    closed = [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]
    rows = [(1, closed), (2, [closed[0][:3]]), (3, None)]
    df = spark.createDataFrame(rows, "feature_id long, geometry array<array<array<double>>>")
    df = df.withColumn("geometry", F.col("geometry").alias("geometry", metadata=geometry_metadata("polygon")))
    assert contract.check_rows(df, LayerSpec("l", "polygon")).first()["geometry_ring"] == 1


def test_non_finite_values(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, float("inf")), (4, None)], "id long, v double")
    assert contract.check_finite(df, ["v"]).first()["v"] == 2
    assert [r["id"] for r in contract.check_finite(df, ["v"], "drop").collect()] == [1, 4]
    with pytest.raises(PySparkException, match="non-finite number"):
        contract.check_finite(df, ["v"], "raise").collect()


def test_budget(spark):
    sizes = spark.createDataFrame([("small", 1_000_000), ("big", 4_000_000)], "layer_id string, bytes long")
    contract.check_budget(sizes, 5)
    with pytest.raises(ValueError, match=r"over budget: 5\.0 MB.*4 MB are allowed.*big with 4\.0 MB, small with 1\.0 MB"):
        contract.check_budget(sizes, 4)


def test_fit_to_budget_is_stable_and_fits(spark):
    df = spark.range(20_000).select(F.col("id").alias("feature_id"), F.rand(1).alias("v"))
    first = select.fit_to_budget(df, 16 * 5_000)
    again = select.fit_to_budget(df.repartition(7), 16 * 5_000)
    kept = {r["feature_id"] for r in first.collect()}
    assert kept == {r["feature_id"] for r in again.collect()}
    assert 4_500 < len(kept) <= 5_000
    assert select.fit_to_budget(df, 10**9).count() == 20_000


def test_viewport(spark, mixed):
    view = size.viewport(mixed).first().asDict()
    assert (view["longitude"], view["latitude"], view["skipped"]) == (0.5, 0.5, 1)
    assert view["zoom"] == pytest.approx(8.4918531)
    with pytest.raises(PySparkException, match="undefined"):
        size.viewport(mixed, strict=True).collect()
    empty = size.viewport(mixed.where("feature_id > 99")).first()
    assert (empty["longitude"], empty["latitude"], empty["zoom"]) == (0.0, 0.0, 0.0)


def test_hover_text(spark):
    df = spark.createDataFrame(
        [(1, "a<b>&\"'", None, 2**53 + 1, 2.0, 1e8, [1, None], ("x", 2**60))],
        "id long, s string, n string, big long, d double, e double, l array<long>, t struct<a:string,b:long>",
    )
    told = with_tooltip(df, ["s", "n", "big", "d", "e", "l", "t"]).first()["tooltip"]
    assert told == (
        "<div>s: a&lt;b&gt;&amp;&quot;&#39;</div><div>n: </div><div>big: 9007199254740993</div>"
        "<div>d: 2</div><div>e: 100000000</div><div>l: [&quot;1&quot;,null]</div>"
        "<div>t: {&quot;a&quot;:&quot;x&quot;,&quot;b&quot;:&quot;1152921504606846976&quot;}</div>"
    )


@pytest.mark.parametrize(
    "value, text",
    [
        (0.1, "0.1"),
        (-0.5, "-0.5"),
        (12345678.25, "12345678.25"),
        (0.00025, "0.00025"),
        (0.000001, "0.000001"),
        (1e15, "1000000000000000"),
        (120.0, "120"),
        (float("nan"), "NaN"),
        (float("-inf"), "-Infinity"),
    ],
)
def test_number_text(spark, value, text):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(display_text(F.col("v"), df.schema["v"].dataType).alias("t")).first()["t"] == text


def test_long_trips_need_a_coarser_unit(spark):
    df = spark.sql("select 1 as id, array(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:01:00') as t")
    with pytest.raises(PySparkException, match="coarser unit"):
        style.trip_times_to_float(df, "t", "us").collect()
    assert style.trip_times_to_float(df, "t", "s").first()["get_timestamps"] == [-16777216.0, -16777156.0]


def test_trip_times_start_at_the_fixed_start(spark):
    df = spark.sql(
        """select * from values
        (1, array(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:10')),
        (2, array(timestamp'2024-01-01 00:00:05', timestamp'2024-01-01 00:00:15')) as v(id, t)"""
    )
    times = [r["get_timestamps"] for r in style.trip_times_to_float(df, "t").orderBy("id").collect()]
    assert times == [[-16777216.0, -6777216.0], [-11777216.0, -1777216.0]]


def test_known_cells(spark):
    df = spark.sql("select 10.40744D as lon, 57.64911D as lat, '8928308280fffff' as h3")
    row = df.select(
        geo.geohash("lon", "lat", 6).alias("gh"),
        geo.h3_to_text(geo.h3_parent(geo.h3_from_text("h3"), 8)).alias("parent"),
        geo.h3_resolution(geo.h3_from_text("h3")).alias("res"),
    ).first()
    assert tuple(row) == ("u4pruy", "8828308281fffff", 9)


def test_box_over_the_antimeridian(spark):
    df = spark.createDataFrame([(1, 179.9, 0.0), (2, -179.9, 0.0), (3, 0.0, 0.0)], "id long, lon double, lat double")
    near = select.brush(df, (180.0, 0.0), 50_000.0)
    assert sorted(r["id"] for r in near.collect()) == [1, 2]
    seen = select.in_view(df, {"longitude": -179.95, "latitude": 0.0, "zoom": 9.0})
    assert sorted(r["id"] for r in seen.collect()) == [1, 2]


def test_coarsened_line_keeps_two_ends(spark):
    df = spark.createDataFrame([(1, [[0.0, 0.0], [0.01, 0.01], [0.02, 0.0]])], "id long, geometry array<array<double>>")
    df = df.withColumn("geometry", F.col("geometry").alias("geometry", metadata=geometry_metadata("linestring")))
    assert select.coarsen(df, "geometry", 1).first()["geometry"] == [[0.0, 0.0], [0.0, 0.0]]
