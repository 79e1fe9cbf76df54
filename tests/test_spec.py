"""Layer contract, props and hover columns."""

import pytest
from layerspark.operators import shape
from layerspark.operators.size import choose_encoding, requested_encoding
from layerspark.operators.version import props_fingerprint
from layerspark.sinks.manifest import manifest_row
from layerspark.spec import Extension, LayerSpec, MapSpec, check_layer, geometry_columns, prop_name, to_json
from pyspark.sql import functions as F


@pytest.fixture
def points(spark):
    rows = [(1, -122.4, 37.7, 5, "a"), (2, -122.5, 37.8, 6, "b"), (3, -122.3, 37.6, 7, "c")]
    df = spark.createDataFrame(rows, "feature_id long, lon double, lat double, attribute int, name string")
    return shape.points_from_lonlat(df)


def test_geometry_comes_first_and_attributes_are_dropped(points):
    spec = LayerSpec(
        "layer-0", "scatterplot", accessors={"get_radius": F.col("attribute"), "get_fill_color": [255, 0, 0]}
    )
    assert shape.select_layer(points, spec).columns == ["feature_id", "geometry", "get_radius"]


def test_custom_target_stays_behind_the_geometry(points):
    spec = LayerSpec("layer-0", "scatterplot", accessors={"get_brushing_target": F.col("geometry")})
    assert shape.select_layer(points, spec).columns[:2] == ["feature_id", "geometry"]


def test_props_split_constants_columns_and_unset(spark):
    spec = LayerSpec(
        "layer-0",
        "path",
        accessors={"get_color": [1, 2, 3], "get_width": F.col("w"), "get_dash_array": None},
        props={"width_units": "meters", "_current_time": 0.0},
    )
    assert spec.wire_props() == {
        "getColor": [1, 2, 3],
        "getWidth": {"@@arrowColumn": "get_width"},
        "widthUnits": "meters",
        "currentTime": 0.0,
    }
    assert prop_name("get_s2_token") == "getS2Token"


def test_extensions_leave_out_unset_settings():
    spec = LayerSpec(
        "layer-0",
        "path",
        extensions=(Extension("path-style", {"dash": True, "high_precision_dash": False, "offset": None}),),
    )
    assert spec.wire_extensions() == [
        {"type": "path-style", "props": {"dash": True, "highPrecisionDash": False}}
    ]


@pytest.mark.parametrize(
    "spec, message",
    [
        (LayerSpec("layer-3", "bitmap"), "layer-3.*'bitmap' is not supported"),
        (LayerSpec("l", "scatterplot", extensions=(Extension("clip"),)), "'clip' is not supported"),
        (LayerSpec("l", "s2", accessors={"get_s2_token": "89c25c"}), "one value per row"),
        (LayerSpec("l", "arc", accessors={"get_source_position": [0.0, 0.0]}), "get_source_position"),
        (LayerSpec("l", "scatterplot", compression="brotli"), "no encoding.*brotli"),
        (LayerSpec("l", "scatterplot", id_col="nope"), "id column"),
        (LayerSpec("l", "scatterplot", props={"opacity": float("nan")}), "NaN or infinite"),
    ],
)
def test_refused_layers(points, spec, message):
    with pytest.raises(ValueError, match=message):
        check_layer(points.schema, spec)


def test_geometry_layer_without_geometry_is_refused(points):
    with pytest.raises(ValueError, match="no geometry column"):
        check_layer(points.drop("geometry").schema, LayerSpec("l", "path"))


def test_cell_layer_needs_no_geometry_column(points):
    bare = points.drop("geometry")
    spec = LayerSpec("l", "geohash", accessors={"get_geohash": F.col("name")})
    layer = shape.select_layer(bare, spec)
    assert layer.columns == ["feature_id", "get_geohash"]
    assert geometry_columns(layer.schema, "geohash") == ["get_geohash"]


def test_tooltip_requests():
    available = ["b", "geometry", "a", "get_fill_color", "feature_id"]
    used = ["feature_id", "geometry", "get_fill_color"]
    assert shape.tooltip_columns(available, False, used) == []
    assert shape.tooltip_columns(available, True, used) == ["a", "b"]
    assert shape.tooltip_columns(available, ("b", "missing", "a", "b", "geometry"), used) == ["b", "a"]


def test_colliding_attribute_gives_way_to_the_accessor(points):
    df = points.withColumn("get_fill_color", F.lit("attribute"))
    color = F.array(*[F.lit(i).cast("smallint") for i in (255, 0, 0)])
    spec = LayerSpec("l", "scatterplot", accessors={"get_fill_color": color}, tooltip=True)
    layer = shape.select_layer(df, spec)
    assert layer.columns.count("get_fill_color") == 1
    assert layer.first()["get_fill_color"] == [255, 0, 0]


@pytest.mark.parametrize(
    "size, encoding",
    [(0, "ipc"), (999_999, "ipc"), (1_000_000, "ipc-zstd"), (19_999_999, "ipc-zstd"), (20_000_000, "parquet")],
)
def test_encoding_edges(spark, size, encoding):
    sizes = spark.createDataFrame([("l", size)], "layer_id string, bytes long")
    assert choose_encoding(sizes).first()["encoding"] == encoding
    assert choose_encoding(sizes, "parquet").first()["encoding"] == "parquet"


def test_compression_names():
    assert [requested_encoding(c) for c in (None, "zstd", "parquet", "auto")] == ["ipc", "ipc-zstd", "parquet", "auto"]
    with pytest.raises(ValueError, match="no encoding"):
        requested_encoding("lz4")


def test_json_refuses_what_it_cannot_hold():
    with pytest.raises(ValueError, match=r"view\.longitude is NaN or infinite"):
        to_json({"longitude": float("inf")}, "view")
    with pytest.raises(ValueError, match="cannot be written as JSON"):
        to_json({"a": object()}, "parameters")


def test_manifest_leaves_out_what_is_empty():
    spec = LayerSpec("layer-0", "scatterplot", props={"opacity": 1})
    row = manifest_row(spec, 0, "ipc", [], {}, MapSpec())
    assert row["extensions"] is None and row["tooltip"] is None and row["body_encoding"] is None
    assert manifest_row(spec, 0, "parquet", ["a"], {})["body_encoding"] == "parquet"


def test_props_fingerprint_sees_type_and_props():
    base = LayerSpec("l", "scatterplot", props={"opacity": 1})
    assert props_fingerprint(base) == props_fingerprint(LayerSpec("other", "scatterplot", props={"opacity": 1}))
    assert props_fingerprint(base) != props_fingerprint(base.with_props(opacity=0.5))
    assert props_fingerprint(base) != props_fingerprint(LayerSpec("l", "column", props={"opacity": 1}))
