"""Writing a map, and writing only what changed."""

import json

import pytest
from layerspark.operators import shape, style
from layerspark.plans.render import manifest_of, prepare_layer, write_map
from layerspark.operators.version import column_fingerprints, diff_layers, diff_rows, geometry_fingerprint
from layerspark.sinks import decode_payload
from layerspark.sources import gen_points, gen_square_grid
from layerspark.spec import Extension, LayerSpec, MapSpec
from pyspark.sql import functions as F


@pytest.fixture
def points(spark):
    df = shape.points_from_lonlat(gen_points(spark, 1_000, seed=4))
    return shape.attach_colors(df, "r", "g", "b", name="color")


SPEC = {"accessors": None, "extensions": (Extension("data-filter", {"filter_size": 1}),), "tooltip": ("radius",)}


def spec(**kw):
    accessors = {"get_fill_color": F.col("color"), "get_radius": F.col("radius")}
    return LayerSpec("dots", "scatterplot", **{**SPEC, "accessors": accessors, **kw})


def stored(spark, path):
    rows = spark.read.parquet(path).collect()
    return {n for r in rows for n in decode_payload(bytes(r["payload"]), r["encoding"]).schema.names}


def write(spark, df, layer, path, previous=None, **kw):
    manifest = write_map(spark, [(df, layer)], path, MapSpec({"longitude": 0.0}), previous, **kw)
    # Kept apart from the files, as the next version overwrites the manifest.
    return spark.createDataFrame(manifest.collect(), manifest.schema)


def test_only_what_changed_is_written(spark, points, tmp_path):
    path = str(tmp_path / "map")
    first = write(spark, points, spec(), path)
    base = first.first()
    assert stored(spark, base["data_path"]) == {"feature_id", "geometry", "get_fill_color", "get_radius", "radius"}
    assert json.loads(base["extensions"]) == [{"type": "data-filter", "props": {"filterSize": 1}}]
    assert json.loads(base["tooltip"]) == ["radius"]

    same = write(spark, points.repartition(5), spec(), path, first).first()
    assert same["data_path"] == base["data_path"] and same["patch_path"] is None

    restyled = write(spark, points, spec(props={"opacity": 0.5}), path, first).first()
    assert restyled["data_path"] == base["data_path"]
    assert json.loads(restyled["props"])["opacity"] == 0.5

    red = style.recolor(points, "color", 9, 0)
    second = write(spark, red, spec(), path, first)
    patch = second.first()
    assert patch["data_path"] == base["data_path"]
    assert patch["patch_columns"] == ["get_fill_color"]
    assert stored(spark, patch["patch_path"]) == {"feature_id", "get_fill_color"}

    # A second patch covers the first one's columns too.
    wide = red.withColumn("radius", F.col("radius") + 1)
    third = write(spark, wide, spec(tooltip=False), path, second).first()
    assert third["data_path"] == base["data_path"]
    assert set(third["patch_columns"]) >= {"get_fill_color", "get_radius"}

    moved = shape.points_from_lonlat(points.withColumn("lon", F.col("lon") + 0.5))
    fresh = write(spark, moved, spec(), path, first).first()
    assert fresh["data_path"] != base["data_path"] and fresh["patch_path"] is None


def test_budget_refuses_the_map_before_its_manifest(spark, points, tmp_path):
    with pytest.raises(ValueError, match="over budget.*dots"):
        write(spark, points, spec(), str(tmp_path / "m"), max_mb=0.01)
    assert not (tmp_path / "m" / "manifest").exists()


def test_broken_rows_are_refused(spark, points, tmp_path):
    bad = shape.points_from_lonlat(points.withColumn("lon", F.lit(999.0)))
    with pytest.raises(ValueError, match="geometry_range: 1000 rows"):
        write(spark, bad, spec(), str(tmp_path / "m"))


def test_layer_ids_must_differ(spark, points, tmp_path):
    with pytest.raises(ValueError, match="must differ"):
        write_map(spark, [(points, spec()), (points, spec())], str(tmp_path / "m"))


def test_view_state_must_be_finite(spark, points, tmp_path):
    with pytest.raises(ValueError, match="NaN or infinite.*by hand"):
        write_map(spark, [(points, spec())], str(tmp_path / "m"), MapSpec({"longitude": float("nan")}))


def test_fingerprints_ignore_order_and_see_every_change(spark, points):
    def prints(df):
        return {r["column"]: r["fingerprint"] for r in column_fingerprints(df).collect()}

    base = prints(points.select("feature_id", "geometry", "color", "radius"))
    assert base == prints(points.select("feature_id", "geometry", "color", "radius").repartition(7).orderBy("radius"))
    one = F.when(F.col("feature_id") == 500, F.col("radius") + 1).otherwise(F.col("radius"))
    changed = prints(points.withColumn("radius", one).select("feature_id", "geometry", "color", "radius"))
    assert {k for k in base if base[k] != changed[k]} == {"radius"}
    # Values swapped between rows are a change too.
    swapped = points.withColumn("feature_id", F.lit(999) - F.col("feature_id"))
    assert prints(swapped.select("feature_id", "radius"))["radius"] != base["radius"]


@pytest.mark.parametrize(
    "a, b",
    [
        ("array(null, 1D)", "array(1D, null)"),
        ("cast(null as array<double>)", "array()"),
        ("array(array(1D), array(2D))", "array(array(1D, 2D))"),
        ("cast(null as double)", "0D"),
        ("''", "cast(null as string)"),
    ],
)
def test_fingerprints_tell_missing_values_apart(spark, a, b):
    def one(text):
        return column_fingerprints(spark.sql(f"select 1L as feature_id, {text} as v")).where("column = 'v'").first()[1]

    assert one(a) != one(b)


def test_geometry_fingerprint_needs_geometry(spark, points):
    bare = points.select("feature_id", "radius")
    assert geometry_fingerprint(bare, LayerSpec("l", "scatterplot")).first()["geometry_fp"] is None
    assert geometry_fingerprint(points, spec()).first()["geometry_fp"].startswith("geometry:")


def test_verdict_on_moved_layers(spark, points):
    prev, curr = manifest_of(points, spec(), 0), manifest_of(points, spec(), 3)
    row = diff_layers(prev, curr).first()
    assert (row["verdict"], row["moved"]) == ("unchanged", True)


def test_trip_times_are_prepared(spark):
    df = spark.sql(
        """select 1L as feature_id, array(array(0D,0D), array(1D,1D)) as g,
        array(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:10') as ts"""
    )
    df = df.withColumn("geometry", F.col("g").alias("geometry", metadata={"ARROW:extension:name": "geoarrow.linestring"}))
    layer = prepare_layer(df, LayerSpec("t", "trip", accessors={"get_timestamps": F.col("ts")}))
    assert layer.first()["get_timestamps"] == [-16777216.0, -6777216.0]


def test_view_is_derived_from_the_shapes(spark, points, tmp_path):
    row = write_map(spark, [(points, spec())], str(tmp_path / "m")).first()
    view = json.loads(row["view_state"])
    assert view["longitude"] == pytest.approx(-122.45, abs=0.01)
    assert view["zoom"] == pytest.approx(10.23, abs=0.02)
    grid = gen_square_grid(spark, 50)
    row = write_map(spark, [(grid, LayerSpec("g", "polygon"))], str(tmp_path / "g")).first()
    assert json.loads(row["view_state"])["latitude"] == pytest.approx(37.8, abs=0.05)


def test_cell_layers_have_no_view_of_their_own(spark, points, tmp_path):
    cells = LayerSpec("c", "geohash", accessors={"get_geohash": F.lit("u4pruy")})
    with pytest.warns(UserWarning, match="pass a view state"):
        row = write_map(spark, [(points, cells)], str(tmp_path / "m")).first()
    assert json.loads(row["view_state"])["zoom"] == 0.0


@pytest.mark.parametrize("most", [5, 1_000])
def test_parts_of_long_paths_are_features_of_their_own(spark, tmp_path, most):
    rows = [(i % 3, i, float(i % 170), float(i % 80)) for i in range(60)]
    df = spark.createDataFrame(rows, "path long, t long, lon double, lat double")
    paths = shape.path_from_vertices(df, "path", ["t"], max_vertices=most)
    layer = LayerSpec("roads", "path", id_col="part_id", tooltip=("path", "part"))
    first = write(spark, paths, layer, str(tmp_path / "map"))
    found = {}
    for r in spark.read.parquet(first.first()["data_path"]).collect():
        for one in decode_payload(bytes(r["payload"]), r["encoding"]).to_pylist():
            assert one["part_id"] == f"{one['path']}/{one['part']}" and one["part_id"] not in found
            found[one["part_id"]] = one["geometry"]
    for path in range(3):
        parts = [found[k] for k in sorted((k for k in found if k.startswith(f"{path}/")), key=lambda k: int(k[2:]))]
        joined = parts[0] + [v for p in parts[1:] for v in p[1:]]
        assert joined == [[lon, lat] for p, _, lon, lat in rows if p == path]
    changed = diff_rows(paths, paths, "part_id")
    assert changed.filter("verdict = 'duplicate_id'").count() == 0
