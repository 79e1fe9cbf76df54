"""Encoded batches read back with pyarrow; bytes do not depend on partitioning."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from layerspark.operators import shape, size
from layerspark.operators.shape import points_from_lonlat
from layerspark.plans.render import write_map
from layerspark.sinks import decode_layer, decode_payload, encode_layer, write_layer_parquet, write_layers_partitioned
from layerspark.sinks.encode import leaf_policy
from layerspark.sources import gen_points, gen_square_grid
from layerspark.spec import LayerSpec, geometry_metadata
from plan_text import plan_of
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def points(spark):
    df = shape.points_from_lonlat(gen_points(spark, 5_000, seed=2))
    df = shape.attach_colors(df, "r", "g", "b", name="get_fill_color")
    return df.select("feature_id", "geometry", "get_fill_color", F.col("radius").alias("get_radius"))


def decoded(encoded):
    rows = encoded.orderBy("batch_id").collect()
    return [decode_payload(bytes(r["payload"]), r["encoding"]) for r in rows]


@pytest.mark.parametrize("encoding", ["ipc", "ipc-zstd", "parquet"])
def test_round_trip(points, encoding):
    tables = decoded(encode_layer(points, "l", encoding, rows_per_batch=2_000))
    assert [t.num_rows for t in tables] == [2_000, 2_000, 1_000]
    for table in tables:
        for batch in table.to_batches():
            batch.validate(full=True)
    whole = pa.concat_tables(tables)
    want = points.orderBy("feature_id").toArrow()
    assert whole.column("feature_id").to_pylist() == want.column("feature_id").to_pylist()
    assert whole.column("geometry").to_pylist() == want.column("geometry").to_pylist()
    assert whole.column("get_fill_color").to_pylist() == want.column("get_fill_color").to_pylist()
    schema = tables[0].schema
    assert schema.field("get_fill_color").type == pa.list_(pa.field("", pa.uint8()), 3)
    assert schema.field("geometry").type.list_size == 2
    assert schema.field("geometry").metadata[b"ARROW:extension:name"] == b"geoarrow.point"


@pytest.mark.parametrize("encoding", ["ipc", "ipc-zstd", "parquet"])
def test_same_bytes_however_partitioned(points, encoding):
    seen = set()
    for parts in (1, 3, 7):
        rows = encode_layer(points.repartition(parts), "l", encoding, 2_000).orderBy("batch_id").collect()
        seen.add(tuple(bytes(r["payload"]) for r in rows))
    assert len(seen) == 1


def test_bytes_per_row(points):
    body = encode_layer(points, "l", "ipc", keep_id=False).first()["byte_length"]
    assert 23 * 5_000 <= body <= 23 * 5_000 + 2_000
    assert size.layer_bytes(points.drop("feature_id")).first()["bytes"] == 23 * 5_000


def test_bytes_of_cell_statistics(spark):
    stats = [F.rand(i).cast("float").alias(f"s{i}") for i in range(6)]
    color = F.array(*[F.lit(1).cast("smallint")] * 3).alias("get_fill_color")
    df = spark.range(1_000).select(F.col("id").cast("decimal(20,0)").alias("get_pentagon"), color, *stats)
    assert size.layer_bytes(df).first()["bytes"] == 35 * 1_000


def test_one_batch_is_one_record_batch_and_one_row_group(points):
    plain = encode_layer(points, "l", "ipc").first()
    assert len(list(pa.ipc.open_stream(bytes(plain["payload"])))) == 1
    body = bytes(encode_layer(points, "l", "parquet").first()["payload"])
    assert pq.ParquetFile(pa.BufferReader(body)).metadata.num_row_groups == 1


def test_null_geometry_is_kept(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, None, None), (3, 1.0, 1.0)], "feature_id long, lon double, lat double")
    layer = shape.points_from_lonlat(df).select("feature_id", "geometry")
    for encoding in ("ipc", "parquet"):
        table = decoded(encode_layer(layer, "l", encoding))[0]
        assert table.column("geometry").to_pylist() == [[0.0, 0.0], None, [1.0, 1.0]]


def test_polygons_in_many_batches_are_valid(spark):
    grid = gen_square_grid(spark, 600).select("feature_id", "geometry")
    for encoding in ("ipc", "ipc-zstd", "parquet"):
        tables = decoded(encode_layer(grid.repartition(5), "l", encoding, rows_per_batch=97))
        assert sum(t.num_rows for t in tables) == 600
        for table in tables:
            for batch in table.to_batches():
                batch.validate(full=True)
        ring = tables[0].column("geometry").to_pylist()[0][0]
        assert len(ring) == 5 and ring[0] == ring[-1]


def test_multipoints_and_heights(spark):
    df = spark.createDataFrame(
        [(1, [[0.0, 0.0], [1.0, 1.0]], [0.0, 0.0, 5.0]), (2, [[2.0, 2.0]], [1.0, 1.0, 6.0])],
        "feature_id long, many array<array<double>>, high array<double>",
    )
    df = df.select(
        "feature_id",
        F.col("many").alias("many", metadata=geometry_metadata("multipoint")),
        F.col("high").alias("high", metadata=geometry_metadata("point")),
    )
    table = decoded(encode_layer(df, "l", "ipc"))[0]
    assert table.column("many").to_pylist() == [[[0.0, 0.0], [1.0, 1.0]], [[2.0, 2.0]]]
    assert table.schema.field("many").metadata[b"ARROW:extension:name"] == b"geoarrow.multipoint"
    assert table.schema.field("high").type == pa.list_(pa.field("xyz", pa.float64()), 3)


def test_wide_ids_go_out_as_uint64(spark):
    df = spark.createDataFrame([(1, "9223372036854775813")], "feature_id long, c string")
    df = df.select("feature_id", F.col("c").cast("decimal(20,0)").alias("get_pentagon"))
    table = decoded(encode_layer(df, "l", "ipc"))[0]
    assert table.schema.field("get_pentagon").type == pa.uint64()
    assert table.column("get_pentagon").to_pylist() == [9223372036854775813]


def test_leaf_policy():
    vertex = pa.list_(pa.field("xy", pa.float64()), 2)
    schema = pa.schema(
        [
            ("point", vertex),
            ("path", pa.list_(vertex)),
            ("color", pa.list_(pa.uint8(), 3)),
            ("value", pa.float32()),
            ("name", pa.string()),
            ("flag", pa.bool_()),
        ]
    )
    split, dictionary = leaf_policy(schema)
    assert split == ["point.list.element", "color.list.element", "value"]
    assert dictionary == ["name", "flag"]


def test_spark_parquet_has_text_dictionaries_only(spark, points, tmp_path):
    path = str(tmp_path / "layer")
    write_layer_parquet(points.withColumn("name", F.lit("x")), path)
    assert spark.read.parquet(path).count() == 5_000
    file = next((tmp_path / "layer").glob("*.parquet"))
    group = pq.ParquetFile(file).metadata.row_group(0)
    for i in range(group.num_columns):
        column = group.column(i)
        has_dictionary = any("DICTIONARY" in e for e in column.encodings)
        assert has_dictionary == (column.path_in_schema == "name"), column.path_in_schema
        assert column.compression == "ZSTD"


def test_layers_share_a_table_with_their_own_encodings(spark, points, tmp_path):
    grid = gen_square_grid(spark, 100).select("feature_id", "geometry")
    path = str(tmp_path / "layers")
    write_layers_partitioned(
        [encode_layer(points, "points", "ipc-zstd"), encode_layer(grid, "grid", "parquet")], path
    )
    stored = spark.read.parquet(path)
    assert {(r["layer_id"], r["encoding"], r["num_rows"]) for r in stored.collect()} == {
        ("points", "ipc-zstd", 5_000),
        ("grid", "parquet", 100),
    }


def test_mixed_lengths_are_refused(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, [1, 2, 3, 4])], "feature_id long, c array<smallint>")
    with pytest.raises(Exception, match="one length"):
        encode_layer(df, "l", "ipc").collect()


def test_batches_are_cut_by_bytes_too(spark):
    """A few very long texts among short ones: no batch outgrows the limit by more than a row."""
    limit = 20_000
    df = spark.range(3_000).select(
        F.col("id").alias("feature_id"),
        F.expr("repeat('x', CASE WHEN id % 500 = 7 THEN 30000 ELSE int(id % 40) END)").alias("name"),
    )
    runs = []
    for pieces in (1, 7):
        rows = encode_layer(df.repartition(pieces), "l", "ipc", 1_000, bytes_per_batch=limit).orderBy("batch_id").collect()
        assert [r["batch_id"] for r in rows] == list(range(len(rows)))
        runs.append([bytes(r["payload"]) for r in rows])
    assert runs[0] == runs[1]
    tables = [decode_payload(p, "ipc") for p in runs[0]]
    assert pa.concat_tables(tables).column("feature_id").to_pylist() == list(range(3_000))
    assert max(t.num_rows for t in tables) <= 1_000
    for table in tables:
        widths = [16 + len(x) for x in table.column("name").to_pylist()]
        assert sum(widths[:-1]) <= limit + 4_000
    assert len(tables) >= 6 * 30_000 // limit


def test_rows_alone_cut_as_before(spark):
    df = spark.range(2_500).select(F.col("id").alias("feature_id"))
    rows = encode_layer(df, "l", "ipc", 1_000).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["num_rows"]) for r in rows] == [(0, 1_000), (1, 1_000), (2, 500)]


def ids_of(batch):
    return decode_payload(bytes(batch.payload), batch.encoding).column("feature_id").to_pylist()


@pytest.mark.parametrize("hot", [False, True])
def test_batches_hold_their_rows_in_order(spark, hot):
    """Every batch has the rows asked for, also where one id holds most rows or is null."""
    ids = [None] * 30 + ([7] * 400 if hot else []) + list(range(500))
    layer = spark.createDataFrame([(k, f"n{i % 5}") for i, k in enumerate(ids)], "feature_id long, name string")
    batches = encode_layer(layer.repartition(9), "l", "ipc", rows_per_batch=64).orderBy("batch_id").collect()
    assert [b.batch_id for b in batches] == list(range(-(-len(ids) // 64)))
    assert {b.num_rows for b in batches[:-1]} == {64}
    found = [k for b in batches for k in ids_of(b)]
    assert found == sorted(ids, key=lambda k: (k is not None, k or 0))


def test_text_ids_and_byte_cut(spark):
    layer = spark.createDataFrame([(f"k{i:04d}", "x" * 90) for i in range(300)], "feature_id string, name string")
    batches = encode_layer(layer, "l", "ipc", bytes_per_batch=5000, rows_per_batch=1000).orderBy("batch_id").collect()
    assert [k for b in batches for k in ids_of(b)] == [f"k{i:04d}" for i in range(300)]
    assert len(batches) > 4 and max(b.num_rows for b in batches) <= 5000 // 90 + 1


def test_wide_rows_move_once(spark, sf):
    from layerspark.plans import fixtures as fx

    plan = plan_of(encode_layer(fx.places(spark, sf), "l", "ipc", rows_per_batch=100))
    assert plan.count(") Exchange") == 1 and "rangepartitioning" not in plan


@pytest.mark.parametrize("encoding", ["ipc", "ipc-zstd", "parquet"])
def test_decoded_rows_equal_the_layer(spark, encoding):
    schema = "feature_id long, name string, parts array<array<double>>, at timestamp, flag boolean"
    rows = [(1, "a", [[1.0, 2.0], [3.0, 4.0]], None, True), (2, None, None, None, None), (3, "", [], None, False)]
    layer = spark.createDataFrame(rows, schema)
    decoded = decode_layer(encode_layer(layer, "l", encoding), layer.schema)
    assert sorted(map(tuple, decoded.collect())) == rows


def test_refused_map_leaves_no_file(spark, tmp_path):
    layer = spark.range(2000).selectExpr("id AS feature_id", "double(id) / 100 AS lon", "double(id) / 200 AS lat")
    spec = LayerSpec("l", "scatterplot")
    layers = [(points_from_lonlat(layer), spec)]
    with pytest.raises(ValueError):
        write_map(spark, layers, str(tmp_path), max_mb=0.001)
    assert not list(tmp_path.rglob("*.parquet"))
    write_map(spark, layers, str(tmp_path))
    kept = sorted(tmp_path.rglob("*.parquet"))
    # The same content again is refused, but its files belong to the earlier version.
    with pytest.raises(ValueError):
        write_map(spark, layers, str(tmp_path), max_mb=0.001)
    assert kept and len(sorted(tmp_path.rglob("layers/**/*.parquet"))) == len([k for k in kept if "/layers/" in str(k)])
