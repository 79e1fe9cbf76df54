"""Layer tables derived from the star-schema tables.

Every value is an expression on a table's own columns, so these tables grow
with the data and another engine computes the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerspark.operators.order import row_index, row_offsets
from layerspark.session import scratch_path
from layerspark.sinks.rows import StoredRows, write_rows
from layerspark.sources.generate import GRID_FILL, GRID_SPAN

WEST, SOUTH, SIZE = -122.6, 37.6, 0.3
GRID_SIDE = 64


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def utc(column: str) -> Column:
    """Instant of a time without zone, read as UTC whatever zone the session has."""
    epoch = "timestamp_ntz'1970-01-01 00:00:00'"
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, {epoch}, {column})"))


def spread(key: Column, factor: int, modulus: int, start: float) -> Column:
    rest = F.pmod(key.cast("long") * F.lit(factor).cast("long"), F.lit(modulus).cast("long"))
    return F.lit(start) + F.lit(SIZE) * rest.cast("double") / F.lit(float(modulus))


def lon_of(key: Column, factor: int = 7919) -> Column:
    return spread(key, factor, 10007, WEST)


def lat_of(key: Column, factor: int = 6271) -> Column:
    return spread(key, factor, 10009, SOUTH)


def places(spark: SparkSession, sf: str) -> DataFrame:
    """One place per order."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        key.alias("feature_id"),
        lon_of(key).alias("lon"),
        lat_of(key).alias("lat"),
        (F.lit(20) + F.pmod(key, F.lit(180).cast("long"))).cast("float").alias("radius"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderstatus").alias("name"),
    )


def places_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Places, some without a position and some whose value is NaN."""
    df, key = places(spark, sf), F.col("feature_id")
    return df.withColumns(
        {
            "lon": F.when(key % 97 != 0, F.col("lon")),
            "lat": F.when(key % 97 != 0, F.col("lat")),
            "value": F.when(key % 89 == 0, F.lit(float("nan"))).otherwise(F.col("value")),
        }
    )


def places_recolour(spark: SparkSession, sf: str) -> DataFrame:
    return places(spark, sf).withColumn("value", F.col("value") * F.lit(1.1))


def places_moved(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.col("feature_id") % 50 == 0, F.col("lon") + F.lit(0.001)).otherwise(F.col("lon"))
    return places(spark, sf).withColumn("lon", moved)


def colours(df: DataFrame, key: str = "feature_id") -> DataFrame:
    """Channel columns from a key."""
    k = F.col(key).cast("long")
    channel = lambda f: F.pmod(k * F.lit(f).cast("long"), F.lit(256).cast("long")).cast("smallint")
    return df.withColumns({"r": channel(31), "g": channel(57), "b": channel(91)})


def grid(spark: SparkSession, sf: str) -> DataFrame:
    """South-west corners of grid squares, one per part."""
    step = GRID_SPAN / GRID_SIDE
    i = F.col("p_partkey") % GRID_SIDE
    j = F.floor(F.col("p_partkey") / F.lit(GRID_SIDE)).cast("long")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("cell_id"),
        (F.lit(WEST) + i * F.lit(step)).alias("west"),
        (F.lit(SOUTH) + j * F.lit(step)).alias("south"),
        F.lit(GRID_FILL * step).alias("side"),
    )


def part_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Line item quantities per part, as input of a cell roll-up."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("cell_id"), F.col("l_quantity").alias("quantity")
    )


def trip_vertices(spark: SparkSession, sf: str) -> DataFrame:
    """One vertex per event; a user's events form a path."""
    key = F.col("event_id")
    return table(spark, sf, "events").select(
        "user_id",
        "event_id",
        utc("ts").alias("ts"),
        lon_of(key).alias("lon"),
        lat_of(key).alias("lat"),
    )


def arc_ends(spark: SparkSession, sf: str) -> DataFrame:
    """One arc per line item, from the order's place to the supplier's."""
    order, supplier = F.col("l_orderkey"), F.col("l_suppkey")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        lon_of(order).alias("src_lon"),
        lat_of(order).alias("src_lat"),
        lon_of(supplier, 5557).alias("dst_lon"),
        lat_of(supplier, 4241).alias("dst_lat"),
    )


def h3_cells(spark: SparkSession, sf: str) -> DataFrame:
    """H3 cells of resolution 9 from part keys, as text."""
    key = F.col("p_partkey")
    base = int("8928308280fffff", 16) & ~(0b111111111 << 18)
    digit = lambda div, bits: F.shiftleft(F.pmod(F.floor(key / F.lit(div)), F.lit(7).cast("long")), bits)
    cell = F.lit(base).bitwiseOR(digit(1, 24)).bitwiseOR(digit(7, 21)).bitwiseOR(digit(49, 18))
    return table(spark, sf, "part").select(
        key.alias("feature_id"), F.lower(F.hex(cell)).alias("cell"), F.col("p_retailprice").alias("value")
    )


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    return as_interactions(table(spark, sf, "events"))


def as_interactions(events: DataFrame) -> DataFrame:
    """Events as clicks, hovers and view reports; works on a table and on a stream."""
    key = F.col("event_id")
    text = lambda n: (key % n).cast("string")
    return events.select(
        "event_id",
        utc("ts").alias("ts"),
        F.col("user_id").alias("session"),
        F.when(key % 3 == 0, "clicked").when(key % 3 == 1, "hovered").otherwise("view_state").alias("kind"),
        F.concat(F.lit("layer-"), text(3), F.lit("-"), text(4)).alias("sub_layer_id"),
        F.when(key % 41 != 0, (key % 100).cast("long")).alias("batch_index"),
        lon_of(key, 5557).alias("lon"),
        lat_of(key, 4241).alias("lat"),
        F.struct(
            lon_of(key).alias("longitude"),
            lat_of(key).alias("latitude"),
            (key % 20).cast("double").alias("zoom"),
            F.lit(0.0).alias("pitch"),
            (key % 360).cast("double").alias("bearing"),
        ).alias("view_state"),
    )


def layer_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Places dealt out to three layers of three batches each."""
    key = F.col("feature_id")
    return places(spark, sf).select(
        F.concat(F.lit("layer-"), (key % 3).cast("string")).alias("layer_id"),
        (F.floor(key / F.lit(3)) % 3).cast("long").alias("batch_id"),
        "feature_id",
        "name",
        "category",
        "value",
    )


def sub_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of ``layer_parts`` with their row offsets."""
    counts = (
        layer_parts(spark, sf).groupBy("layer_id", "batch_id").agg(F.count(F.lit(1)).alias("num_rows"))
    )
    return row_offsets(counts).withColumn(
        "sub_layer_id", F.concat_ws("-", "layer_id", F.col("batch_id").cast("string"))
    )


def indexed_layer(spark: SparkSession, sf: str) -> DataFrame:
    """``layer_parts`` with the row index inside each layer."""
    return row_index(
        layer_parts(spark, sf), ["layer_id", "batch_id", "feature_id"], name="layer", within=["layer_id"]
    )


_stored: dict[tuple[str, str], StoredRows] = {}


def stored_layer(spark: SparkSession, sf: str) -> StoredRows:
    """``layer_parts`` with a stored row index, as a written map has it; once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        order = ["layer_id", "batch_id", "feature_id"]
        _stored[key] = write_rows(layer_parts(spark, sf), scratch_path(spark, "layer_rows"), order)
    return _stored[key]


def wire_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Line items standing in for encoding runs."""
    return table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("n"),
        F.col("l_returnflag").alias("mode"),
        F.col("l_quantity").alias("encode_ms"),
        F.col("l_extendedprice").alias("wire_bytes"),
    )
