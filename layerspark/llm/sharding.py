"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows lie in input partitions of known sizes; every shard shall get a fixed number
of rows. How many rows each partition sends to each shard is drawn first, from the
multivariate hypergeometric law that a uniform permutation of all rows implies.
Each partition then permutes its own rows and deals them out by its row of the
matrix, rows are exchanged, and each shard permutes what it got. All permutations
are equally likely, yet no count has to be corrected afterwards.

Counts have no upper limit: each is drawn by inversion of its hypergeometric law, whose
probabilities come from ratios of neighbouring values, outwards from the most likely one.

The matrix has one row per partition and one column per shard. Partitions are
counted in one aggregate; what reaches the driver is one count per partition.

The permutation of a shard is done in slices of its hash order, so that a large
shard is not one task: a slice's first slot is the number of rows in earlier slices.

Defined results: null texts have size 1 and the checksum of no bytes. Repeated rows
and null keys are rows like any other, told apart by a number written beside them.
Columns beside key and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerspark.llm.common import text_or_empty
from layerspark.session import materialize

SHARDS = 8
SEED = 11
SLICE_ROWS = 20_000
REACH = 12


def even_sizes(rows: int, shards: int) -> np.ndarray:
    """Shard sizes that differ by one at most."""
    return np.array([rows // shards + (i < rows % shards) for i in range(shards)], dtype=np.int64)


def hypergeometric(chosen: int, others: int, drawn: int, draw: np.random.Generator) -> int:
    """How many of ``drawn`` rows, out of both kinds without replacement, are chosen ones.

    Sums reach ``REACH`` standard deviations (and as many values) to both sides of the
    most likely value; what lies beyond is below the spacing of doubles.
    """
    low, high = max(0, drawn - others), min(chosen, drawn)
    if low == high:
        return low
    rows = chosen + others
    mode = min(high, max(low, (drawn + 1) * (chosen + 1) // (rows + 2)))
    spread = math.sqrt(drawn / rows * chosen * (others / rows) * ((rows - drawn) / max(1, rows - 1)))
    reach = math.ceil(REACH * (spread + 1))
    # Whole numbers up to 2 ** 53 are exact as doubles.
    up = np.arange(mode, min(high, mode + reach), dtype=np.float64)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)
    rising = np.cumprod((chosen - up) / (up + 1) * ((drawn - up) / (others - drawn + up + 1)))
    falling = np.cumprod(down / (chosen - down + 1) * ((others - drawn + down) / (drawn - down + 1)))
    weights = np.concatenate([falling[::-1], [1.0], rising])
    sums = np.cumsum(weights)
    at = int(np.searchsorted(sums, draw.random() * sums[-1], side="right"))
    return mode - len(falling) + min(at, len(weights) - 1)


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows that each partition sends to each shard: exact in every row and column sum.

    One partition after the other draws its rows from the places that are left, shard by shard.
    """
    draw = np.random.default_rng(seed)
    left = [int(size) for size in even_sizes(sum(counts), shards)]
    matrix = np.zeros((len(counts), shards), dtype=np.int64)
    for i, count in enumerate(counts):
        places = sum(left)
        for j in range(shards):
            places -= left[j]
            sent = hypergeometric(left[j], places, count, draw)
            matrix[i, j] = sent
            left[j] -= sent
            count -= sent
    return matrix


def _slots(dealt: DataFrame, rows: int, shards: int, mix: Column, slice_rows: int) -> DataFrame:
    slices = max(1, -(-rows // (shards * slice_rows)))
    head = F.shiftrightunsigned(mix, 33)
    sliced = dealt.withColumn("mix", mix).withColumn("slice", F.shiftright(head * F.lit(slices), 31))
    sizes = sliced.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("shard").orderBy("slice"))
    firsts = sizes.select("shard", "slice", (upto - F.col("n")).alias("first"))
    within = Window.partitionBy("shard", "slice").orderBy(F.shiftrightunsigned("mix", 33), "mix", "row_number")
    placed = sliced.withColumn("nth", F.row_number().over(within) - 1)
    return placed.join(firsts, ["shard", "slice"]).withColumn("slot", F.col("first") + F.col("nth"))


def exact_shards(
    rows: DataFrame, shards: int = SHARDS, seed: int = SEED, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """All columns of ``rows`` within a struct ``row``, with ``shard`` and gapless ``slot``.

    ``rows`` is written once with partition and row numbers, so that a task run again
    deals the same rows to the same places.
    """
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    packed = packed.withColumns({"part": F.spark_partition_id(), "row_number": F.monotonically_increasing_id()})
    stored = materialize(packed, "shard-rows")
    counted = sorted((r["part"], r["count"]) for r in stored.groupBy("part").count().collect())
    counts = [n for _, n in counted]
    matrix = communication_matrix(counts, shards, seed)
    schema = "part int, upto array<long>"
    plan = [(p, [int(x) for x in line]) for (p, _), line in zip(counted, matrix.cumsum(axis=1))]
    # One row per input partition.
    ranges = F.broadcast(rows.sparkSession.createDataFrame(plan, schema))
    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), F.lit("local"), "row_number"), "row_number")
    mixed = stored.withColumn("nth_here", F.row_number().over(local) - 1)
    dealt = mixed.join(ranges, "part").withColumn(
        "shard", F.size(F.filter("upto", lambda x: x <= F.col("nth_here")))
    )
    again = F.xxhash64(F.lit(seed), F.lit("again"), "row_number")
    return _slots(dealt, sum(counts), shards, again, slice_rows).select("row", "shard", "slot")


def shard_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Digest of each document with its shard and slot; the law is ``rows``."""
    body = text_or_empty(text)
    slim = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    placed = exact_shards(slim, shards, seed, slice_rows)
    return placed.select(
        "row.*",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
