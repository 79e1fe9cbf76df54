"""SimHash near-duplicates by pigeonring filtering.

Fingerprints are 64-bit SimHashes of word shingles. Two fingerprints link when at
most ``max_bits`` bits differ. Candidates come from a ring of ``segments`` bit
segments: if the whole ring differs in at most ``max_bits`` places, then from some
segment on every chain of 1, 2, 3, ... consecutive segments differs in no more
than its proportional share, ``length * max_bits / segments``. So the first
segments of that chain, whose share is below one bit, are equal: they are the
bucket key, one per start. Within a bucket the rest of the chain is tested prefix by
prefix, and only pairs that pass get the full Hamming check.

A bucket holds distinct fingerprints only, so copies cost nothing. Buckets of more
than ``bucket_rows`` fingerprints (a large family of near copies) are not paired:
each of their fingerprints is listed at itself and at its one-bit neighbours, and
fingerprints that share such a point link. Two fingerprints within two bits always
share one, each point has at most 65 of them, and the work stays linear.

Defined results: null, empty and blank texts have no shingle and the fingerprint
zero, which links like any other; texts shorter than a shingle have their whole word
sequence as the only one; repeated rows and copies share a fingerprint. The
component is named by its smallest key that is not null; null when there is none.
Columns beside key and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from layerspark.llm.common import fresh_name, text_or_empty
from layerspark.llm.graph import components
from layerspark.session import materialize

BITS = 64
SHINGLE = 3
SEED = 42
MAX_BITS = 2
SEGMENTS = 5
BUCKET_ROWS = 256
HASH_BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash; a bit is set if more than half of the shingles set it.

    ``bytes.lower`` and ``bytes.split`` treat exactly A-Z and ASCII white space.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(g), seed) for g in grams), dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), HASH_BLOCK):
        bits = np.unpackbits(hashes[at : at + HASH_BLOCK].view(np.uint8), bitorder="little")
        ones += np.add.reduce(bits.reshape(-1, BITS), axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(
    docs: DataFrame, text: str = "text", name: str = "fp", shingle: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """All columns of ``docs`` and the fingerprint as a signed long; Arrow batches, no shuffle."""
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])
    place = docs.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.fromiter((fingerprint(t.as_py() or "", shingle, seed) for t in batch.column(place)), dtype="<u8")
            columns = [*batch.columns, pa.array(made.view("<i8"))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, name])

    return docs.mapInArrow(add, schema)


def ring(segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """First bit and width of each segment, as even as 64 bits allow."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def exact_segments(max_bits: int, segments: int) -> int:
    """Length of the longest chain whose share of the differing bits is below one."""
    return segments if max_bits == 0 else -(-segments // max_bits) - 1


def _segment(fp: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def ring_keys(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """One row per fingerprint and start: ``fp, start, key``."""
    parts, take = ring(segments), exact_segments(max_bits, segments)
    if take < 1:
        raise ValueError("more segments than differing bits are needed")
    keys = []
    for start in range(segments):
        key = F.lit(0).cast("long")
        for j in range(take):
            first, width = parts[(start + j) % segments]
            key = F.shiftleft(key, width).bitwiseOR(_segment(F.col("fp"), first, width))
        keys.append(F.struct(F.lit(start).alias("start"), key.alias("key")))
    return fps.select("fp", F.inline(F.array(*keys)))


def chain_passes(delta: np.ndarray, start: int, max_bits: int, segments: int) -> np.ndarray:
    """Whether each prefix of the chain from ``start`` stays within its share of the bits."""
    parts = ring(segments)
    alive = np.ones(delta.shape, dtype=bool)
    total = np.zeros(delta.shape, dtype=np.int64)
    for j in range(segments):
        first, width = parts[(start + j) % segments]
        total += np.bitwise_count((delta >> np.uint64(first)) & np.uint64((1 << width) - 1))
        alive &= total * segments <= (j + 1) * max_bits
    return alive


def _bucket_links(keyed: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """Links within buckets of a bounded size: ``a < b`` fingerprints."""
    buckets = keyed.groupBy("start", "key").agg(F.collect_list("fp").alias("fps")).select("start", "fps")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, fps in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.sort(fps.values.to_numpy(zero_copy_only=False)).view(np.uint64)
                delta = values[:, None] ^ values[None, :]
                i, j = np.nonzero(np.triu(chain_passes(delta, start, max_bits, segments), 1))
                near = np.bitwise_count(delta[i, j]) <= max_bits
                i, j = i[near], j[near]
                if len(i):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values[i].view(np.int64)), pa.array(values[j].view(np.int64))], names=["a", "b"]
                    )

    return buckets.mapInArrow(pairs, "a long, b long").distinct()


def _ball_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links of crowded fingerprints: those that share a point within half of ``max_bits``.

    Each point's fingerprints are tied to their smallest, which joins what is within
    ``max_bits`` of each other and nothing else: two fingerprints at one bit from a
    point are at most two bits apart.
    """
    if max_bits == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    if max_bits != 2:
        raise ValueError("crowded buckets are resolved for a distance of two bits")
    flips = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.expr(f"shiftleft(1L, {i})")) for i in range(BITS)]]
    points = fps.select("fp", F.explode(F.array(*flips)).alias("point"))
    shared = points.groupBy("point").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    tied = shared.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    return tied.filter("a < b").distinct()


def links(
    fps: DataFrame,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Links that connect all distinct fingerprints of ``fps`` within ``max_bits`` bits.

    ``fps`` is a stored table of distinct longs in ``fp``; it is read several times.
    """
    keyed = ring_keys(fps, max_bits, segments)
    sizes = materialize(keyed.groupBy("start", "key").count().filter("count > 1"), "simhash-buckets")
    usual = keyed.join(sizes.filter(F.col("count") <= bucket_rows), ["start", "key"], "left_semi")
    crowded = keyed.join(sizes.filter(F.col("count") > bucket_rows), ["start", "key"], "left_semi")
    return _bucket_links(usual, max_bits, segments).unionByName(
        _ball_links(crowded.select("fp").distinct(), max_bits)
    )


def grouped(
    fingerprinted: DataFrame,
    key: str = "doc_id",
    fp: str = "fp",
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per fingerprint: ``fp``, its component's ``root`` fingerprint and ``component_id``.

    ``fingerprinted`` is a stored table; only key and fingerprint are read.
    """
    slim = fingerprinted.select(F.col(key).alias("doc_id"), F.col(fp).alias("fp"))
    fps = materialize(slim.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    roots = components(materialize(links(fps.select("fp"), max_bits, segments, bucket_rows), "simhash-links"))
    named = fps.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    named = named.withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.select("fp", "root").join(least, "root")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    seed: int = SEED,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row."""
    slim = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
    slim = materialize(with_fingerprints(slim, "text", "fp", shingle, seed).drop("text"), "simhash-docs")
    groups = grouped(slim, "doc_id", "fp", max_bits, segments, bucket_rows)
    joined = slim.join(groups.select("fp", "component_id"), "fp", "left")
    return joined.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    seed: int = SEED,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest key.

    Rows that share that key are told apart by fingerprint, and of rows equal in both
    one stays. Null keys come last.
    """
    fp = fresh_name(docs.columns, "simhash_fp")
    stored = materialize(with_fingerprints(docs, text, fp, shingle, seed), "simhash-rows")
    groups = grouped(stored, key, fp, max_bits, segments, bucket_rows)
    slim = stored.groupBy(F.col(key).alias("k"), F.col(fp).alias("f")).agg(F.count("*").alias("copies"))
    order = F.struct(F.col("k").isNull().alias("none"), "k", "f", "copies")
    firsts = slim.join(groups, F.col("f") == F.col("fp"))
    firsts = firsts.groupBy("root").agg(F.min(order).alias("first")).select("first.k", "first.f", "first.copies")
    kept = stored.join(firsts, stored[key].eqNullSafe(firsts["k"]) & (stored[fp] == firsts["f"]))
    columns = [stored[f"`{c}`"] for c in docs.columns]
    single = kept.filter(firsts["copies"] == 1).select(*columns)
    several = kept.filter(firsts["copies"] > 1).select(stored[fp], *columns)
    one = several.dropDuplicates([key, fp]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return single.unionByName(one)
