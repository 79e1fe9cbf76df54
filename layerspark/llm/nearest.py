"""Approximate nearest neighbours by inner product, with an adaptive dimension scan.

Vectors get one more component that gives all the same length, which turns the
largest inner product into the smallest distance, and are rotated at random. They
are kept in lists around centroids that k-means finds on a bounded sample
(``SAMPLE_ROWS``); every vector is put into a list. A list is stored as blocks of
bounded size, each as column blocks of the rotated vectors, so the vectors of a hot
list spread over many tasks.

A query probes its nearest lists. Their number is set on the sample: the smallest that
holds ``TARGET_RECALL`` of the neighbours that brute force finds there. Within a block its distances grow one column
block at a time. After the first d of D components, a random rotation makes the
partial distance times D / d an estimate of the whole one, and a candidate is given
up once the estimate exceeds the best known k-th distance by more than chance allows:
factor (1 + EPSILON / sqrt(d)) squared. The nearest list is scanned first; its
k-th distance is the threshold for the others. Survivors are scored exactly, in
double precision on the original vectors.

Defined results: vectors that are null, zero or hold null or non-finite components
take no part, nor do rows with a null id or of another dimension than most. Rows
with equal vectors tie and the smaller id comes first. Each row is a candidate of its
own, also where ids repeat; a query only leaves out its own row. Columns beside id
and vector are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerspark.llm.common import hashed_share
from layerspark.session import materialize

K = 20
QUERY_STEP = 20
SAMPLE_ROWS = 10_000
LIST_SHARE = 0.25
BLOCK_ROWS = 2048
QUERY_ROWS = 256
COLUMNS = 16
EPSILON = 2.1
SEED = 5
MAX_LISTS = 4096
TARGET_RECALL = 0.95
CHECK_QUERIES = 400


def valid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``row, vec_id, vec`` (doubles) of the rows that take part, written once."""
    vec = F.col(vector).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    length = F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x)
    slim = rows.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vec) > 0))
    slim = slim.filter(~bad & (length > 0))
    slim = slim.select(F.col(key).cast("long").alias("vec_id"), vec.alias("vec"), length.alias("square"))
    stored = materialize(slim.withColumn("row", F.monotonically_increasing_id()), "ann-vectors")
    usual = stored.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return stored.filter(F.size("vec") == (usual["dim"] if usual else 0))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest_centers(x, centers, 1)[:, 0]
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=k)
        # An empty list starts again at a sampled vector.
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], x[rng.choice(len(x), k)])
    return centers


def nearest_centers(x: np.ndarray, centers: np.ndarray, n: int) -> np.ndarray:
    """Indices of the ``n`` nearest centers of each row, nearest first."""
    far = (centers * centers).sum(axis=1)[None, :] - 2 * x @ centers.T
    if n == 1:
        return far.argmin(axis=1)[:, None]
    part = np.argpartition(far, n - 1, axis=1)[:, :n] if n < far.shape[1] else np.tile(np.arange(n), (len(x), 1))
    order = np.take_along_axis(far, part, axis=1).argsort(axis=1, kind="stable")
    return np.take_along_axis(part, order, axis=1)


class Frame:
    """The rotation, the common length and the centroids; small and sent to every task."""

    def __init__(self, sample: np.ndarray, rows: int, square: float, k: int, target: float, seed: int):
        self.square, self.dim = square, sample.shape[1] + 1
        rng = np.random.default_rng(seed)
        self.rotation = np.linalg.qr(rng.normal(size=(self.dim, self.dim)))[0]
        lists = int(min(MAX_LISTS, max(1, round(LIST_SHARE * rows**0.5)), len(sample)))
        self.centers = kmeans(self.turned(sample), lists, seed)
        self.probes = self.calibrate(sample, k, target)

    def calibrate(self, sample: np.ndarray, k: int, target: float) -> int:
        """Lists to probe so that the sample's own nearest rows lie in them often enough."""
        queries, home = sample[:CHECK_QUERIES], nearest_centers(self.turned(sample), self.centers, 1)[:, 0]
        score = queries @ sample.T
        score[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
        k = min(k, len(sample) - 1)
        if k < 1:
            return len(self.centers)
        near = np.argpartition(-score, k - 1, axis=1)[:, :k]
        order = nearest_centers(self.turned_queries(queries), self.centers, len(self.centers))
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
        needed = np.take_along_axis(rank, home[near], axis=1)
        return int(np.quantile(needed, target, method="higher")) + 1

    def turned(self, x: np.ndarray) -> np.ndarray:
        """Rotated vectors of equal length; queries have no extra component."""
        more = np.sqrt(np.maximum(self.square - (x * x).sum(axis=1), 0))
        return np.hstack([x, more[:, None]]) @ self.rotation

    def turned_queries(self, q: np.ndarray) -> np.ndarray:
        return np.hstack([q, np.zeros((len(q), 1))]) @ self.rotation


def fit(vectors: DataFrame, k: int = K, target: float = TARGET_RECALL, seed: int = SEED) -> Frame | None:
    """Centroids from about ``SAMPLE_ROWS`` rows drawn by hash, or from all if there are fewer."""
    rows, square = vectors.agg(F.count("*"), F.max("square")).first()
    if not rows:
        return None
    share = SAMPLE_ROWS / max(rows, SAMPLE_ROWS)
    some = vectors.filter(hashed_share(seed, "row", share=share)) if share < 1 else vectors
    sample = sorted(some.select(F.xxhash64("row"), "vec").collect())
    return Frame(np.array([r["vec"] for r in sample], dtype=np.float64), rows, square, k, target, seed)


def _blocks(vectors: DataFrame, shared, columns: int, block_rows: int) -> DataFrame:
    """The index: one row per block with ids, original vectors and rotated column blocks."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame = shared.value
        for batch in batches:
            if batch.num_rows:
                near = nearest_centers(frame.turned(_matrix(batch.column(2))), frame.centers, 1)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(near.astype(np.int32))], names=["row", "vec_id", "vec", "list"]
                )

    listed = vectors.select("row", "vec_id", "vec").mapInArrow(assign, "row long, vec_id long, vec array<double>, list int")
    listed = materialize(listed, "ann-lists")
    sizes = listed.groupBy("list").agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
    # One row per list, of which there are MAX_LISTS at most.
    placed = listed.join(F.broadcast(sizes), "list")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))

    def pack(part: pa.Table) -> pa.Table:
        frame, x = shared.value, _matrix(part["vec"])
        turned = frame.turned(x).astype(np.float32)
        cut = [np.ascontiguousarray(turned[:, a : a + columns]).tobytes() for a in range(0, frame.dim, columns)]
        return pa.table(
            {
                "list": part["list"][:1],
                "rows": pa.array([part["row"].to_numpy().tobytes()], pa.binary()),
                "ids": pa.array([part["vec_id"].to_numpy().tobytes()], pa.binary()),
                "vectors": pa.array([x.tobytes()], pa.binary()),
                "turned": pa.array([b"".join(cut)], pa.binary()),
            }
        )

    schema = "list int, rows binary, ids binary, vectors binary, turned binary"
    return materialize(placed.groupBy("list", "block").applyInArrow(pack, schema), "ann-blocks")


def _probes(queries: DataFrame, shared) -> DataFrame:
    """``row, vec_id, vec, list, rank`` for the lists that each query probes."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame = shared.value
        n = frame.probes
        for batch in batches:
            if batch.num_rows:
                near = nearest_centers(frame.turned_queries(_matrix(batch.column(2))), frame.centers, n)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(near.astype(np.int32).ravel()), n)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, lists.cast(pa.list_(pa.int32()))], names=["row", "vec_id", "vec", "lists"]
                )

    schema = "row long, vec_id long, vec array<double>, lists array<int>"
    near = queries.select("row", "vec_id", "vec").mapInArrow(probe, schema)
    return near.select("row", "vec_id", "vec", F.posexplode("lists").alias("rank", "list"))


def scan(turned: list[np.ndarray], query: np.ndarray, limit: float, k: int, columns: int) -> tuple[np.ndarray, float]:
    """Candidates of a block that survive all column blocks, and the limit used.

    Without a limit, the k-th distance of the block's first rows serves.
    """
    dim, n = len(query), len(turned[0])
    parts = [query[a : a + columns] for a in range(0, dim, columns)]
    if not np.isfinite(limit) and n > k:
        head = sum(((t[: 4 * k] - p) ** 2).sum(axis=1) for t, p in zip(turned, parts))
        limit = float(np.partition(head, k - 1)[k - 1])
    alive, far, seen = np.arange(n), np.zeros(n), 0
    for t, p in zip(turned, parts):
        delta = t[alive] - p
        far += np.einsum("ij,ij->i", delta, delta)
        seen += len(p)
        # The last test has no chance left in it, only room for rounding.
        slack = (1 + EPSILON / seen**0.5) ** 2 if seen < dim else 1 + 1e-4
        keep = far * (dim / seen) <= limit * slack + 1e-6
        alive, far = alive[keep], far[keep]
    return alive, limit


def _search(blocks: DataFrame, probes: DataFrame, shared, k: int, columns: int) -> DataFrame:
    """Best ``k`` candidates of each query and block: ``query, query_id, vec_id, score``."""
    sizes = probes.groupBy("list").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("batches"))
    grouped = probes.join(F.broadcast(sizes), "list")
    grouped = grouped.withColumn("batch", F.pmod(F.xxhash64("row"), F.col("batches")).cast("int"))
    asked = grouped.groupBy("list", "batch").agg(
        F.collect_list(F.struct("row", "vec_id", "limit", "vec")).alias("asked")
    )
    joined = blocks.join(asked.select("list", "asked"), "list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame = shared.value
        for batch in batches:
            for one in batch.to_pylist():
                rows, ids = np.frombuffer(one["rows"], np.int64), np.frombuffer(one["ids"], np.int64)
                x = np.frombuffer(one["vectors"]).reshape(len(rows), -1)
                flat, turned, at = np.frombuffer(one["turned"], np.float32), [], 0
                for a in range(0, frame.dim, columns):
                    width = min(columns, frame.dim - a)
                    turned.append(flat[at : at + width * len(rows)].reshape(len(rows), width))
                    at += width * len(rows)
                q = np.array([r["vec"] for r in one["asked"]])
                out = [[], [], [], []]
                for r, vec, spun in zip(one["asked"], q, frame.turned_queries(q).astype(np.float32)):
                    alive, _ = scan(turned, spun, r["limit"], k, columns)
                    alive = alive[rows[alive] != r["row"]]
                    score = (x[alive] * vec).sum(axis=1)
                    best = np.lexsort((ids[alive], -score))[:k]
                    for column, values in zip(
                        out, (np.full(len(best), r["row"]), np.full(len(best), r["vec_id"]), ids[alive][best], score[best])
                    ):
                        column.append(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in out], names=["query", "query_id", "vec_id", "score"]
                )

    return joined.drop("list").mapInArrow(run, "query long, query_id long, vec_id long, score double")


def search(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    query_step: int = QUERY_STEP,
    target_recall: float = TARGET_RECALL,
    columns: int = COLUMNS,
    block_rows: int = BLOCK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """The ``k`` nearest rows of every row whose id is divisible by ``query_step``."""
    spark = rows.sparkSession
    vectors = valid_vectors(rows, key, vector)
    frame = fit(vectors, k, target_recall, seed)
    if frame is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(frame)
    blocks = _blocks(vectors, shared, columns, block_rows)
    probes = materialize(_probes(vectors.filter(F.col("vec_id") % query_step == 0), shared), "ann-probes")
    first = probes.filter("rank = 0").withColumn("limit", F.lit(float("inf")))
    # One more than k, as the query's own row is left out.
    near = materialize(_search(blocks, first, shared, k, columns), "ann-first")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    kth = near.withColumn("n", F.row_number().over(order)).filter(F.col("n") == k)
    lengths = vectors.select(F.col("row").alias("query"), "square")
    # A squared distance from the inner product; both vectors have known lengths.
    limits = kth.join(lengths, "query").select(
        F.col("query").alias("row"), (F.lit(frame.square) + F.col("square") - 2 * F.col("score")).alias("limit")
    )
    others = probes.filter("rank > 0").join(limits, "row", "left")
    others = others.withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    found = near.unionByName(_search(blocks, others, shared, k, columns))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
