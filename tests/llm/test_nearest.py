import numpy as np

from layerspark.llm import nearest


def brute(rows, k):
    """Nearest rows by inner product; rows are (id, vector)."""
    out = {}
    x = np.array([v for _, v in rows], dtype=float)
    ids = np.array([i for i, _ in rows])
    for n, (i, _) in enumerate(rows):
        if i % 20 == 0:
            score = (x * x[n]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if j != n][:k]
            out.setdefault(i, []).append([(int(ids[j]), score[j]) for j in order])
    return out


def test_recall_and_exact_scores(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    vectors, want = dict(rows), brute(rows, 20)
    got = {}
    for r in nearest.search(table).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hit = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in [f[1] for f in found]
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        for _, i, s in found:
            assert abs(s - float(np.dot(np.array(vectors[i], float), np.array(vectors[q], float)))) < 1e-12
        hit += len({f[1] for f in found} & {i for i, _ in want[q][0]})
    assert hit / (20 * len(want)) >= 0.9


def test_hot_vector_ties_and_small_blocks(spark):
    rng = np.random.default_rng(1)
    hot = [float(x) for x in rng.normal(size=8)]
    rows = [(i, hot if i % 3 == 0 else [float(x) for x in rng.normal(size=8) * (1 + i % 4)]) for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nearest.search(table, k=5, target_recall=1.0, block_rows=16).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    want, hits = brute(rows, 5), 0
    for q, found in got.items():
        hits += len({i for _, i in found} & {i for i, _ in want[q][0]})
    assert len(got) == len(want) and hits / (5 * len(want)) > 0.95


def test_odd_vectors_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, []), (20, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (40, [1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, nearest.search(table).collect()))
    assert got == [(0, 1, 40, 1.0), (0, 2, 1, 0.5), (40, 1, 0, 1.0), (40, 2, 1, 0.5)]
    assert nearest.search(table.filter("vec_id in (2, 3)")).count() == 0
    assert nearest.search(table.filter("vec_id = 0")).count() == 0


def test_scan_abandons_and_keeps(spark):
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(500, 64)), rng.normal(size=64)
    blocks = [x[:, a : a + 16] for a in range(0, 64, 16)]
    far = ((x - q) ** 2).sum(axis=1)
    limit = np.sort(far)[19]
    alive, _ = nearest.scan(blocks, q, limit, 20, 16)
    assert set(alive) <= set(np.flatnonzero(far <= limit * 1.001)) and len(alive) >= 18
