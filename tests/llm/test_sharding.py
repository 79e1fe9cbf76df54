import zlib
from collections import Counter
from math import comb

import numpy as np

from layerspark.llm import sharding


def test_law_slots_and_digests(docs, odd_docs):
    table = docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text")).repartition(7)
    got = sharding.shard_documents(table, slice_rows=10).collect()
    want = sorted((r.doc_id or 0, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in table.collect())
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in got) == want
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.slot)
    assert set(shards) == set(range(8)) and {r.law for r in got} == {"rows"}
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())


def test_matrix_sums_and_law():
    counts = [5, 0, 17, 1, 40]
    drawn = np.array([sharding.communication_matrix(counts, 4, s) for s in range(3000)])
    assert (drawn.sum(axis=2) == counts).all()
    assert (drawn.sum(axis=1) == sharding.even_sizes(sum(counts), 4)).all()
    # Mean and variance of a hypergeometric count.
    n, k, size = sum(counts), 40, sharding.even_sizes(sum(counts), 4)[0]
    assert abs(drawn[:, 4, 0].mean() - k * size / n) < 0.15
    variance = k * (size / n) * (1 - size / n) * (n - k) / (n - 1)
    assert abs(drawn[:, 4, 0].var() / variance - 1) < 0.12


def test_counts_follow_the_law():
    """Every value of small laws, by chi-square against exact binomial coefficients."""
    draw = np.random.default_rng(3)
    for chosen, others, drawn in [(7, 5, 6), (3, 40, 20), (30, 2, 9), (1, 1, 1)]:
        got = Counter(sharding.hypergeometric(chosen, others, drawn, draw) for _ in range(4000))
        law = {k: comb(chosen, k) * comb(others, drawn - k) / comb(chosen + others, drawn) for k in range(drawn + 1)}
        assert set(got) <= {k for k, p in law.items() if p}
        likely = {k: p for k, p in law.items() if p * 4000 >= 5}
        assert sum((got[k] - 4000 * p) ** 2 / (4000 * p) for k, p in likely.items()) < 30
    assert [sharding.hypergeometric(*c, draw) for c in [(5, 0, 3), (0, 9, 4), (6, 3, 9), (8, 8, 0)]] == [3, 0, 6, 0]


def test_matrix_of_a_huge_table():
    counts = [10**12, 3, 0, 4 * 10**11, 5 * 10**11 + 1]
    drawn = sharding.communication_matrix(counts, 8, 5)
    sizes = sharding.even_sizes(sum(counts), 8)
    assert drawn.sum(axis=1).tolist() == counts and (drawn.sum(axis=0) == sizes).all() and (drawn >= 0).all()
    n, k = sum(counts), counts[3]
    spread = (k / 8 * 7 / 8 * (n - k) / n) ** 0.5
    assert 0 < abs(drawn[3] - k / 8).max() < 6 * spread
    single = [sharding.hypergeometric(10**11, 7 * 10**11, 10**7, np.random.default_rng(s)) for s in range(400)]
    assert abs(np.mean(single) - 10**7 / 8) < 5 * (10**7 / 8 * 7 / 8 / 400) ** 0.5
    assert abs(np.var(single) / (10**7 / 8 * 7 / 8) - 1) < 0.35


def test_every_place_is_equally_likely(spark):
    rows = spark.range(16).repartition(3)
    counts = np.zeros((16, 4))
    for seed in range(60):
        for r in sharding.exact_shards(rows, 4, seed, slice_rows=1).collect():
            counts[r.row.id, r.shard] += 1
    # Chi-square over 16 * 4 cells with 45 degrees of freedom; 80 is its 0.999 quantile.
    assert ((counts - 15) ** 2 / 15).sum() < 80


def test_same_seed_same_place(docs):
    twice = [sorted(map(tuple, sharding.shard_documents(docs).select("doc_id", "shard", "slot").collect())) for _ in "ab"]
    assert twice[0] == twice[1]


def test_empty_and_clashing(no_docs, clashing):
    assert sharding.shard_documents(no_docs).count() == 0
    assert sharding.shard_documents(clashing).count() == clashing.count()
    assert sharding.exact_shards(clashing).select("row.*").columns == clashing.columns
