import numpy as np
import pytest
import xxhash

from layerspark.llm import graph, simhash


def brute_components(fps, ids, bits):
    values = sorted(set(fps))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for fp, i in zip(fps, ids):
        if i is not None:
            least[find(fp)] = min(least.get(find(fp), i), i)
    return [least.get(find(fp)) for fp in fps]


def test_fingerprint_by_definition():
    text = "The quick\tBROWN fox jumps\nover é Ü"
    words = "the quick brown fox jumps over é Ü".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), seed=42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("Two WORDS") == xxhash.xxh64_intdigest(b"two words", seed=42)
    assert simhash.fingerprint(" \n") == 0


@pytest.mark.parametrize("bucket_rows", [1, 256])
def test_against_brute_force(docs, odd_docs, bucket_rows):
    table = docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    got = simhash.near_duplicates(table, bucket_rows=bucket_rows).collect()
    assert len(got) == table.count()
    fps = [int(r.fingerprint, 16) for r in got]
    assert [r.component_id for r in got] == brute_components(fps, [r.doc_id for r in got], 2)
    texts = sorted(f"{simhash.fingerprint(r.text or ''):016x}" for r in table.collect())
    assert texts == sorted(r.fingerprint for r in got)


def family(seed, members=400):
    """Fingerprints in chains and balls, so that links reach over several steps."""
    rng = np.random.default_rng(seed)
    values = [int(x) for x in rng.integers(0, 2**64, 40, dtype=np.uint64)]
    while len(values) < members:
        v = values[rng.integers(len(values))]
        for bit in rng.integers(0, 64, rng.integers(1, 4)):
            v ^= 1 << int(bit)
        values.append(v)
    return sorted(set(values))


@pytest.mark.parametrize("segments,bucket_rows", [(5, 256), (3, 8), (7, 1)])
def test_no_link_is_lost(spark, segments, bucket_rows):
    values = family(segments)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(signed)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.grouped(rows, segments=segments, bucket_rows=bucket_rows).collect()}
    assert [got[v] for v in signed] == brute_components(values, list(range(len(values))), 2)


def test_keep_one(docs, odd_docs, clashing, no_docs):
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == sorted(groups)
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    # Blank texts are one group; the prose with ids null and 4 is another.
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 4, 5, 6, 7]
    assert simhash.keep_one(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    roots = {r.node: r.root for r in graph.components(links).collect()}
    assert roots == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}
