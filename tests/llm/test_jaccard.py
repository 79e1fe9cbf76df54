import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerspark.llm import jaccard
from plan_text import plan_of

SCHEMA = "doc_id long, text string"


def brute_set(text, shingle=3):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < shingle:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1))


def brute(rows, percent=90):
    """Size and component of each row, by comparing every two different sets."""
    sets = [brute_set(text) for _, text in rows]
    different = sorted({s for s in sets if s}, key=len)
    parent = {s: s for s in different}

    def find(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    for i, a in enumerate(different):
        for b in different[i + 1 :]:
            if len(a) * 100 < percent * len(b):
                break
            same = len(a & b)
            if 100 * same >= percent * (len(a) + len(b) - same):
                parent[find(a)] = find(b)
    least = {}
    for (key, _), s in zip(rows, sets):
        if s and key is not None:
            root = find(s)
            least[root] = min(least.get(root, key), key)
    return sorted(((k, len(s), least.get(find(s)) if s else k) for (k, _), s in zip(rows, sets)), key=str)


def got(frame, **options):
    out = jaccard.join_documents(frame, **options)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def family(seed, size=150, vocabulary=12, words=(9, 200)):
    """Chains of edited texts over few words, so that frequent tokens and near misses abound."""
    draw = random.Random(seed)
    pool = [f"w{i}" for i in range(vocabulary)]
    texts = [" ".join(draw.choices(pool, k=draw.randint(*words))) for _ in range(8)]
    while len(texts) < size:
        at = draw.choice(texts).split()
        for _ in range(draw.randint(1, max(1, len(at) // 40))):
            at[draw.randrange(len(at))] = draw.choice(pool)
        texts.append(" ".join(at + draw.choices(pool, k=draw.choice([0, 0, 1]))))
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("limits", [(2, 5), (3, 1000), (33, 1025)])
def test_against_brute_force(spark, limits):
    rows = family(len(limits) + limits[0])
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows)
    assert got(spark.createDataFrame(rows, SCHEMA), limits=limits) == want


def test_other_similarity(spark):
    rows = family(9, size=100)
    assert got(spark.createDataFrame(rows, SCHEMA), percent=80, limits=(2, 6)) == brute(rows, 80)
    with pytest.raises(ValueError):
        jaccard.join_documents(spark.createDataFrame(rows, SCHEMA), percent=79)


def test_given_documents(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(docs) == brute(rows)


def test_odd_documents(spark, odd_docs, clashing, no_docs):
    want = brute([tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    assert got(odd_docs) == want
    names = ("a", "b", "id", "row", "sig", "text_a", "t1", "head", "comp", "doc")
    assert got(clashing.withColumns({n: F.lit(1) for n in names if n not in clashing.columns})) == want
    assert got(no_docs) == []


def test_every_link_shares_a_signature():
    """The prefix argument, for random sets at the edge of the threshold and any classes."""
    draw = np.random.default_rng(1)
    for trial in range(300):
        n = int(draw.integers(9, 400))
        base = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
        lost = int(draw.integers(0, len(base) // 10 + 1))
        kept = draw.permutation(base)[lost:]
        room = int((len(kept) * 100) // 90) - len(base)
        other = np.unique(np.append(kept, draw.integers(0, 2**64, int(draw.integers(0, max(0, room) + 1)), dtype=np.uint64)))
        same = len(np.intersect1d(base, other))
        if 100 * same < 90 * (len(base) + len(other) - same) or np.array_equal(base, other):
            continue
        tokens = np.unique(np.append(base, other))
        share = draw.random()
        known = np.sort(draw.permutation(tokens))
        known = known[draw.random(len(known)) < share]
        kinds = draw.integers(2, 4, len(known))
        found = []
        for one in (base, other):
            size = len(one)
            cut = max(jaccard.zone_tokens(one, min(jaccard.bands(size, 90))), jaccard.head_size(size, 90))
            head = one[:cut]
            mine = jaccard.classes_of(head, known, kinds)
            found.append(set(jaccard.set_signatures(size, head, mine, 90).tolist()))
        assert found[0] & found[1], (trial, len(base), len(other))


def test_parities_bound_the_difference():
    """The bound never exceeds the true number, and is close for sets near the threshold."""
    draw = np.random.default_rng(2)
    for trial in range(200):
        n = int(draw.integers(1, 5000)) if trial else 100_000
        one = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
        lost, more = (int(draw.integers(0, max(1, n // 3))) for _ in "ab")
        two = np.unique(np.append(draw.permutation(one)[lost:], draw.integers(0, 2**64, more, dtype=np.uint64)))
        apart = len(np.setxor1d(one, two))
        bound = jaccard.least_apart(jaccard.parities(one), jaccard.parities(two))
        assert bound == jaccard.least_apart(jaccard.parities(two), jaccard.parities(one))
        assert bound <= apart and (bound - apart) % 2 == 0
        assert n > 10_000 or bound >= 0.5 * apart - 8
        assert len(jaccard.parities(one)) <= jaccard.MOST_BITS // 8
    assert jaccard.least_apart(jaccard.parities(one), jaccard.parities(one)) == 0


def test_pairs_within_large_groups(spark):
    rows = [("x", i, i % 3) for i in range(40)] + [("y", i, i % 2) for i in range(30, 45)] + [("z", 1, 1)]
    frame = spark.createDataFrame(rows, "g string, i long, d long")
    want = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and a[2] != b[2]}
    for piece in (4, 1000):
        pairs = jaccard.pairs_within(frame, "g", "i", ["d"], F.col("a_d") != F.col("b_d"), piece).collect()
        assert len(pairs) == len(want) and {tuple(p) for p in pairs} == want


@pytest.mark.parametrize("side", [7, 4096])
def test_blocks_keep_every_pair_with_room(spark, side):
    draw = np.random.default_rng(6)
    base = draw.integers(0, 2**64, 130, dtype=np.uint64)
    sets, rows = [], []
    for i in range(60):
        fresh = draw.integers(0, 2**64, int(draw.integers(0, 30)), dtype=np.uint64)
        sets.append(np.unique(np.append(draw.permutation(base)[int(draw.integers(0, 20)) :], fresh)))
        bits = bytearray(jaccard.parities(sets[-1]))
        rows.append((i % 2, i, i % 9, len(sets[-1]), 0.02 * (i % 3), bits, 30))
    frame = spark.createDataFrame(rows, "sig long, centre long, comp long, centre_n long, radius double, bits binary, items long")
    found = [tuple(r) for r in jaccard.block_pairs(frame, 0.1, side).collect()]
    assert len(set(found)) == len(found) < 600
    for a in range(60):
        for b in range(a + 1, 60):
            same, far = len(np.intersect1d(sets[a], sets[b])), len(np.setxor1d(sets[a], sets[b]))
            near = far / (far + same) <= 0.1 + 0.02 * (a % 3) + 0.02 * (b % 3)
            apart = a % 2 != b % 2 or a % 9 == b % 9
            assert not (apart and (a, b) in found)
            assert apart or not near or (a, b) in found


@pytest.mark.parametrize("least", [0, 10_000])
def test_blocks_and_rows_find_the_same(spark, monkeypatch, least):
    monkeypatch.setattr(jaccard, "BLOCK_FROM", least)
    rows = family(21, size=120)
    assert got(spark.createDataFrame(rows, SCHEMA), limits=(3, 9)) == brute(rows)


def test_group_of_near_copies_is_a_star(spark, monkeypatch):
    """Near copies meet the first of them, not each other."""
    draw = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(300):
        at = list(base)
        at[draw.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(at)))
    seen = []
    compared = jaccard.Candidates.compared

    def counted(self, pairs):
        out = compared(self, pairs)
        seen.append(out.count())
        return out

    monkeypatch.setattr(jaccard.Candidates, "compared", counted)
    assert {c for _, _, c in got(spark.createDataFrame(rows, SCHEMA))} == {0}
    assert sum(seen) < 10 * len(rows)


def test_groups_around_near_centres_are_not_paired(spark, monkeypatch):
    """Groups too far apart to link, whose radii alone leave room, give no pair for every two of their sets."""
    draw = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(40):
        centre = list(base)
        for at in draw.sample(range(120), 2):
            centre[at] = f"c{i}-{at}"
        for j in range(4):
            one = list(centre)
            for at in draw.sample(range(120), min(j, 2)):
                one[at] = f"d{i}-{j}-{at}"
            rows.append((len(rows), " ".join(one)))
    seen = []
    bounded = jaccard.Candidates.bounded

    def counted(self, pairs):
        out = bounded(self, pairs)
        seen.append(out.count())
        return out

    monkeypatch.setattr(jaccard.Candidates, "bounded", counted)
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert sum(seen) < 10 * len(rows), seen


def near_misses(count):
    """Sets of which any two have most tokens in common, but never enough to link."""
    draw = random.Random(5)
    rows = []
    for i in range(count):
        at = [f"b{j}" for j in range(120)]
        for j in draw.sample(range(4, 116, 4), 2):
            at[j] = f"x{i}-{j}"
        rows.append((i, " ".join(at)))
    return rows


@pytest.mark.parametrize("settles_half", [False, True])
def test_stars_that_settle_little_are_not_repeated(spark, monkeypatch, settles_half):
    """Each further star costs a shuffle of all rows left; without it the blocks find the same."""
    drawn, next_stars, unsettled = [], jaccard.next_stars, jaccard.unsettled

    def counted(*given):
        drawn.append(given)
        return next_stars(*given)

    def judged(members, roots):
        rest, _, left = unsettled(members, roots)
        return rest, left * 2 if settles_half else left, left

    monkeypatch.setattr(jaccard, "next_stars", counted)
    monkeypatch.setattr(jaccard, "unsettled", judged)
    rows = near_misses(40)
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert bool(drawn) == settles_half


def test_set_comes_to_a_block_once(spark):
    """Sets that share many signatures are sent with their bits once, not once for each signature."""
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**64, 130, dtype=np.uint64)
    sets = [np.unique(np.append(base[:-1], draw.integers(0, 2**64, 1, dtype=np.uint64))) for _ in range(6)]
    rows = [(s, i, i, len(t), 0.0, bytearray(jaccard.parities(t)), 6) for s in range(50) for i, t in enumerate(sets)]
    frame = spark.createDataFrame(rows, "sig long, centre long, comp long, centre_n long, radius double, bits binary, items long")
    pairs = jaccard.block_pairs(frame, 0.1)
    assert sorted(map(tuple, pairs.collect())) == [(a, b) for a in range(6) for b in range(a + 1, 6)]
    assert "collect_list(sig" in plan_of(pairs)
