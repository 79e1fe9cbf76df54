import hashlib
import random
import zlib

import pytest

from layerspark.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    """The contract, node by node; turns of equal number must be equal in role and text."""
    original = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        original.setdefault(conv, []).append((role or "", text or ""))
    rebuilt = {}
    for c in original:
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = original.get(base, [])[:h] + original[c][h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[n] for n in below) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[n] for n in below)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children.get(node, [])), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    assert frame.columns == list(COLUMNS)
    return sorted((tuple(r) for r in frame.collect()), key=str)


def table(seed, convs=120, longest=9):
    """Conversations that share starts, with copies, gaps in the ids and null values."""
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-40, 400), convs):
        last = draw.choice([3, longest])
        for t in range(draw.randint(1, last)):
            rows.append((c, t or None, draw.choice(["user", "user", None]), draw.choice(["hi", "hi", "hi", "é ü", None])))
    return rows


@pytest.mark.parametrize("seed,longest,band,block", [(1, 9, 16, 4096), (2, 40, 4, 3), (3, 70, 2, 1), (4, 30, 3, 2)])
def test_against_brute_force(spark, seed, longest, band, block):
    rows = table(seed, longest=longest)
    assert got(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), band, block)) == brute(rows)


def test_whole_table(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    assert got(trie.prefix_trie(turns)) == brute([tuple(r) for r in turns.select(*COLUMNS[:1], "turn", "role", "text").collect()])


def test_hot_conversation_and_hot_start(spark):
    rows = [(7, t, "user", f"line {t % 3}") for t in range(700)]
    rows += [(c, 0, "system", "start") for c in range(1000, 1400)] + [(c, 1, "user", str(c % 7)) for c in range(1000, 1400)]
    assert got(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), band=4, block_ids=16)) == brute(rows)


def test_odd_rows(spark):
    rows = [(5, 1, "a", "x"), (5, 1, "a", "x"), (6, None, None, None), (6, 2, "", "long " * 20_000), (-3, 4, "a", "x")]
    frame = spark.createDataFrame([*rows, (None, 1, "a", "x")], SCHEMA)
    extra = frame.selectExpr("*", "1 AS conv", "2 AS a", "3 AS b", "4 AS hi", "5 AS depth", "6 AS row_index", "7 AS base")
    assert got(trie.prefix_trie(extra)) == brute(rows)
    assert got(trie.prefix_trie(frame.limit(0))) == []


def test_equal_turn_numbers_have_one_order(spark):
    rows = [(5, 1, "a", f"t{i}") for i in range(6)] + [(8, 1, "a", f"t{i}") for i in reversed(range(6))]
    one = got(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert one == got(trie.prefix_trie(spark.createDataFrame(rows[::-1], SCHEMA)))
