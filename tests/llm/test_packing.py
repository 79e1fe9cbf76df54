import zlib

import numpy as np
import pytest

from layerspark.llm import packing


def exact_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def plain_first_fit(lengths, capacity):
    free, where = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        b = next((b for b, room in enumerate(free) if room >= lengths[i]), len(free))
        if b == len(free):
            free.append(capacity)
        where.append((i, b, capacity - free[b]))
        free[b] -= lengths[i]
    return [x[1:] for x in sorted(where)]


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 700])
def test_tournament_tree_is_first_fit(n):
    lengths = np.random.default_rng(n).integers(1, 101, n)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    assert list(zip(bins.tolist(), offsets.tolist())) == plain_first_fit(lengths.tolist(), 100)


@pytest.mark.parametrize("group_pieces", [50_000, 7])
def test_every_id_lies_in_one_piece(docs, odd_docs, group_pieces):
    table = docs.limit(60).select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    got = packing.pack(table, group_pieces=group_pieces).collect()
    want, have = {}, {}
    for r in table.collect():
        ids = exact_ids(r.text)
        for a in range(0, len(ids), 1024):
            part = np.array(ids[a : a + 1024], dtype="<u4").tobytes()
            key = (r.doc_id, a, len(part) // 4, zlib.crc32(part), len(ids))
            want[key] = want.get(key, 0) + 1
    sequences = {}
    for r in got:
        have[tuple(r[:5])] = have.get(tuple(r[:5]), 0) + 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert have == want
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_little_padding(docs):
    got = packing.pack(docs).collect()
    used, sequences = sum(r.length for r in got), {r.sequence_id for r in got}
    assert used / (1024 * len(sequences)) > 0.97


def test_empty_and_clashing(no_docs, clashing):
    assert packing.pack(no_docs).count() == 0
    assert packing.pack(clashing).select("doc_id").distinct().count() == 8
