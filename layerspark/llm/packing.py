"""Packing documents into fixed-length sequences by first-fit decreasing.

Every document is tokenized and ended by the separator id. It is cut into whole
sequences; what is left over, less than one sequence, is a piece to be packed.
Pieces are dealt at random into groups of a bounded size. Within a group they are
taken from longest to shortest, each into the first bin that still has room. A
tournament tree over the bins' free space finds that bin in logarithmic time:
each inner node holds the largest space below it, so the walk from the root takes
the left child whenever it has room.

Only lengths and checksums travel; token ids stay in the task that made them.

Defined results: null and empty texts are the separator alone. Repeated rows and
null ids are packed like any other; a piece is its own row. Very long texts give
many whole sequences and one left-over piece. Columns beside key and text are not
read. An empty table gives an empty result. Ids equal those of the ``tokenizers``
file: the same vocabulary runs through the faster ``tiktoken`` when both files are
given, and texts that spell a special token go through ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerspark.llm.common import text_or_empty
from layerspark.session import materialize

LENGTH = 1024
SEPARATOR = 0
GROUP_PIECES = 50_000
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
ID_BYTES = 4


@lru_cache(maxsize=2)
def encoder(tokenizer: str = TOKENIZER, ranks: str | None = RANKS):
    """Function from text to its ids, as a list. Files are named as in ``public_tokenizers``."""
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(tokenizer))

    def slow(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids

    if not ranks:
        return slow
    import tiktoken

    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    special = [t.content for t in exact.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        return slow(text) if any(s in text for s in special) else fast.encode_ordinary(text)

    return encode


PIECES = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    separator: int = SEPARATOR,
    tokenizer: str = TOKENIZER,
    ranks: str | None = RANKS,
) -> DataFrame:
    """Each document's whole sequences and its left-over piece."""
    slim = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks)
        for batch in batches:
            rows, starts, lengths, sums, totals = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = encode(text.as_py())
                ids.append(separator)
                raw, n = np.array(ids, dtype="<u4").tobytes(), len(ids)
                for start in range(0, n, length):
                    part = raw[start * ID_BYTES : (start + length) * ID_BYTES]
                    rows.append(i)
                    starts.append(start)
                    lengths.append(len(part) // ID_BYTES)
                    sums.append(zlib.crc32(part))
                    totals.append(n)
            numbers = [pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals)]
            keys = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [keys, *numbers], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    return slim.mapInArrow(cut, PIECES.format(kind=slim.schema["doc_id"].dataType.simpleString()))


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; the longest come first, equal ones in the order given."""
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    # A heap-ordered tree: node k has children 2k and 2k + 1, bins are the leaves.
    free = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        need, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if free[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - free[node]
        free[node] -= need
        while node > 1:
            node //= 2
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
    return bins, offsets


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    separator: int = SEPARATOR,
    group_pieces: int = GROUP_PIECES,
    seed: int = 7,
    tokenizer: str = TOKENIZER,
    ranks: str | None = RANKS,
) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``; sequences hold ``length`` ids at most."""
    cut = pieces(docs, key, text, length, separator, tokenizer, ranks)
    # A number per row tells equal pieces apart; written down, it stays the same.
    stored = materialize(cut.withColumn("piece", F.monotonically_increasing_id()), "pack-pieces")
    loose = stored.filter(F.col("length") < length)
    count = loose.count()
    groups = max(1, -(-count // group_pieces))
    # Bins of a group are fewer than its pieces, so a stride of the group's count keeps ids apart.
    dealt = loose.withColumn("bin_group", F.pmod(F.xxhash64(F.lit(seed), "piece"), F.lit(groups)))
    kind = stored.schema["doc_id"].dataType.simpleString()
    schema = PIECES.format(kind=kind) + ", sequence_id long, offset long"

    def fill(part: pa.Table) -> pa.Table:
        part = part.sort_by("piece")
        bins, offsets = first_fit_decreasing(part["length"].to_numpy(), length)
        ids = 2 * (bins * groups + part["bin_group"].to_numpy())
        part = part.drop_columns(["piece", "bin_group"])
        return part.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))

    packed = dealt.groupBy("bin_group").applyInArrow(fill, schema)
    # Whole sequences have the odd numbers, packed ones the even.
    whole = stored.filter(F.col("length") == length).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (2 * F.col("piece") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return whole.unionByName(packed)
