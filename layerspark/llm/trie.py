"""Conversation prefix trie with a depth-band rollup.

Every conversation is rebuilt from the first turns of its family's base and its own
later turns; each distinct sequence of first turns is a node. A node is known by the
XOR of its turns' 128-bit hashes, each hashed with its depth, so a prefix is a running
XOR and its parent's is one step back.

Sums over subtrees come from bands of ``band`` depths. Within a band, each node is
exploded to its ancestors there (the explosions along one conversation are summed
before they leave the row), which gives every node the sum of its subtree up to the
band's end. The nodes that open a band form a smaller trie whose depth is ``band``
times less: the same step on it completes their totals, and each completed total goes
to its ancestors in the band above. So a node is never exploded to more than ``band``
ancestors, and the number of rounds grows with the logarithm of the deepest
conversation. The running XOR crosses bands by the same recursion.

Nothing is gathered by conversation or node: the order of turns comes from one range
sort, a hot conversation spans many partitions, and of the joins that could meet a hot
key (turns to their conversation, nodes to a parent with very many children) the hot
keys, at most ``HOT_SHARE`` of them by their counts, are broadcast. The
SHA-256 of a node's ends needs one pass in order: a range sort first packs the ids into
blocks of ``BLOCK_IDS``, and only blocks are streamed through the digest, whose memory
does not grow.

Defined results: null role and text are empty; turns of equal number (null is lowest)
follow each other by a hash of role and text, and copies of a turn stay. Rows with a
null conversation id belong to none and are left out. Remainders have the sign of the
id. Columns beside the four are not read. An empty table gives an empty result, as the
root has no member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerspark.llm.common import join_spread, text_or_empty
from layerspark.operators.order import row_index
from layerspark.session import materialize

FAMILY = 5
HEAD_CHOICES = 9
BAND = 16
BLOCK_IDS = 4096

NODE = ["hi", "lo"]


def head_length(conv: Column) -> Column:
    """Turns that a conversation takes over from its base."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEAD_CHOICES).cast("long")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``conv, row_index, a, b, bytes``: turns numbered in order over the whole table, written once."""
    role, text = text_or_empty("role"), text_or_empty("text")
    slim = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), text, role).alias("b"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    # Copies of a turn are told apart by a number, so that a hot one can be split too.
    slim = slim.withColumn("copy", F.xxhash64(F.monotonically_increasing_id()))
    return row_index(slim, ["conv", "turn", "a", "b", "copy"], name="trie-turns").drop("turn", "copy")


def conversations(ordered: DataFrame) -> DataFrame:
    """One row per conversation: ``conv, first, turns, head, total``; ``head`` turns come from the base."""
    found = ordered.groupBy("conv").agg(F.min("row_index").alias("first"), F.count("*").alias("turns"))
    found = materialize(found, "trie-convs")
    base = F.col("conv") - F.col("conv") % FAMILY
    bases = found.select(F.col("conv").alias("base"), F.col("turns").alias("base_turns"))
    wide = found.withColumn("base", base).join(bases, "base", "left")
    taken = F.least(head_length(F.col("conv")), F.coalesce("base_turns", F.lit(0)))
    own = F.greatest(F.col("turns") - head_length(F.col("conv")), F.lit(0))
    return wide.select(
        "conv", "base", "first", "turns", taken.alias("head"), (taken + own).alias("total")
    )


def rebuilt(ordered: DataFrame, convs: DataFrame, rows: int) -> DataFrame:
    """Turns of the rebuilt conversations: ``conv, depth, last, a, b, bytes``; depth 0 is the root."""
    placed = join_spread(ordered, convs, ["conv"], "turns", rows)
    placed = placed.withColumn("nth", F.col("row_index") - F.col("first") + 1)
    skipped = F.when(F.col("conv") == F.col("base"), 0).otherwise(head_length(F.col("conv")))
    kept = F.when(F.col("conv") == F.col("base"), 0).otherwise(F.col("head"))
    own = placed.filter(F.col("nth") > skipped).withColumn("depth", F.col("nth") - skipped + kept)
    # A base lends at most its first HEAD_CHOICES - 1 turns to each of its relatives.
    lent = placed.filter((F.col("conv") == F.col("base")) & (F.col("nth") < HEAD_CHOICES)).select(
        F.col("base"), F.col("nth").alias("depth"), "a", "b", "bytes"
    )
    borrowers = convs.filter("conv != base AND head > 0").select("conv", "base", "head", "total")
    borrowed = lent.join(borrowers, "base").filter("depth <= head")
    root = convs.select(
        "conv",
        F.lit(0).cast("long").alias("depth"),
        (F.col("total") == 0).alias("last"),
        *[F.lit(0).cast("long").alias(c) for c in ("a", "b", "bytes")],
    )
    # Without the depth, equal turns would cancel out in an XOR.
    hashes = [F.xxhash64("a", "b", "depth").alias("a"), F.xxhash64("b", "depth", "a").alias("b")]
    columns = ["conv", "depth", (F.col("depth") == F.col("total")).alias("last"), *hashes, "bytes"]
    return own.select(*columns).unionByName(borrowed.select(*columns)).unionByName(root)


def running_xor(rows: DataFrame, deepest: int, band: int = BAND) -> DataFrame:
    """``rows`` with ``hi, lo``: the XOR of ``a`` and ``b`` over a conversation's depths up to here."""
    rows = rows.withColumn("band", F.floor(F.col("depth") / band))
    upto = Window.partitionBy("conv", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    here = rows.withColumns({"hi": F.bit_xor("a").over(upto), "lo": F.bit_xor("b").over(upto)})
    if deepest < band:
        return here.drop("band")
    # Bands are the steps of a conversation that is ``band`` times as short.
    whole = rows.groupBy("conv", "band").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    whole = whole.filter(F.col("band") < deepest // band).withColumnRenamed("band", "depth")
    before = running_xor(whole, deepest // band, band).select(
        "conv", (F.col("depth") + 1).alias("band"), F.col("hi").alias("hi0"), F.col("lo").alias("lo0")
    )
    joined = here.join(before, ["conv", "band"], "left")
    carried = {c: F.col(c).bitwiseXOR(F.coalesce(f"{c}0", F.lit(0))) for c in NODE}
    return joined.withColumns(carried).drop("band", "hi0", "lo0")


def band_sums(paths: DataFrame, values: list[str]) -> DataFrame:
    """Sums over each node's subtree within its band.

    A row of ``paths`` holds one conversation's nodes of one band, top first. Each node is
    exploded to itself and its ancestors there once, in the row of the conversation that
    owns it; a place of the row takes the sum of what is at or below it.
    """
    owned = F.filter("path", lambda s: s["owned"])

    def at_or_below(top: Column, value: str) -> Column:
        below = F.filter("path", lambda s: s["owned"] & (s["depth"] >= top["depth"]))
        return F.aggregate(below, F.lit(0).cast("long"), lambda acc, s: acc + s[value]).alias(value)

    per_place = F.transform(
        "path", lambda top: F.struct(*[top[c].alias(c) for c in NODE], *[at_or_below(top, v) for v in values])
    )
    exploded = paths.filter(F.size(owned) > 0).select(F.inline(per_place))
    return exploded.groupBy(*NODE).agg(*[F.sum(v).alias(v) for v in values])


def subtree_sums(steps: DataFrame, nodes: DataFrame, values: list[str], deepest: int, band: int = BAND) -> DataFrame:
    """``hi, lo`` and the sums of ``values`` over the subtree of each node.

    ``steps`` (``conv, depth, hi, lo``) are the nodes along each conversation;
    ``nodes`` (``hi, lo, owner`` and values) has each node once, owned by a conversation
    that runs through it, the same for all of a node's descendants on that conversation.
    """
    # A conversation passes a node once, so owner and node together are no hot key.
    marked = steps.join(
        nodes.withColumnRenamed("owner", "conv").withColumn("owned", F.lit(True)), ["conv", *NODE], "left"
    ).withColumn("owned", F.coalesce("owned", F.lit(False)))
    step = F.struct("depth", *NODE, "owned", *values)
    paths = marked.groupBy("conv", F.floor(F.col("depth") / band).alias("band")).agg(
        F.sort_array(F.collect_list(step)).alias("path")
    )
    # A path without a node of its own still leads down to those of later bands, if it is full.
    paths = materialize(
        paths.filter(F.exists("path", lambda s: s["owned"]) | (F.size("path") == band)), "trie-paths"
    )
    within = band_sums(paths, values)
    if deepest < band:
        return within
    within = materialize(within, "trie-band")
    # The nodes that open a band are a trie of their own.
    opening = paths.select(
        "conv", F.col("band").alias("depth"), F.element_at("path", 1).alias("top")
    ).select("conv", "depth", *[F.col("top")[c].alias(c) for c in NODE], F.col("top")["owned"].alias("owned"))
    tops = opening.filter("owned").select(F.col("conv").alias("owner"), "depth", *NODE).join(within, NODE)
    tops = materialize(tops, "trie-tops")
    done = subtree_sums(
        opening.select("conv", "depth", *NODE), tops.drop("depth"), values, deepest // band, band
    )
    done = tops.select("owner", "depth", *NODE).join(done, NODE)
    lifted = done.filter("depth > 0").select(
        F.col("owner").alias("conv"), (F.col("depth") - 1).alias("band"), *values
    )
    above = paths.select("conv", "band", F.transform("path", lambda s: F.struct(*[s[c].alias(c) for c in NODE])).alias("path"))
    given = lifted.join(above, ["conv", "band"]).select(F.inline("path"), *values)
    return within.unionByName(given).groupBy(*NODE).agg(*[F.sum(v).alias(v) for v in values])


def end_digests(ends: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``hi, lo, ends_sha256``: digest of the comma-joined ascending ids of each node in ``ends``."""
    ranged = ends.select(*NODE, "conv").repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        for batch in batches:
            out = []
            for hi, lo, conv in zip(*(column.to_pylist() for column in batch.columns)):
                if ids and (node != (hi, lo) or len(ids) == block_ids):
                    out.append((*node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = (hi, lo)
                ids.append(conv)
            yield _batch(out, ("hi", "lo", "first", "ids"))
        if ids:
            yield _batch([(*node, ids[0], ",".join(map(str, ids)))], ("hi", "lo", "first", "ids"))

    packed = ranged.mapInArrow(blocks, "hi long, lo long, first long, ids string")
    sorted_blocks = packed.repartition(*NODE).sortWithinPartitions(*NODE, "first")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            out = []
            for hi, lo, ids in zip(*(batch.column(c).to_pylist() for c in ("hi", "lo", "ids"))):
                if node == (hi, lo):
                    running.update(b"," + ids.encode())
                    continue
                if node:
                    out.append((*node, running.hexdigest()))
                node, running = (hi, lo), hashlib.sha256(ids.encode())
            yield _batch(out, ("hi", "lo", "ends_sha256"))
        if node:
            yield _batch([(*node, running.hexdigest())], ("hi", "lo", "ends_sha256"))

    return sorted_blocks.mapInArrow(digest, "hi long, lo long, ends_sha256 string")


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    kinds = [pa.string() if n in ("ids", "ends_sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=list(names))


def prefix_trie(turns: DataFrame, band: int = BAND, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per node of the trie over all rebuilt conversations."""
    ordered = ordered_turns(turns)
    convs = materialize(conversations(ordered), "trie-rebuilt-convs")
    rows, deepest = convs.agg(F.sum("turns"), F.max("total")).first()
    whole = rebuilt(ordered, convs, rows or 0)
    if (deepest or 0) >= band:
        # Read once for the steps of a band and once for the totals of bands.
        whole = materialize(whole, "trie-rebuilt")
    steps = materialize(running_xor(whole, deepest or 0, band), "trie-steps")
    nodes = steps.groupBy(*NODE).agg(
        F.min("conv").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.count("*").alias("n_convs"),
        F.max("bytes").alias("bytes"),
        F.max(F.col("hi").bitwiseXOR(F.col("a"))).alias("parent_hi"),
        F.max(F.col("lo").bitwiseXOR(F.col("b"))).alias("parent_lo"),
    )
    nodes = materialize(nodes, "trie-nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo"))
    counted = nodes.join(children.agg(F.count("*").alias("n_children")), NODE, "left")
    counted = materialize(counted.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-counted")
    weighed = counted.select(
        *NODE,
        F.col("conv_id").alias("owner"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    sums = subtree_sums(steps.select("conv", "depth", *NODE), weighed, ["n_leaves", "saved_tokens"], deepest or 0, band)
    ends = end_digests(steps.filter("last"), block_ids)
    full = counted.join(sums, NODE).join(ends, NODE, "left")
    parents = counted.filter("n_children > 0").select(
        F.col("hi").alias("parent_hi"),
        F.col("lo").alias("parent_lo"),
        F.col("conv_id").alias("parent_conv_id"),
        "n_children",
    )
    below = full.filter("depth > 0").withColumnRenamed("n_children", "children")
    below = join_spread(below, parents, ["parent_hi", "parent_lo"], "n_children", counted.count())
    below = below.drop("n_children").withColumnRenamed("children", "n_children")
    root = full.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return below.unionByName(root).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("n_children").cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
