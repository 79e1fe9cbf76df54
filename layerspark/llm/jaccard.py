"""Documents linked by the Jaccard similarity of their word n-grams.

A document's set holds the hashes of its distinct ``shingle``-word sequences. Sets that
can link share enough of their first tokens in a common order, the prefix. Tokens come
in classes by the number of sets they are in: a rare token (class 1) is a signature of
its own, tokens of class 2 and 3 only count as pairs and triples, so that a frequent
token alone makes no candidates. A shared class-k combination needs k shared tokens,
hence the prefix is extended until

    sum over groups of max(0, tokens in the group - (k - 1))  >=  size - overlap + 1,

the number of tokens a partner may lack, plus one. Then two sets that link share a
signature: with none shared, at most k - 1 tokens of each group of the shorter prefix
are common, and what is left cannot make up the overlap. Combinations are formed within
groups of each class, by hash, whose number follows the prefix of the set's size band;
this keeps combinations linear in the prefix. Signatures meet within a band only, and a
set close above a band's lower end is listed in the band below too.

Order and classes: tokens of a band's zone come first, rare ones before frequent ones,
then the others by hash. The zone is every token for bands below ``WHOLE``, else the
hashes below ``ZONE``. Only tokens of a zone are counted, over all distinct sets. ``FREQUENT`` tokens at most, the most frequent, are of class 2 or 3, which
bounds what is broadcast; the rest are single tokens. Classes decide how much work is
done, never which pairs are found.

Equal sets are one class of copies. Sets with a common signature are not paired with
each other: each meets the signature's first set (a star), and that settles groups of
near copies of any size in linear work. Where a signature still holds sets of different
components, they meet one more set of it, drawn by hash, ``MORE_STARS`` times at most and
as long as each time settles half of the rows; of signatures of the same sets one is kept. What is left in different components is screened in blocks,
by parities, so that only pairs with room for a link become rows; sets of the largest
component of a signature meet the others only. Pairs whose sizes alone rule a link out are
not compared.

A set also has parities: its tokens are dealt to buckets by hash, one bit a bucket says
whether it holds an odd number of them. Each token that only one of two sets holds flips
one bit, so the bits that differ are a lower bound of the tokens not shared. Pairs that
cannot link by this bound are settled on these few bytes. All others are compared
exactly, on whole sets rebuilt from their texts.

Defined results: null, empty and blank texts have no set and link with nothing, not even
each other; texts shorter than a shingle have their word sequence as the only token.
Repeated rows, copies and texts that differ only in case or white space are one class.
The component is named by its smallest key that is not null; null when there is none.
Columns beside key and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerspark.llm.common import join_spread, most_frequent, text_or_empty
from layerspark.llm.graph import components
from layerspark.session import BROADCAST_ROWS, discard, materialize, materialize_observed

SHINGLE = 3
PERCENT = 90
SEED = 42
# Least similarity for which every set has enough tokens for combinations.
LEAST_PERCENT = 80
# Hashes of the zone, as a part of 2 ** 64; small sets have too few of them and use all.
ZONE = 3 << 60
WHOLE = 192
# Sets that a token of class 2, and of class 3, is in at least.
CLASS_SETS = (3, 129)
FREQUENT = 1 << 18
# Partners of one set compared in one piece, and sets of one signature paired in one piece.
PIECE = 256
# Stars of a signature beyond its first.
MORE_STARS = 2
# Sets of one signature beyond which they are screened in blocks, and the side of a block.
BLOCK_FROM, BLOCK = 4, 4096
# Parity bits of a set, by its size; beyond that many the bound is looser, never wrong.
LEAST_BITS, MOST_BITS = 64, 1 << 15
# Distances are quotients of counts far below 2 ** 40.
ROUNDING = 1e-9

Batches = Iterator[pa.RecordBatch]
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def token_set(text: str, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Sorted hashes of the distinct word sequences; case and white space as in ASCII."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(words) < shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else [], dtype=np.uint64)
    each = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))
    count = len(words) - shingle + 1
    mixed = each[:count]
    for i in range(1, shingle):
        mixed = scrambled(mixed * MULTIPLIERS[i % 3] + each[i : i + count])
    return np.unique(scrambled(mixed))


def prefix_size(n: int, percent: int) -> int:
    """Tokens a partner may lack, plus one."""
    return n + percent * n // -100 + 1


def band_start(n: int) -> int:
    """Least size of n's band: a power of two, or one and a half times one."""
    power = 1 << (n.bit_length() - 1)
    return power + power // 2 if power > 1 and n >= power + power // 2 else power


def bands(n: int, percent: int) -> set[int]:
    """Bands of a set and of its smallest possible partner."""
    return {band_start(n), band_start(-(percent * n // -100))}


def group_count(n: int, percent: int) -> int:
    return 1 << max(0, (prefix_size(n, percent) // 4).bit_length() - 1)


def zone_tokens(tokens: np.ndarray, band: int) -> int:
    """How many of the sorted tokens lie in the band's zone."""
    return len(tokens) if band < WHOLE else int(np.searchsorted(tokens, np.uint64(ZONE)))


def head_size(n: int, percent: int) -> int:
    """Tokens that hold the prefix in any order of classes: a group costs one token, or two."""
    return min(n, prefix_size(n, percent) + 3 * group_count(n, percent))


def parities(tokens: np.ndarray) -> bytes:
    """A bit per bucket of hashes: whether the bucket holds an odd number of tokens."""
    width = min(MOST_BITS, max(LEAST_BITS, 1 << len(tokens).bit_length()))
    buckets = (tokens & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(buckets, minlength=width) & 1, bitorder="little").tobytes()


def least_apart(one: bytes, two: bytes) -> int:
    """Lower bound of the tokens in one set only, from the parities of both."""
    few, many = sorted((one, two), key=len)
    bits, width = int.from_bytes(many, "little"), 8 * len(many)
    while width > 8 * len(few):
        # Buckets by one hash bit less: each takes in the one half the width away.
        width //= 2
        bits = (bits ^ (bits >> width)) & ((1 << width) - 1)
    return (bits ^ int.from_bytes(few, "little")).bit_count()


def can_link(n: Column | int, percent: int) -> Column | bool:
    """Whether a set of n tokens can link with a different set at all."""
    return (n + 1) * percent <= n * 100


ROW = "doc_id {kind}, n_shingles long, d1 long, d2 long, t1 long, t2 long, head array<long>, bits binary"


def described(docs: DataFrame, key: str, text: str, percent: int, shingle: int, seed: int) -> DataFrame:
    """One row per document: size and digest of its set, digest of its text, first tokens; written once."""
    slim = _keyed_texts(docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text")))

    def describe(batches: Batches) -> Batches:
        for batch in batches:
            sizes, digests, heads, bits = [], [], [], []
            for text in batch.column(1):
                tokens = token_set(text.as_py(), shingle, seed)
                n = len(tokens)
                raw = xxhash.xxh3_128_digest(tokens.tobytes())
                sizes.append(n)
                digests.append(np.frombuffer(raw, dtype="<i8"))
                cut = 0
                if can_link(n, percent):
                    cut = max(zone_tokens(tokens, min(bands(n, percent))), head_size(n, percent))
                heads.append(tokens[:cut].view(np.int64))
                bits.append(parities(tokens) if cut else b"")
            offsets = np.cumsum([0, *map(len, heads)], dtype=np.int32)
            digest = np.array(digests, dtype=np.int64).reshape(-1, 2)
            flat = pa.array(np.concatenate([*heads, np.zeros(0, dtype=np.int64)]))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1])]
            columns += [batch.column(2), batch.column(3), pa.ListArray.from_arrays(pa.array(offsets), flat)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(bits, pa.binary())],
                names=["doc_id", "n_shingles", "d1", "d2", "t1", "t2", "head", "bits"],
            )

    made = slim.mapInArrow(describe, ROW.format(kind=slim.schema["doc_id"].dataType.simpleString()))
    return materialize(made.withColumn("row", F.monotonically_increasing_id()), "jaccard-rows")


def _keyed_texts(docs: DataFrame) -> DataFrame:
    return docs.withColumns({f"t{i}": F.xxhash64(F.lit(i), "text") for i in (1, 2)})


def frequent_tokens(sets: DataFrame, limits: tuple[int, int] = CLASS_SETS, most: int = FREQUENT) -> tuple:
    """Sorted tokens of class 2 and 3, and their classes; ``most`` of them at most."""
    in_zone = F.filter("head", lambda h: (F.col("n_shingles") < WHOLE) | ((h >= 0) & (h < F.lit(ZONE))))
    counts = sets.select(F.explode(in_zone).alias("token")).groupBy("token").count()
    counts = materialize(counts.filter(F.col("count") >= limits[0]), "jaccard-frequent")
    # As Arrow: as many Row objects would take many times the memory in the driver.
    rows = most_frequent(counts, most).orderBy("token").toArrow()
    tokens = rows["token"].to_numpy().astype(np.int64).view(np.uint64)
    return tokens, np.where(rows["count"].to_numpy() >= limits[1], 3, 2).astype(np.int64)


def classes_of(tokens: np.ndarray, known: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.ones(len(tokens), dtype=np.int64)
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    return np.where(known[at] == tokens, kinds[at], 1)


def signatures(head: np.ndarray, kinds: np.ndarray, zone: int, need: int, groups: int) -> list[np.ndarray]:
    """Signatures of the shortest sufficient prefix.

    ``head`` is sorted by hash, ``kinds`` are its classes, the first ``zone`` of it lie in the zone.
    """
    order = np.concatenate([np.argsort(kinds[:zone], kind="stable"), np.arange(zone, len(head))])
    kinds = np.concatenate([kinds[:zone], np.ones(len(head) - zone, dtype=np.int64)])
    head, kinds = head[order], kinds[order]
    group = kinds * groups + (head >> np.uint64(5)).astype(np.int64) % groups
    # Place of each token within its group, in prefix order.
    by_group = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.diff(group[by_group], prepend=-1))
    place = np.empty(len(head), dtype=np.int64)
    place[by_group] = np.arange(len(head)) - np.repeat(starts, np.diff(np.append(starts, len(head))))
    counts = np.cumsum((kinds == 1) | (place >= kinds - 1))
    cut = int(np.searchsorted(counts, need)) + 1
    head, kinds, group = head[:cut], kinds[:cut], group[:cut]
    out = [head[kinds == 1]]
    for one in np.unique(group[kinds > 1]):
        members, k = head[group == one], int(one) // groups
        if len(members) >= k:
            chosen = members[np.array(list(combinations(range(len(members)), k)))]
            mixed = chosen[:, 0]
            for i in range(1, k):
                mixed = scrambled(mixed * MULTIPLIERS[i] + chosen[:, i])
            out.append(scrambled(mixed))
    return out


def set_signatures(n: int, head: np.ndarray, kinds: np.ndarray, percent: int) -> np.ndarray:
    """Distinct signatures of a set of n tokens, in each of its bands."""
    found = []
    for band in bands(n, percent):
        zone = zone_tokens(head, band)
        parts = signatures(head, kinds, zone, prefix_size(n, percent), group_count(band, percent))
        found += [scrambled(p ^ (np.array([band], dtype=np.uint64) * MULTIPLIERS[0])) for p in parts]
    return np.unique(np.concatenate(found))


def signature_rows(sets: DataFrame, known: np.ndarray, kinds: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """``sig, id, n`` of every signature of every set; the frequent tokens are broadcast."""
    shared = sets.sparkSession.sparkContext.broadcast((known, kinds))

    def sign(batches: Batches) -> Batches:
        tokens, token_kinds = shared.value
        for batch in batches:
            ids, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            counts, found = [], []
            for n, head in zip(sizes.tolist(), batch.column(2)):
                mine = head.values.to_numpy(zero_copy_only=False).view(np.uint64)
                found.append(set_signatures(n, mine, classes_of(mine, tokens, token_kinds), percent))
                counts.append(len(found[-1]))
            flat = np.concatenate([*found, np.zeros(0, dtype=np.uint64)]).view(np.int64)
            columns = [pa.array(flat), pa.array(np.repeat(ids, counts)), pa.array(np.repeat(sizes, counts))]
            yield pa.RecordBatch.from_arrays(columns, names=["sig", "id", "n"])

    slim = sets.select(F.col("row").alias("id"), "n_shingles", "head")
    return slim.mapInArrow(sign, "sig long, id long, n long")


class Candidates:
    """Comparison of pairs of sets: by parities, then exactly from the texts of those left.

    ``parities`` is a stored table of ``id, n, bits``.
    """

    def __init__(
        self, docs: DataFrame, text: str, rows: DataFrame, parities: DataFrame, percent: int, shingle: int, seed: int
    ):
        self.docs = _keyed_texts(docs.select(text_or_empty(text).alias("text")))
        self.rows, self.parities = rows, parities
        self.percent, self.shingle, self.seed = percent, shingle, seed

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """``a, b, distance, open``: a lower bound, and whether it leaves room for a link; written once."""
        pairs = materialize(pairs, "jaccard-pairs")
        sides = [self.parities.withColumnsRenamed({"id": s, "n": f"n_{s}", "bits": f"bits_{s}"}) for s in "ab"]
        counts = pairs.groupBy("a").agg(F.count("*").alias("partners")).join(sides[0], "a")
        counts, seen = materialize_observed(counts, "jaccard-partners", pairs=F.sum("partners"))
        met = join_spread(pairs, counts, ["a"], "partners", seen["pairs"] or 0).join(sides[1], "b")
        percent = self.percent

        def bound(batches: Batches) -> Batches:
            for batch in batches:
                ones, twos = batch.column(4).to_pylist(), batch.column(5).to_pylist()
                apart = np.fromiter(map(least_apart, ones, twos), dtype=np.int64, count=len(ones))
                n, m = (batch.column(i).to_numpy() for i in (2, 3))
                apart = np.maximum(apart, np.abs(n - m))
                # Twice the sizes of union and intersection, if no more tokens differ.
                either, same = n + m + apart, n + m - apart
                columns = [*batch.columns[:2], pa.array(2 * apart / either), pa.array(100 * same >= percent * either)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "distance", "open"])

        slim = met.select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
        found = materialize(slim.mapInArrow(bound, "a long, b long, distance double, open boolean"), "jaccard-bounded")
        discard(pairs, counts)
        return found

    def texts(self, ids: DataFrame) -> DataFrame:
        """``id, text`` of the given ids; of copies of a text one row."""
        keys = ["t1", "t2"]
        wanted = self.rows.select(F.col("row").alias("id"), *keys).join(ids, "id")
        wanted, seen = materialize_observed(wanted, "jaccard-wanted", rows=F.count(F.lit(1)))
        if seen["rows"] <= BROADCAST_ROWS:
            joined = self.docs.join(F.broadcast(wanted), keys)
        else:
            copies = self.rows.groupBy(*keys).agg(F.count("*").alias("copies"))
            joined = join_spread(self.docs, wanted.join(copies, keys), keys, "copies", self.rows.count())
        texts = materialize(joined.select("id", "text").dropDuplicates(["id"]), "jaccard-texts")
        discard(wanted)
        return texts

    def compared(self, pairs: DataFrame) -> DataFrame:
        """``a, b, distance, linked`` of each pair, written once.

        The distance is exact where the parities left room for a link, else their lower bound.
        """
        bounds = self.bounded(pairs)
        far = bounds.filter("NOT open").select("a", "b", "distance", F.lit(False).alias("linked"))
        pairs = bounds.filter("open").select("a", "b")
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        texts = self.texts(ids)
        # A set with many partners meets them in pieces.
        counts = pairs.groupBy("a").agg(F.count("*").alias("partners"))
        counts = counts.withColumn("pieces", F.ceil(F.col("partners") / PIECE))
        counts, seen = materialize_observed(counts, "jaccard-partners", pairs=F.sum("partners"))
        split = join_spread(pairs, counts, ["a"], "partners", seen["pairs"] or 0)
        split = split.withColumn("piece", F.pmod(F.xxhash64("b"), F.col("pieces")))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))
        left = counts.join(texts.withColumnRenamed("id", "a"), "a").withColumn("piece", every)
        right = split.join(texts.withColumnRenamed("id", "b"), "b")
        # The set that a piece's partners meet comes first in the piece.
        rows = right.select("a", "piece", "b", "text").unionByName(
            left.select("a", "piece", F.lit(None).cast("long").alias("b"), "text")
        )
        rows = rows.repartition("a", "piece").sortWithinPartitions("a", "piece", F.asc_nulls_first("b"))
        shingle, seed, percent = self.shingle, self.seed, self.percent

        def compare(batches: Batches) -> Batches:
            mine = np.zeros(0, dtype=np.uint64)
            for batch in batches:
                out = []
                for a, b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                    tokens = token_set(text.as_py(), shingle, seed)
                    if b is None:
                        mine = tokens
                        continue
                    same = len(np.intersect1d(mine, tokens, assume_unique=True))
                    out.append((a, b, same, len(mine) + len(tokens) - same))
                ones, twos, same, either = np.array(out, dtype=np.int64).reshape(-1, 4).T
                columns = [ones, twos, 1 - same / either, 100 * same >= percent * either]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns)], names=["a", "b", "distance", "linked"]
                )

        made = rows.select("a", "b", "text").mapInArrow(
            compare, "a long, b long, distance double, linked boolean"
        )
        found = materialize(made, "jaccard-compared")
        discard(texts, counts)
        return found.unionByName(far)


def size_distance(a: str, b: str) -> Column:
    """Least Jaccard distance that two set sizes allow."""
    return 1 - F.least(a, b) / F.greatest(a, b)


def pairs_within(items: DataFrame, group: str, item: str, columns: list[str], keep: Column, piece: int = PIECE) -> DataFrame:
    """Distinct pairs ``a < b`` of items of a group that pass ``keep``, a condition on ``a_`` and ``b_`` columns.

    A large group is dealt into pieces by hash, and every two pieces meet in a key of
    their own, so no task holds more than two pieces.
    """
    sizes = items.groupBy(group).agg(F.count("*").alias("items")).filter("items > 1")
    sizes = sizes.withColumn("pieces", F.ceil(F.col("items") / piece))
    dealt = join_spread(items, sizes, [group], "items", items.count())
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64(item), F.col("pieces")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))
    meeting = [F.least("piece", "other").alias("p"), F.greatest("piece", "other").alias("q")]
    sent = dealt.withColumn("other", other).select(group, item, *columns, "piece", *meeting)

    def side(name: str) -> DataFrame:
        named = {c: f"{name}_{c}" for c in (*columns, "piece")}
        return sent.withColumnsRenamed({item: name, **named})

    met = side("a").join(side("b"), [group, "p", "q"]).filter("a < b AND (p = q OR a_piece <> b_piece)")
    return met.filter(keep).select("a", "b").distinct()


def folded(bits: list[bytes]) -> np.ndarray:
    """Parities of several sets as rows of words, all by the hash bits of the smallest set."""
    words = [np.frombuffer(one, dtype=np.uint64) for one in bits]
    least = min(map(len, words))
    return np.array([np.bitwise_xor.reduce(one.reshape(-1, least), axis=0) for one in words])


def block_pairs(items: DataFrame, reach: float, side: int = BLOCK, parities: DataFrame | None = None) -> DataFrame:
    """Distinct pairs ``a < b`` of sets of a signature that their parities leave room for.

    ``items`` has ``sig, centre, comp, centre_n, radius`` and ``items``, the number of sets
    of the signature. ``parities`` has ``centre, bits``; without it ``items`` holds the bits.
    Small signatures with sets of about the same size share a block, all those with the same
    first set the same one, so that sets with many signatures in common meet in few blocks.
    Of a large one, the sets of its largest component are dealt into pieces by hash, and all
    others too; every two pieces that can hold a pair are a block of their own. A task holds
    one block at a time, where each set comes once with its bits and all its signatures. Only
    pairs that pass leave it.
    """
    if parities is None:
        parities = items.select("centre", "bits").dropDuplicates(["centre"])
    if "first" not in items.columns:
        items = items.join(items.groupBy("sig").agg(F.min("centre").alias("first"), F.min("centre_n").alias("least_n")), "sig")
    total = items.count()
    columns = ["sig", "piece", "centre", "comp", "centre_n", "radius"]
    top = items.filter(F.col("items") > side).groupBy("sig", "comp").agg(F.count("*").alias("top"))
    top = top.groupBy("sig").agg(F.max_by("comp", "top").alias("top_comp"), F.max("top").alias("top"))
    large = join_spread(items, materialize(top, "jaccard-top"), ["sig"], "top", total)
    pieces = F.ceil((F.col("items") - F.col("top")) / side), F.ceil(F.col("top") / side)
    large = large.withColumns({"others": pieces[0], "tops": pieces[1], "is_top": F.col("comp") == F.col("top_comp")})
    own = F.pmod(F.xxhash64("centre"), F.when(F.col("is_top"), F.col("tops")).otherwise(F.col("others")))
    large = large.withColumn("piece", own + F.when(F.col("is_top"), F.col("others")).otherwise(0))
    last = F.when(F.col("is_top"), F.col("others")).otherwise(F.col("others") + F.col("tops")) - 1
    every = F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last))
    large = large.withColumn("other", F.explode(every))
    meeting = F.least("piece", "other").alias("p"), F.greatest("piece", "other").alias("q")
    sent = large.select(F.col("sig").alias("block"), *meeting, *columns)

    small = items.filter(F.col("items") <= side)
    # Small signatures of one octave of sizes, as many as make about a block.
    shared = F.xxhash64(F.floor(F.log2("least_n")), F.pmod(F.xxhash64("first"), F.lit(-(-total // side) or 1)))
    zero = F.lit(0).cast("long")
    block = F.when(F.col("items") <= side // 16, shared).otherwise(F.col("sig")).alias("block")
    sent = sent.unionByName(small.select(block, zero.alias("p"), zero.alias("q"), "sig", zero.alias("piece"), *columns[2:]))
    # One row per block and set; hashing by the set serves the join with its bits too.
    place = ["centre", "block", "p", "q", "piece"]
    once = [F.first(c).alias(c) for c in ("comp", "centre_n", "radius")]
    sent = sent.repartition("centre").groupBy(*place).agg(F.collect_list("sig").alias("sigs"), *once)
    sent = sent.join(parities.select("centre", "bits"), "centre")

    def screen(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        piece, ids, comp, n, radius = (block[c].to_numpy() for c in ("piece", "centre", "comp", "centre_n", "radius"))
        words = folded(block["bits"].to_pylist())
        first, last = block["p"][0].as_py(), block["q"][0].as_py()
        sigs = block["sigs"].combine_chunks()
        sig, at = sigs.flatten().to_numpy(), np.repeat(np.arange(len(ids)), sigs.value_lengths().to_numpy())
        order = np.lexsort((n[at], comp[at], sig))
        found = [np.zeros((2, 0), dtype=np.int64)]
        for group in np.split(at[order], np.flatnonzero(np.diff(sig[order])) + 1):
            right = group[piece[group] == last]
            # Within one piece, each set meets those of later components.
            after = np.searchsorted(comp[right], comp[right], side="right")
            for place, i in enumerate(group[piece[group] == first]):
                js = right[after[place] :] if first == last else right[comp[right] != comp[i]]
                gap = np.abs(n[js] - n[i])
                js = js[2 * gap / (n[js] + n[i] + gap) <= radius[js] + radius[i] + reach + ROUNDING]
                if not len(js):
                    continue
                apart = np.bitwise_count(words[js] ^ words[i]).sum(axis=1, dtype=np.int64)
                apart = np.maximum(apart, np.abs(n[js] - n[i]))
                js = js[2 * apart / (n[js] + n[i] + apart) <= radius[js] + radius[i] + reach + ROUNDING]
                found.append(np.sort(np.stack([np.full(len(js), ids[i]), ids[js]]), axis=0))
        a, b = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.table({"a": a, "b": b})

    return sent.groupBy("block", "p", "q").applyInArrow(screen, "a long, b long").distinct()


def _named(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with ``comp``, the component of ``id``; ``roots`` as ``components`` returns them."""
    roots = roots.select(F.col("node").alias("id"), F.col("root"))
    return members.join(roots, "id", "left").withColumn("comp", F.coalesce("root", "id")).drop("root")


def stars(signed: DataFrame, reach: float) -> tuple[DataFrame, DataFrame]:
    """The members of each signature but its first, and the pairs ``a, b`` of first and member."""
    buckets = signed.groupBy("sig").agg(
        F.min("id").alias("lead"), F.min_by("n", "id").alias("lead_n"), F.count("*").alias("members")
    )
    buckets = materialize(buckets.filter("members > 1"), "jaccard-buckets")
    members = join_spread(signed, buckets, ["sig"], "members", signed.count()).filter("id <> lead")
    members = materialize(members, "jaccard-members")
    discard(buckets)
    pairs = members.filter(size_distance("lead_n", "n") <= reach + ROUNDING)
    return members, pairs.select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()


def next_stars(rest: DataFrame, reach: float, turn: int) -> tuple[DataFrame, DataFrame]:
    """The sets of each signature but one drawn by hash, and that one's pairs with other components."""
    drawn = F.xxhash64(F.lit(turn), "id")
    lead = [F.min_by(c, drawn).alias(f"lead_{c}") for c in ("id", "n", "comp")]
    buckets = materialize(rest.groupBy("sig").agg(*lead, F.count("*").alias("members")), "jaccard-buckets")
    members = join_spread(rest.drop("members"), buckets, ["sig"], "members", rest.count()).filter("id <> lead_id")
    members = materialize(members.drop("members"), "jaccard-members")
    discard(buckets)
    pairs = members.filter((F.col("comp") != F.col("lead_comp")) & (size_distance("lead_n", "n") <= reach + ROUNDING))
    return members, pairs.select(F.least("lead_id", "id").alias("a"), F.greatest("lead_id", "id").alias("b")).distinct()


def unsettled(members: DataFrame, roots: DataFrame) -> tuple[DataFrame, int, int]:
    """Signatures that still hold different components, and how many rows were looked at and are left.

    The rows are ``sig, id, n, comp`` with the number, first and least size of the signature's
    ``members``; of signatures of the same sets one is kept.
    """
    named = _named(members.select("sig", "id", "n"), roots)
    named, seen = materialize_observed(named, "jaccard-named", rows=F.count(F.lit(1)))
    digest = [F.bit_xor(F.xxhash64(F.lit(i), "id")).alias(f"x{i}") for i in (1, 2)]
    known = [F.count("*").alias("members"), F.min("id").alias("first"), F.min("n").alias("least_n")]
    mixed = named.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), *known, *digest)
    mixed = mixed.filter("low < high").groupBy("members", "first", "least_n", "x1", "x2").agg(F.min("sig").alias("sig"))
    mixed, left = materialize_observed(
        mixed.select("sig", "members", "first", "least_n"), "jaccard-open", rows=F.sum("members")
    )
    rest = materialize(join_spread(named, mixed, ["sig"], "members", seen["rows"]), "jaccard-rest")
    discard(named)
    return rest, seen["rows"], left["rows"] or 0


def links(signed: DataFrame, candidates: Candidates) -> DataFrame:
    """Links ``a, b`` that connect all sets which link; ``signed`` is a stored table of ``sig, id, n``."""
    reach = 1 - candidates.percent / 100
    members, pairs = stars(signed, reach)
    measured = candidates.compared(pairs)
    linked = measured.filter("linked").select("a", "b")
    for turn in range(MORE_STARS + 1):
        roots = components(linked)
        # A star around each root links the same sets and settles in fewer rounds.
        linked = roots.select(F.col("root").alias("a"), F.col("node").alias("b")).filter("a < b")
        rest, looked_at, left = unsettled(members, roots)
        discard(members)
        if not left:
            return linked
        if turn == MORE_STARS or 2 * left > looked_at:
            break
        members, pairs = next_stars(rest.drop("first", "least_n"), reach, turn)
        new = candidates.compared(pairs.join(measured, ["a", "b"], "left_anti"))
        measured = measured.unionByName(new)
        linked = linked.unionByName(new.filter("linked").select("a", "b"))

    # Sets of one signature, but of different components.
    sizes = rest.withColumnsRenamed({"id": "centre", "n": "centre_n", "members": "items"})
    few, many = sizes.filter(F.col("items") <= BLOCK_FROM), sizes.filter(F.col("items") > BLOCK_FROM)
    room = size_distance("a_centre_n", "b_centre_n") <= reach + ROUNDING
    between = pairs_within(few.select("sig", "centre", "comp", "centre_n"), "sig", "centre", ["comp", "centre_n"], (F.col("a_comp") != F.col("b_comp")) & room)
    bits = candidates.parities.select(F.col("id").alias("centre"), "bits")
    between = between.unionByName(block_pairs(many.withColumn("radius", F.lit(0.0)), reach, parities=bits)).distinct()
    last = candidates.compared(between.join(measured.select("a", "b"), ["a", "b"], "left_anti"))
    return linked.unionByName(last.filter("linked").select("a", "b"))


def join_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    shingle: int = SHINGLE,
    seed: int = SEED,
    limits: tuple[int, int] = CLASS_SETS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"the similarity must be {LEAST_PERCENT} to 100 percent")
    rows = described(docs, key, text, percent, shingle, seed)
    digest = ["d1", "d2"]
    copies = rows.filter("n_shingles > 0").groupBy(*digest).agg(
        F.min("row").alias("row"), F.min("doc_id").alias("least"), F.count("*").alias("copies")
    )
    copies = materialize(copies, "jaccard-classes")
    sets = rows.filter(can_link(F.col("n_shingles"), percent)).select("row", "n_shingles", "head", "bits")
    sets = materialize(sets.join(copies.select("row"), "row", "left_semi"), "jaccard-sets")
    slim = materialize(rows.drop("head", "bits"), "jaccard-slim")
    discard(rows)
    odd = materialize(sets.select(F.col("row").alias("id"), F.col("n_shingles").alias("n"), "bits"), "jaccard-parities")
    known, kinds = frequent_tokens(sets, limits)
    signed = materialize(signature_rows(sets, known, kinds, percent), "jaccard-signatures")
    discard(sets)
    found = materialize(links(signed, Candidates(docs, text, slim, odd, percent, shingle, seed)), "jaccard-links")
    discard(signed)
    named = _named(copies.withColumnRenamed("row", "id"), components(found))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = named.join(least, "comp").select(*digest, "component_id", "copies")
    slim = slim.select("doc_id", "n_shingles", *digest)
    linked = join_spread(slim.filter("n_shingles > 0"), named, digest, "copies", slim.count())
    alone = slim.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return linked.select(*columns).unionByName(alone.select(*columns))
