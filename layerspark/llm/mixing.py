"""Mixing sources to target weights by hierarchical budgeting, in built-in expressions only.

Sources hang in a tree of domain, language and source with a weight at every node.
A token budget flows down from the root. At each node the children share it by
weight, but none gets more than its subtree can give (its tokens times the epochs
allowed); what one child cannot take goes to its siblings first. Only when all
children are full does a subtree stay below its share, and as a subtree's limit is
the sum of its leaves', that shortage has then been handed to the siblings one
level higher before.

Each leaf reads its documents in an order seeded per epoch: whole epochs first, then
a prefix of one more epoch up to the exact number of tokens. The document at the
cut gives its first tokens only. Tokens are runs of characters other than white
space.

No shuffle moves a hot source: a leaf's cut is found from sums over slices of its
hash order, and only the slice that holds the cut is ordered row by row. The
children of one node are ordered in one task; their number is that of the tree's
nodes, not of documents.

Defined results: a null language or source is the leaf named by the empty string;
texts without tokens (null, empty, blank) are never drawn, as they add nothing.
Rows that repeat an id are documents of their own; ties in the order are broken by
id, tokens and text digest, and between equal rows by a number written beside them. A
weight of zero or less takes nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerspark.llm.common import SPACE_RUN, SPACES, computed_once, text_or_empty, word_count
from layerspark.session import broadcast_if_small, materialize

LEVELS = ("domain", "lang", "source")
SLICE_ROWS = 4096


@dataclass(frozen=True)
class Mixture:
    """Weights by name at each level (1 for names not listed) and the size of the mix.

    ``budget_percent`` is the budget as a share of all tokens; ``epochs`` the most
    often that a document is read.
    """

    domains: dict[str, int] = field(default_factory=dict)
    languages: dict[str, int] = field(default_factory=dict)
    sources: dict[str, int] = field(default_factory=dict)
    budget_percent: int = 100
    epochs: int = 2
    seed: str = "mix-1"

    def weight(self, level: str, name: Column) -> Column:
        table = {"domain": self.domains, "lang": self.languages, "source": self.sources}[level]
        out = F.lit(1)
        for key, value in table.items():
            out = F.when(name == key, F.lit(int(value))).otherwise(out)
        return out.cast("long")


# Four domains by source number stand in for a curated list; the languages' weights
# differ from their shares, so that some leaves fall short.
PRODUCTION = Mixture(
    domains={"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    languages={"en": 5, "de": 2, "fr": 2, "es": 1},
)


def source_domain(source: Column) -> Column:
    """``domain`` and the source's number modulo four; ``domain0`` without a number."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.concat(F.lit("domain"), F.when(number == "", 0).otherwise(number.cast("long") % 4))


def _share(nodes: DataFrame, parent: list[str], level: str) -> DataFrame:
    """Split each parent's ``given`` among its children: ``given`` becomes the child's own.

    With children in order of limit per weight, the level of water is the largest of
    (budget left) / (weight left) over all prefixes taken as full.
    """
    full_first = F.when(F.col("weight") > 0, F.col("can") / F.col("weight")).otherwise(F.lit(float("inf")))
    family = Window.partitionBy(*[F.col(p) for p in parent])
    earlier = family.orderBy(full_first, level).rowsBetween(Window.unboundedPreceding, -1)
    before = {c: F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in ("can", "weight")}
    nodes = nodes.withColumns({"can_before": before["can"], "weight_before": before["weight"]})
    nodes = nodes.withColumn("weight_all", F.sum("weight").over(family))
    left = F.col("weight_all") - F.col("weight_before")
    height = F.when((left > 0) & (F.col("weight") > 0), (F.col("given") - F.col("can_before")) / left)
    nodes = nodes.withColumn("height", F.max(height).over(family))
    own = F.least(F.col("can").cast("double"), F.coalesce("height", F.lit(0.0)) * F.col("weight"))
    return nodes.withColumn("given", F.greatest(own, F.lit(0.0)))


def leaf_budgets(sizes: DataFrame, mixture: Mixture) -> DataFrame:
    """``domain, lang, source, tokens, docs`` with each leaf's ``target`` in tokens.

    ``sizes`` is a stored table of the leaves.
    """
    tokens = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    given = None
    for depth, level in enumerate(LEVELS):
        keys = list(LEVELS[: depth + 1])
        nodes = sizes.groupBy(*keys).agg(
            (F.sum("tokens") * mixture.epochs).alias("can"), F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs")
        )
        nodes = nodes.withColumn("weight", F.greatest(mixture.weight(level, F.col(level)), F.lit(0).cast("long")))
        if given is None:
            on = ["root"]
            budget = float(tokens * mixture.budget_percent // 100)
            nodes = nodes.withColumns({"root": F.lit(0), "given": F.lit(budget)})
        else:
            on = keys[:-1]
            nodes = nodes.join(given, on)
        shared = _share(nodes, on, level)
        given = shared.select(*keys, "given", "tokens", "docs")
        if depth < len(LEVELS) - 1:
            given = given.drop("tokens", "docs")
    # The tiny addition undoes a product that fell just short of a whole number.
    return given.select(*LEVELS, "tokens", "docs", F.floor(F.col("given") + 1e-6).cast("long").alias("target"))


def _tree(docs: DataFrame, names: dict[str, str], domain: Column | None) -> dict[str, Column]:
    lang, source = (F.coalesce(F.col(f"`{names[c]}`").cast("string"), F.lit("")) for c in ("lang", "source"))
    return {"domain": source_domain(source) if domain is None else domain, "lang": lang, "source": source}


def draw(
    docs: DataFrame,
    mixture: Mixture = PRODUCTION,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    domain: Column | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per document and epoch it is read in: its leaf, ``epoch``, ``tokens`` and ``taken``.

    ``carry`` names columns of ``docs`` to return as well, as one struct ``row``.
    """
    body = text_or_empty(text)
    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(0)
    leaf = _tree(docs, {"lang": lang, "source": source}, domain)
    slim = docs.select(
        F.col(key).alias("doc_id"),
        *[c.alias(n) for n, c in leaf.items()],
        word_count(body).alias("tokens"),
        F.md5(body.cast("binary")).alias("digest"),
        F.monotonically_increasing_id().alias("number"),
        row.alias("row"),
    )
    slim = materialize(slim, "mix-docs").filter("tokens > 0")
    sizes = slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    leaves = materialize(leaf_budgets(materialize(sizes, "mix-leaves"), mixture), "mix-budgets")
    leaves = leaves.select(
        *LEVELS,
        F.expr("target div tokens").cast("int").alias("epochs"),
        (F.col("target") % F.col("tokens")).alias("rest"),
        F.ceil(F.col("docs") / SLICE_ROWS).cast("long").alias("slices"),
    ).filter("epochs > 0 or rest > 0")
    order = F.md5(F.concat_ws("/", F.lit(mixture.seed), "epochs", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    placed = slim.join(broadcast_if_small(leaves), list(LEVELS)).withColumn("place", order)
    head = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    placed = placed.withColumn("slice", F.shiftright(head * F.col("slices"), 32))
    placed = placed.withColumn("at", F.struct("place", "doc_id", "tokens", "digest", "number"))
    # The slice in which each leaf's last epoch ends, and the tokens before it.
    sums = placed.filter("rest > 0").groupBy(*LEVELS, "slice", "rest").agg(F.sum("tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy(*LEVELS).orderBy("slice"))
    cuts = sums.withColumn("upto", upto).filter("upto >= rest and upto - tokens < rest")
    cuts = materialize(cuts.select(*LEVELS, F.col("slice").alias("cut"), (F.col("upto") - F.col("tokens")).alias("gone")), "mix-cuts")
    # The last document read of that slice; only narrow columns are ordered.
    narrow = placed.drop("row").join(broadcast_if_small(cuts), list(LEVELS)).filter("slice = cut")
    within = Window.partitionBy(*LEVELS).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("gone") + F.coalesce(F.sum("tokens").over(within), F.lit(0))
    read = narrow.withColumn("before", before).filter("before < rest")
    edges = read.groupBy(*LEVELS).agg(F.max("at").alias("edge"), F.max("before").alias("before"))
    edges = materialize(edges, "mix-edges")
    drawn = placed.join(broadcast_if_small(edges), list(LEVELS), "left")
    once_more = F.coalesce(F.col("at") <= F.col("edge"), F.lit(False)).cast("int")
    drawn = drawn.withColumn("times", F.col("epochs") + once_more).filter("times > 0")
    drawn = drawn.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    at_edge = (F.col("epoch") == F.col("epochs")) & (F.col("at") == F.col("edge"))
    taken = F.when(at_edge, F.least("tokens", F.col("rest") - F.col("before"))).otherwise(F.col("tokens"))
    return drawn.select("doc_id", *LEVELS, "epoch", "tokens", taken.alias("taken"), *(["row"] if carry else []))


def token_prefix(text: Column, tokens: Column) -> Column:
    """The text up to the end of its first ``tokens`` tokens, white space between them kept."""
    start = F.ltrim(text, F.lit(SPACES))
    pieces = F.split(start, SPACE_RUN, tokens.cast("int") + 1)
    rest = F.when(F.size(pieces) > tokens, F.length(F.element_at(pieces, -1))).otherwise(0)
    return F.rtrim(F.left(start, F.length(start) - rest), F.lit(SPACES))


def mixed(
    docs: DataFrame,
    mixture: Mixture = PRODUCTION,
    key: str = "doc_id",
    text: str = "text",
    length: str | None = None,
    **names: str,
) -> DataFrame:
    """The drawn documents with the columns of ``docs``; those at a cut are shortened.

    ``length`` names a column that holds the text's length and follows it.
    """
    drawn = draw(docs, mixture, key, text, carry=docs.columns, **names)
    cut = F.col("taken") < F.col("tokens")
    shown = F.when(cut, token_prefix(F.col("row")[text], F.col("taken"))).otherwise(F.col("row")[text])
    final = computed_once(drawn, shown=shown)
    new = {text: F.col("shown")}
    if length:
        counted = F.length("shown").cast(docs.schema[length].dataType)
        new[length] = F.when(cut, counted).otherwise(F.col("row")[length])
    return final.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
