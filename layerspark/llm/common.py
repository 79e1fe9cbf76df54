"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
# A key with more than this part of all rows is hot; there are fewer such keys than that.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns that the optimizer neither repeats nor moves.

    A later filter on a plain projected column is pushed below the projection with
    a copy of the column's whole expression. Values out of a generator stay put.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The runs of characters other than ASCII white space; empty for none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, SPACE_RUN))


def word_count(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_RUN))).cast("long")


def most_frequent(counts: DataFrame, limit: int, count: str = "count") -> DataFrame:
    """The rows with the largest counts, ``limit`` at most, without sorting them.

    Counts are put into levels of a quarter of an octave; the lowest levels that would
    exceed the limit are left out whole. A sort with a limit would send that many rows of
    every partition to the driver.
    """
    level = F.floor(4 * F.log2(count)).cast("int")
    sizes = {r["level"]: r["n"] for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    least, total = None, 0
    for one in sorted(sizes, reverse=True):
        total += sizes[one]
        if total > limit:
            break
        least = one
    return counts.filter(level >= least) if least is not None else counts.limit(0)


def hashed_share(seed: int, *columns: str | Column, share: float) -> Column:
    """True for about ``share`` of the values, the same ones in every run."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def fresh_name(columns: list[str], wanted: str) -> str:
    """``wanted``, underscored until no column has that name (in any case)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def join_spread(rows: DataFrame, side: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """``rows`` joined with ``side``, whose ``count`` says how many rows have each key.

    Keys of more than a ``HOT_SHARE``-th of all ``total`` rows are fewer than
    ``HOT_SHARE``, so they are broadcast (``side`` must be narrow); no other key can
    fill a task.
    """
    hot = F.col(count) * HOT_SHARE > F.lit(total)
    named = side.withColumnsRenamed({k: f"side_{k}" for k in keys})
    few = F.broadcast(named.filter(hot))
    same = [F.col(k) == F.col(f"side_{k}") for k in keys]
    drop = [f"side_{k}" for k in keys]
    first = rows.join(few, same).drop(*drop)
    rest = rows.join(few.select(*drop), same, "left_anti")
    return first.unionByName(rest.join(named.filter(~hot), same).drop(*drop))
