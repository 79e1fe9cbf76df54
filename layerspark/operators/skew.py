"""Helpers for groups that may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerspark.session import BROADCAST_ROWS, materialize

# Largest group handed to one task as a whole.
GROUP_ROWS = 1_000_000
# percentile_approx is off by at most 1 / accuracy of all ranks.
BRACKET_ACCURACY = 100_000


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """Keys with more than ``limit`` rows and their row counts, or None if there are none.

    The counts are combined before the shuffle, and at most (rows / limit) keys can
    be hot. They are written once, as callers use them several times.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    return None if counts.isEmpty() else materialize(counts, "hot_keys")


def join_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", broadcast: bool = False
) -> DataFrame:
    """Join on the keys, where null equals null; the keys of the left side are kept."""
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    side = right.withColumnsRenamed(names)
    condition = F.lit(True)
    for k, name in names.items():
        condition = condition & F.col(k).eqNullSafe(F.col(name))
    joined = left.join(F.broadcast(side) if broadcast else side, condition, how)
    return joined if how in ("left_anti", "left_semi") else joined.drop(*names.values())


def split_hot(
    df: DataFrame, keys: Sequence[str], hot: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys, and rows of hot keys with the key's row count ``_n``.

    The hot keys are few (see ``hot_keys``) and broadcast once counted; were they
    many, AQE would split the overfull partitions of the joins.
    """
    few = hot.count() <= BROADCAST_ROWS
    cold = join_keys(df, hot.select(*keys), keys, "left_anti", broadcast=few)
    return cold, join_keys(df, hot, keys, broadcast=few)


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    group_rows: int = GROUP_ROWS,
    accuracy: int = BRACKET_ACCURACY,
    also: Sequence[Column] = (),
) -> DataFrame:
    """Exact percentiles with linear interpolation; null and NaN are left out.

    Ordinary groups use the built-in ``percentile``, whose buffer holds a group's
    distinct values, together with the ``also`` aggregates in one grouping. A
    group of more than ``group_rows`` values is ranked in two passes instead: see
    ``_bracketed``.
    """
    v = F.col(value).cast("double")
    valued = df.withColumn("_v", F.when(~F.isnan(v), v))
    known = valued.where(F.col("_v").isNotNull())
    hot = hot_keys(known, keys, group_rows)
    if hot is None:
        return _built_in(valued, keys, probs, names, also)
    # With more than "accuracy" rows in every hot group a bracket spans several ranks.
    accuracy = min(accuracy, group_rows)
    if not keys:
        n = hot.first()["_n"]
        ranked = _bracketed(known.select("_v", F.lit(n).alias("_n")), keys, probs, names, accuracy)
        return ranked.select(*names) if not also else _beside(valued.agg(*also), ranked, names)
    cold, _ = split_hot(valued, keys, hot)
    _, warm = split_hot(known.select(*keys, "_v"), keys, hot)
    few = hot.count() <= BROADCAST_ROWS
    ranked = _bracketed(warm, keys, probs, names, accuracy, few)
    if also:
        # A row per hot group on either side.
        extra = join_keys(valued, hot.select(*keys), keys, "left_semi", broadcast=few)
        ranked = join_keys(extra.groupBy(*keys).agg(*also), ranked, keys, broadcast=few)
    return _built_in(cold, keys, probs, names, also).unionByName(ranked)


def _beside(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Two one-row tables next to each other, without a join."""
    packed = right.select(F.struct(*names).alias("_r")).scalar()
    wide = left.withColumn("_r", packed)
    return wide.select(*left.columns, *[F.col(f"_r.{n}").alias(n) for n in names])


def _built_in(
    df: DataFrame,
    keys: Sequence[str],
    probs: Sequence[float],
    names: Sequence[str],
    also: Sequence[Column],
) -> DataFrame:
    ranks = F.percentile("_v", F.array(*[F.lit(float(p)) for p in probs])).alias("_p")
    packed = df.groupBy(*keys).agg(*also, ranks)
    kept = [c for c in packed.columns if c != "_p"]
    return packed.select(*kept, *[F.col("_p")[i].alias(n) for i, n in enumerate(names)])


def _bracketed(
    df: DataFrame,
    keys: Sequence[str],
    probs: Sequence[float],
    names: Sequence[str],
    accuracy: int,
    few: bool = True,
) -> DataFrame:
    """Percentiles of hot groups without bringing a whole group together.

    Pass one: approximate percentiles a little below and above each target give a
    bracket that surely holds the target rank. Pass two: rows inside a bracket
    are counted per value, all others only per gap between brackets, combined
    before the shuffle. The running count over this small table then finds the
    exact order statistics.
    """
    order = sorted(range(len(probs)), key=lambda i: probs[i])
    margin = 3.0 / accuracy
    wanted = []
    for i in order:
        wanted += [max(probs[i] - margin, 0.0), min(probs[i] + margin, 1.0)]
    bounds = df.groupBy(*keys).agg(
        F.percentile_approx(
            "_v", F.array(*[F.lit(p) for p in wanted]), F.lit(accuracy)
        ).alias("_b"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    )
    edges = []
    for j, p in enumerate(wanted):
        edge = F.col("_b")[j]
        edges.append(F.col("_min") if p <= 0 else F.col("_max") if p >= 1 else edge)
    packed = F.struct(*[e.alias(f"_e{j}") for j, e in enumerate(edges)]).alias("_e")
    if keys:
        # A row per hot group.
        tagged = join_keys(df, bounds.select(*keys, packed), keys, broadcast=few)
    else:
        tagged = df.withColumn("_e", bounds.select(packed).scalar())

    # A gap between two brackets counts under the upper edge of the bracket before it.
    seat = F.when(F.col("_v") < F.col("_e._e0"), F.lit(float("-inf")))
    for j in range(0, len(wanted), 2):
        seat = seat.when(
            (F.col("_v") >= F.col(f"_e._e{j}")) & (F.col("_v") <= F.col(f"_e._e{j + 1}")), F.col("_v")
        )
        if j + 2 < len(wanted):
            seat = seat.when(F.col("_v") < F.col(f"_e._e{j + 2}"), F.col(f"_e._e{j + 1}"))
    seat = seat.otherwise(F.col(f"_e._e{len(wanted) - 1}"))
    counted = (
        tagged.groupBy(*keys, "_n", seat.alias("_seat")).agg(F.count(F.lit(1)).alias("_c"))
    )
    running = Window.partitionBy(*keys, "_n").orderBy("_seat").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = counted.withColumn("_cum", F.sum("_c").over(running))
    picks, out = [], []
    for i, (p, name) in enumerate(zip(probs, names, strict=True)):
        place = F.col("_n").cast("double") - F.lit(1.0)
        place = place * F.lit(float(p))
        lower, upper = F.floor(place), F.ceil(place)
        picks.append(F.min(F.when(F.col("_cum") > lower, F.col("_seat"))).alias(f"_lo{i}"))
        picks.append(F.min(F.when(F.col("_cum") > upper, F.col("_seat"))).alias(f"_hi{i}"))
        share = place - lower
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((F.when(lower == upper, lo).otherwise(lo * (F.lit(1.0) - share) + hi * share)).alias(name))
    return ranked.groupBy(*keys, "_n").agg(*picks).select(*keys, *out)
