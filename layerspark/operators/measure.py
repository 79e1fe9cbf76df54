"""Summaries of encoding runs and timing logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerspark.operators.skew import GROUP_ROWS, exact_percentiles

# Fixed value: a task longer than this many milliseconds counts as long.
LONG_TASK_MS = 50.0
PLAIN_MODE = "none"


def bench_summary(
    runs: DataFrame,
    by: Sequence[str] = ("n",),
    mode: str = "mode",
    ms: str = "encode_ms",
    size: str = "wire_bytes",
    plain: str = PLAIN_MODE,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Median time and bytes per size and mode, and bytes against the plain mode."""
    keys = [*by, mode]
    plain_facts = [F.count(F.lit(1)).alias("runs"), F.max(size).alias(size)]
    summary = exact_percentiles(runs, keys, ms, [0.5], ["median_ms"], group_rows, also=plain_facts)
    # A row per size and mode is left: the plain mode's row is found by a window, not a join.
    same = Window.partitionBy(*by)
    is_plain = F.col(mode) == plain
    return summary.withColumns(
        {
            "plain_bytes": F.max(F.when(is_plain, F.col(size))).over(same),
            "plain_ms": F.max(F.when(is_plain, F.col("median_ms"))).over(same),
        }
    ).withColumn("ratio", F.col(size) / F.col("plain_bytes"))


def break_even(summary: DataFrame, size: str = "wire_bytes") -> DataFrame:
    """Link speed at which the time saved in transfer equals the added CPU time.

    Null where a mode saves no bytes or costs no time.
    """
    saved = F.col("plain_bytes") - F.col(size)
    added_ms = F.col("median_ms") - F.col("plain_ms")
    mbps = F.when((saved > 0) & (added_ms > 0), saved * 8 / (added_ms / 1000.0) / 1e6)
    return summary.withColumns(
        {"bytes_saved": saved, "added_ms": added_ms, "break_even_mbps": mbps}
    )


def span_totals(
    log: DataFrame, span: str = "span", ms: str = "ms", long_ms: float = LONG_TASK_MS
) -> DataFrame:
    """Total, greatest and number of timings per span; the same for long tasks alone."""
    value, is_long = F.col(ms), F.col(ms) > F.lit(long_ms)
    return log.groupBy(span).agg(
        F.count(value).alias("count"),
        F.sum(value).alias("total_ms"),
        F.max(value).alias("max_ms"),
        F.count(F.when(is_long, value)).alias("long_count"),
        F.coalesce(F.sum(F.when(is_long, value)), F.lit(0.0)).alias("long_total_ms"),
        F.coalesce(F.max(F.when(is_long, value)), F.lit(0.0)).alias("long_max_ms"),
    )
