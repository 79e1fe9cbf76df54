"""Leading-edge throttle: an event passes, then others wait out the interval.

The rule is sequential per key. Three facts let it run in parallel on a table:

* of several events of a key at one time only the first can pass, so copies
  collapse before the shuffle;
* after a pause of at least the interval the next event always passes, so a key
  falls into independent runs;
* a piece of a long run only needs to know when the last event before it passed.
  For every possible answer the piece can say, on its own, which of its events
  passes last; chaining these short tables gives each piece its true start.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from layerspark.operators.skew import join_keys
from layerspark.session import materialize

# Fixed value: milliseconds between reported hovers, and between reported views.
THROTTLE_MS = 200
# Longest run, and largest piece of a run, handled in one go.
RUN_ROWS = 1_000_000


def throttle(
    events: DataFrame,
    keys: Sequence[str] = ("session", "kind"),
    interval_ms: int = THROTTLE_MS,
    ts: str = "ts",
    tie: str = "event_id",
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """Events that pass, per key and in time order; equal times go to the lowest tie.

    ``tie`` tells the events of a key apart. Only keys, times and ties take part
    in the work; whole rows are read once more at the end, by a semi join.
    """
    interval = interval_ms * 1000
    timed = events.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
    # One row per key and time: the lowest tie, combined before the shuffle.
    first = (
        timed.where(F.col("_t").isNotNull() & F.col(tie).isNotNull())
        .groupBy(*keys, "_t")
        .agg(F.min(tie).alias("_tie"))
        .withColumn("_slot", F.floor(F.col("_t") / F.lit(interval)))
    )
    slots = _runs(first, keys, interval, run_rows)
    # Read several times below: written once instead of shuffled each time.
    joined = materialize(join_keys(first, slots, [*keys, "_slot"]).drop("_slot"), "throttle")

    alone = joined.where("_size = 1")
    several = joined.where("_size > 1").withColumn("_entry", F.col("_start"))
    long = joined.where(F.col("_size") > run_rows)
    if not long.isEmpty():
        entries = _entries(long, keys, interval)
        several = several.where(F.col("_size") <= run_rows).unionByName(
            join_keys(long, entries, [*keys, "_run", "_piece"])
        )
    columns = [*keys, "_t", "_tie"]
    passed = alone.select(*columns).unionByName(_walk(several, keys, interval).select(*columns))
    passed = passed.withColumnRenamed("_tie", tie)
    return join_keys(timed, passed, [*keys, "_t", tie], "left_semi").drop("_t")


def _runs(first: DataFrame, keys: Sequence[str], interval: int, run_rows: int) -> DataFrame:
    """Run and piece of each occupied time slot; as many rows as the time covered has slots."""
    # Counting ties keeps this plan the same as the join's other side, whose shuffle is reused.
    slots = first.groupBy(*keys, "_slot").agg(
        F.count("_tie").alias("_n"), F.min("_t").alias("_from"), F.max("_t").alias("_to")
    )
    in_time = Window.partitionBy(*keys).orderBy("_slot")
    pause = F.col("_from") - F.lag("_to").over(in_time)
    slots = slots.withColumn("_run", F.when(pause.isNull() | (pause >= interval), F.col("_from")))
    slots = slots.withColumn("_run", F.last("_run", ignorenulls=True).over(in_time))
    in_run = Window.partitionBy(*keys, "_run")
    before = in_run.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumns(
        {
            "_size": F.sum("_n").over(in_run),
            "_piece": F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / F.lit(run_rows)),
        }
    )
    start = F.min("_from").over(Window.partitionBy(*keys, "_run", "_piece"))
    return slots.select(*keys, "_slot", "_run", "_size", "_piece", start.alias("_start"))


def throttle_interactions(
    events: DataFrame,
    interval_ms: int = THROTTLE_MS,
    session: str = "session",
    kind: str = "kind",
    ts: str = "ts",
    tie: str = "event_id",
) -> DataFrame:
    """Clicks all pass; hovers and view states are throttled apart, per session."""
    clicks = events.where(F.col(kind) == "clicked")
    others = events.where(F.col(kind) != "clicked")
    return clicks.unionByName(throttle(others, [session, kind], interval_ms, ts, tie))


def throttle_interactions_stream(
    events: DataFrame,
    interval_ms: int = THROTTLE_MS,
    session: str = "session",
    kind: str = "kind",
    ts: str = "ts",
    tie: str = "event_id",
    watermark: str = "10 minutes",
) -> DataFrame:
    """``throttle_interactions`` on a stream: clicks pass, hovers and views are throttled apart."""
    clicks = events.withWatermark(ts, watermark).where(F.col(kind) == "clicked")
    others = events.where(F.col(kind) != "clicked")
    return clicks.unionByName(throttle_stream(others, (session, kind), interval_ms, ts, tie, watermark))


def _walk(df: DataFrame, keys: Sequence[str], interval: int) -> DataFrame:
    """Pass through sorted pieces; memory stays at one record batch whatever their size."""
    ordered = df.repartition(*keys, "_run", "_piece").sortWithinPartitions(
        *keys, "_run", "_piece", "_t"
    )

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        until = 0
        for part in parts:
            times = part.column("_t").to_pylist()
            starts = part.column("_start").to_pylist()
            entries = part.column("_entry").to_pylist()
            mask = []
            for t, start, entry in zip(times, starts, entries, strict=True):
                if t == start:  # Times are distinct, so only a piece's first row has its start.
                    until = entry
                passes = t >= until
                if passes:
                    until = t + interval
                mask.append(passes)
            yield part.filter(pa.array(mask, pa.bool_()))

    return ordered.mapInArrow(keep, df.schema)


def _entries(df: DataFrame, keys: Sequence[str], interval: int) -> DataFrame:
    """Time from which an event can pass at the start of each piece of the long runs."""
    slim = df.select(*keys, "_run", "_piece", "_start", "_t")
    types = [f"`{k}` {dict(df.dtypes)[k]}" for k in keys]
    where = [*keys, "_run", "_piece"]
    answer_schema = ", ".join([*types, "_run long", "_piece long", "_upto long", "_last long"])
    entry_schema = ", ".join([*types, "_run long", "_piece long", "_entry long"])

    def answers(pdf: pd.DataFrame) -> pd.DataFrame:
        t = np.sort(pdf["_t"].to_numpy())
        after = np.searchsorted(t, t + interval)
        last = np.where(after < len(t), after, np.arange(len(t)))
        while True:
            further = last[last]
            if np.array_equal(further, last):
                break
            last = further
        # Only events of the first interval, or the first one after it, can pass first.
        choices = min(len(t), int(np.searchsorted(t, t[0] + interval)) + 1)
        ends = t[last[:choices]]
        keep = np.append(ends[1:] != ends[:-1], True)
        out = pd.DataFrame({"_upto": t[:choices][keep], "_last": ends[keep]})
        for name in where:
            out[name] = pdf[name].iloc[0]
        return out[[*where, "_upto", "_last"]]

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_piece", "_upto"])
        rows, until = [], None
        for piece, part in pdf.groupby("_piece", sort=True):
            upto, last = part["_upto"].to_numpy(), part["_last"].to_numpy()
            # A run starts at the time that names it, and its first event passes.
            entry = int(pdf["_run"].iloc[0]) if until is None else until
            rows.append((piece, entry))
            at = int(np.searchsorted(upto, entry))
            if at < len(upto):
                until = int(last[at]) + interval
        out = pd.DataFrame(rows, columns=["_piece", "_entry"])
        for name in [*keys, "_run"]:
            out[name] = pdf[name].iloc[0]
        return out[[*where, "_entry"]]

    per_piece = slim.groupBy(*where).applyInPandas(answers, answer_schema)
    return per_piece.groupBy(*keys, "_run").applyInPandas(chain, entry_schema)


def throttle_stream(
    events: DataFrame,
    keys: Sequence[str] = ("session", "kind"),
    interval_ms: int = THROTTLE_MS,
    ts: str = "ts",
    tie: str = "event_id",
    watermark: str = "10 minutes",
) -> DataFrame:
    """The throttle on a stream: one remembered time per key.

    Each micro-batch is taken in time order; events older than the watermark are
    dropped by Spark, and a key's state goes once the watermark has passed the
    end of its interval, when it can no longer hold anything back.
    """
    interval = interval_ms * 1000
    schema = StructType(list(events.schema.fields))
    timed = events.withWatermark(ts, watermark)

    def step(
        _key: tuple, parts: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(parts), ignore_index=True).sort_values([ts, tie], kind="stable")
        until = state.get[0] if state.exists else None
        times = pdf[ts].to_numpy().astype("datetime64[us]").astype(np.int64)
        kept = np.zeros(len(times), dtype=bool)
        for i, t in enumerate(times.tolist()):
            if until is None or t >= until:
                kept[i], until = True, t + interval
        state.update((until,))
        wake = max(until // 1000 + 1, state.getCurrentWatermarkMs() + 1)
        state.setTimeoutTimestamp(wake)
        if kept.any():
            yield pdf[kept]

    return timed.groupBy(*keys).applyInPandasWithState(
        step, schema, "until long", "append", GroupStateTimeout.EventTimeTimeout
    )
