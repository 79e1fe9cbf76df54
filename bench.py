"""Timings of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query
runs to a sink that keeps nothing; the best of the runs after a warm-up counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from layerspark.operators import shape  # noqa: E402
from layerspark.functions.widths import row_width  # noqa: E402
from layerspark.plans import queries  # noqa: E402
from layerspark.session import build_session, materialize  # noqa: E402
from layerspark.sinks import decode_payload, encode_layer  # noqa: E402
from layerspark.sinks.encode import table_bytes  # noqa: E402
from layerspark.sources import gen_points  # noqa: E402
from layerspark.spec import geometry_metadata  # noqa: E402

HEADLINE = """
    flagship layer_select tooltip_text color_ramp recolor trip_paths trip_times arcs
    contract_report finite_report range_filter brush in_view declutter fit_to_budget coarsen
    attach_stats resolve_picks lookup_rows hover_rows nearest_feature diff_layers diff_rows
    viewport layer_bytes encoding_tier format_sizes column_fingerprints geohash_rollup h3_rollup
    bench_summary span_totals row_index assign_batches stack_layers layer_parquet encoded_batches
    manifest throttle latest_view picks_to_rows encoded_values
""".split()
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
ENCODINGS = (("none", "ipc"), ("zstd", "ipc-zstd"), ("parquet", "parquet"))
ENCODE_ROWS = (10_000, 100_000, 1_000_000)


def run(df) -> float:
    start = time.perf_counter()
    df().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def encode_runs(spark) -> dict[str, dict]:
    """Encoding of point layers from a stored table: seconds, payload bytes, bytes per row."""
    out = {}
    for n in ENCODE_ROWS:
        points = shape.attach_colors(
            shape.points_from_lonlat(gen_points(spark, n, seed=1)), "r", "g", "b", name="get_fill_color"
        )
        layer = materialize(points.select("feature_id", "geometry", "get_fill_color", "radius"), "bench")
        # Read back without column roles, so they are set again.
        point = F.col("geometry").alias("geometry", metadata=geometry_metadata("point"))
        layer = layer.withColumn("geometry", point)
        width = layer.agg(F.ceil(F.sum(row_width(layer.schema)))).first()[0]
        for mode, encoding in ENCODINGS:
            times, size = [], 0
            for _ in range(3):
                start = time.perf_counter()
                encoded = encode_layer(
                    layer, "layer-0", encoding, 1_000_000, keep_id=False, num_rows=n, num_bytes=width
                )
                size = encoded.agg(F.sum("byte_length")).first()[0]
                times.append(time.perf_counter() - start)
            # The encoder alone on the stored bytes' table, as an in-process encoder would run.
            first = encoded.select("payload").first()
            table, alone = decode_payload(bytes(first["payload"]), encoding), []
            for _ in range(3):
                start = time.perf_counter()
                table_bytes(table, encoding)
                alone.append((time.perf_counter() - start) * 1000)
            out[f"{mode}_{n}"] = {
                "encoder_ms": round(statistics.median(alone), 2),
                "job_sec": round(statistics.median(times), 4),
                "bytes": size,
                "bytes_per_row": round(size / n, 2),
            }
    return out


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries.registry()
    names = sys.argv[1:] or HEADLINE
    timings = {}
    for name in names:
        times = [run(lambda q=known[name]: q(spark, sf)) for _ in range(RUNS + 1)]
        timings[name] = round(min(times[1:]), 4)
        print(name, [round(t, 3) for t in times], file=sys.stderr, flush=True)
    encoded = {} if sys.argv[1:] else encode_runs(spark)
    print(
        json.dumps(
            {
                "metric": "layer_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                "encode": encoded,
            }
        )
    )


if __name__ == "__main__":
    main()
