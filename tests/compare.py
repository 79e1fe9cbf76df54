"""Run registered queries next to their SQL twins and compare the rows.

``python tests/compare.py <sf folder> [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return float(f"{value:.12g}") + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])


def kinds(rows):
    return [sorted({type(r[i]).__name__ for r in rows if r[i] is not None}) for i in range(len(rows[0]))] if rows else []


def duck(sf, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def difference(spark, sf, query, sql):
    """None when the rows agree, otherwise what differs."""
    got_cols, got = spark_rows(query(spark, sf))
    want_cols, want = duck(sf, sql)
    if got_cols != want_cols:
        return f"columns {got_cols} against {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    if kinds(got) != kinds(want):
        return f"types {list(zip(got_cols, kinds(got), kinds(want)))}"
    bad = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    return f"{len(bad)} rows differ, first {got_cols} {bad[0]}" if bad else None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from layerspark.session import build_session

    sf = sys.argv[1]
    known, sqls = queries(), oracle_sql()
    names = sys.argv[2:] or list(known)
    zone = os.environ.get("COMPARE_ZONE", "UTC")
    spark = build_session("compare", "local[8]", **{"spark.sql.session.timeZone": zone, "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        start = time.time()
        try:
            found = difference(spark, sf, known[name], sqls[name])
        except Exception as error:  # noqa: BLE001
            found = f"ERROR {str(error)[:1500]}"
        failed += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {time.time() - start:6.2f}s {name} {found or ''}", flush=True)
    print("failed", failed, "of", len(names))


if __name__ == "__main__":
    main()
