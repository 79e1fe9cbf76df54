"""What changed between two versions of a layer."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerspark.functions.hashing import hash_total, row_hash
from layerspark.spec import LayerSpec, geometry_columns, to_json


def hashed_rows(
    df: DataFrame, id_col: str, algo: str = "xxhash64", keep: Sequence[Column] = ()
) -> DataFrame:
    """Row hashes of every column as ``_h0``, ``_h1``, ..., next to the kept expressions."""
    hashes = [
        row_hash(F.col(id_col), F.col(f"`{f.name}`"), f.dataType, algo).alias(f"_h{i}")
        for i, f in enumerate(df.schema.fields)
    ]
    return df.select(*keep, *hashes)


def fingerprint_sums(names: Sequence[str]) -> dict[str, Column]:
    """Per column of ``hashed_rows``, the sum of its hashes: the same in any row order."""
    return {name: hash_total(f"_h{i}") for i, name in enumerate(names)}


def fingerprint_map(names: Sequence[str]) -> Column:
    pairs = [x for name, total in fingerprint_sums(names).items() for x in (F.lit(name), total)]
    return F.create_map(*pairs)


def column_fingerprints(
    df: DataFrame, id_col: str = "feature_id", algo: str = "xxhash64"
) -> DataFrame:
    """One row per column: its name, fingerprint and number of rows; one pass over the data."""
    packed = hashed_rows(df, id_col, algo).agg(
        fingerprint_map(df.columns).alias("_f"), F.count(F.lit(1)).alias("rows")
    )
    return packed.select(F.explode("_f").alias("column", "fingerprint"), "rows")


def joined_fingerprint(names: Sequence[str], prints: Column) -> Column:
    """Fingerprint of several columns together; null for none, which nothing equals."""
    if not names:
        return F.lit(None).cast("string")
    return F.concat_ws(
        "|", *[F.concat(F.lit(f"{n}:"), F.element_at(prints, F.lit(n))) for n in sorted(names)]
    )


def props_fingerprint(spec: LayerSpec) -> str:
    """Fingerprint of everything a layer says besides its rows: type, props, extensions."""
    text = to_json(
        {"type": spec.layer_type, "props": spec.wire_props(), "extensions": spec.wire_extensions()},
        f"layer {spec.layer_id!r}",
    )
    return hashlib.sha256(text.encode()).hexdigest()


def geometry_fingerprint(
    df: DataFrame, spec: LayerSpec, algo: str = "xxhash64"
) -> DataFrame:
    """One row: the joined fingerprint of the columns that decide the shapes, and the row count."""
    names = geometry_columns(df.schema, spec.layer_type)
    shapes = df.select(spec.id_col, *names)
    packed = hashed_rows(shapes, spec.id_col, algo).agg(
        fingerprint_map(shapes.columns).alias("_m"), F.count(F.lit(1)).alias("rows")
    )
    return packed.select(joined_fingerprint(names, F.col("_m")).alias("geometry_fp"), "rows")


def diff_layers(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """Verdict per layer from two manifests (one row per layer each).

    Needed columns: ``layer_id, position, num_rows, column_fps (map), geometry_fp,
    props_fp, tooltip``. Verdicts, from cheap to dear: ``unchanged``,
    ``tooltip_only``, ``props_only``, ``accessors_only`` (shapes kept),
    ``encoding_changed`` (same shapes, but stored in another encoding),
    ``geometry_changed``, ``new``, ``removed``. Encodings are compared where both
    manifests have ``body_encoding``, in which plain Arrow is null.
    """
    fields = ["position", "num_rows", "column_fps", "geometry_fp", "props_fp", "tooltip"]
    if "body_encoding" in prev.columns and "body_encoding" in curr.columns:
        encoding = [F.col("body_encoding")]
    else:
        encoding = [F.lit(None).cast("string").alias("body_encoding")]
    p = prev.select("layer_id", F.struct(*fields, *encoding).alias("p"))
    c = curr.select("layer_id", F.struct(*fields, *encoding).alias("c"))
    both = p.join(c, "layer_id", "full_outer")
    old, new = F.map_entries("p.column_fps"), F.map_entries("c.column_fps")
    differing = F.array_union(F.array_except(old, new), F.array_except(new, old))
    changed = F.array_sort(F.array_distinct(F.transform(differing, lambda e: e["key"])))
    same_rows = F.col("p.num_rows") == F.col("c.num_rows")
    same_data = same_rows & (F.size(differing) == 0)
    same_props = F.col("p.props_fp") == F.col("c.props_fp")
    same_tooltip = F.col("p.tooltip").eqNullSafe(F.col("c.tooltip"))
    # A null geometry fingerprint proves nothing, so it never counts as the same.
    same_shapes = same_rows & F.coalesce(F.col("p.geometry_fp") == F.col("c.geometry_fp"), F.lit(False))
    same_encoding = F.col("p.body_encoding").eqNullSafe(F.col("c.body_encoding"))
    verdict = (
        F.when(F.col("p").isNull(), "new")
        .when(F.col("c").isNull(), "removed")
        .when((same_data | same_shapes) & ~same_encoding, "encoding_changed")
        .when(same_data & same_props & same_tooltip, "unchanged")
        .when(same_data & same_props, "tooltip_only")
        .when(same_data, "props_only")
        .when(same_shapes, "accessors_only")
        .otherwise("geometry_changed")
    )
    in_both = F.col("p").isNotNull() & F.col("c").isNotNull()
    return both.select(
        "layer_id",
        verdict.alias("verdict"),
        F.when(in_both, changed).otherwise(F.array().cast("array<string>")).alias("changed_columns"),
        F.coalesce(in_both & ~same_props, F.lit(False)).alias("props_changed"),
        F.coalesce(in_both & (F.col("p.position") != F.col("c.position")), F.lit(False)).alias("moved"),
    )


def diff_rows(
    prev: DataFrame,
    curr: DataFrame,
    id_col: str = "feature_id",
    geometry: Sequence[str] = (),
    accessors: Sequence[str] = (),
) -> DataFrame:
    """Verdict per feature id: added, removed, unchanged, accessors_only, geometry_changed.

    Both versions are stacked and grouped by id, which needs one shuffle, combines
    before it, and stays linear if an id is repeated; a repeated id is reported as
    ``duplicate_id`` instead of being matched with itself many times. A column is
    the same when both sides are null or its least and greatest value are equal.
    """
    columns = [*geometry, *accessors]
    both = prev.select(F.lit(0).alias("_side"), id_col, *columns).unionByName(
        curr.select(F.lit(1).alias("_side"), id_col, *columns)
    )
    grouped = both.groupBy(id_col).agg(
        F.sum(F.lit(1) - F.col("_side")).alias("_p"),
        F.sum("_side").alias("_c"),
        *[
            (
                (F.count(c) == 0)
                | ((F.count(c) == F.count(F.lit(1))) & F.min(c).eqNullSafe(F.max(c)))
            ).alias(f"_same_{c}")
            for c in columns
        ],
    )
    changed = F.array_compact(F.array(*[F.when(~F.col(f"_same_{c}"), F.lit(c)) for c in columns]))
    shapes_same = F.lit(True)
    for c in geometry:
        shapes_same = shapes_same & F.col(f"_same_{c}")
    matched = (F.col("_p") == 1) & (F.col("_c") == 1)
    verdict = (
        F.when((F.col("_p") > 1) | (F.col("_c") > 1), "duplicate_id")
        .when(F.col("_p") == 0, "added")
        .when(F.col("_c") == 0, "removed")
        .when(F.size(changed) == 0, "unchanged")
        .when(shapes_same, "accessors_only")
        .otherwise("geometry_changed")
    )
    return grouped.select(
        id_col,
        verdict.alias("verdict"),
        F.when(matched, changed).otherwise(F.array().cast("array<string>")).alias("changed_columns"),
    )


def changed_rows(
    curr: DataFrame, diff: DataFrame, columns: Sequence[str], id_col: str = "feature_id"
) -> DataFrame:
    """Only the changed columns of the rows to refresh, keyed by id."""
    touched = diff.where(F.col("verdict").isin("added", "accessors_only", "geometry_changed"))
    return curr.select(id_col, *columns).join(touched.select(id_col, "verdict"), id_col)
