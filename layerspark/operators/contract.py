"""Checks of a layer's rows, each as aggregates of one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, DoubleType, FloatType, ShortType, StructType

from layerspark.spec import GEOMETRY_KEY, LayerSpec, geometry_columns


def null_geometry(df: DataFrame, columns: Sequence[str], policy: str = "keep") -> DataFrame:
    """Rows with a missing shape: ``keep`` them, ``drop`` them, or ``report`` their number."""
    missing = _any([F.col(c).isNull() for c in columns])
    if policy == "keep":
        return df
    if policy == "drop":
        return df.where(~missing)
    if policy == "report":
        return df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(missing.cast("long")), F.lit(0)).alias("null_rows"),
        )
    raise ValueError("policy must be 'keep', 'drop' or 'report'")


def finite(column: Column) -> Column:
    """True for a null or an ordinary number."""
    value = column.cast("double")
    return ~F.coalesce(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), F.lit(False))


def check_finite(df: DataFrame, columns: Sequence[str], policy: str = "report") -> DataFrame:
    """NaN and infinity per column: ``report`` counts, ``drop`` rows, or ``raise`` on the first."""
    ok = {c: finite(F.col(c)) for c in columns}
    if policy == "drop":
        return df.where(_all(list(ok.values())))
    if policy == "raise":
        checked = df
        for c, good in ok.items():
            text = F.lit(
                f"column {c!r} holds a non-finite number (NaN or infinity); "
                "drop such rows or give an explicit view state"
            )
            checked = checked.withColumn(c, F.when(good, F.col(c)).otherwise(F.raise_error(text)))
        return checked
    if policy == "report":
        return df.agg(
            *[F.coalesce(F.sum((~good).cast("long")), F.lit(0)).alias(c) for c, good in ok.items()]
        )
    raise ValueError("policy must be 'report', 'drop' or 'raise'")


def row_rules(schema: StructType, spec: LayerSpec) -> dict[str, Column]:
    """Rules a layer's rows must meet, as columns that are true where a rule is broken."""
    rules: dict[str, Column] = {"null_id": F.col(spec.id_col).isNull()}
    for name in geometry_columns(schema, spec.layer_type):
        field, column = schema[name], F.col(name)
        rules[f"{name}_null"] = column.isNull()
        depth = list_depth(field.dataType)
        kind = (field.metadata or {}).get(GEOMETRY_KEY, "")
        if depth == 1:
            rules[f"{name}_length"] = ~F.size(column).isin(2, 3)
            rules[f"{name}_range"] = ~_on_earth(column)
            rules[f"{name}_finite"] = F.exists(column, lambda x: ~finite(x))
        elif depth >= 2:
            vertices = column
            for _ in range(depth - 2):
                vertices = F.flatten(vertices)
            # Lists of vertices: the column itself, a polygon's rings, or those of many polygons.
            lines = F.array(column) if depth == 2 else column if depth == 3 else F.flatten(column)
            rules[f"{name}_length"] = F.exists(vertices, lambda v: ~F.size(v).isin(2, 3))
            if "polygon" in kind or (depth > 2 and not kind.endswith("linestring")):
                rules[f"{name}_ring"] = F.exists(
                    lines, lambda r: (F.size(r) < 4) | ~r[0].eqNullSafe(F.element_at(r, -1))
                )
            else:
                least = 2 if kind.endswith("linestring") else 1
                short = F.exists(lines, lambda r: F.size(r) < least)
                rules[f"{name}_length"] = rules[f"{name}_length"] | (column.isNotNull() & short)
            rules[f"{name}_range"] = F.exists(vertices, lambda v: ~_on_earth(v))
            rules[f"{name}_finite"] = F.exists(vertices, lambda v: F.exists(v, lambda x: ~finite(x)))
    for field in schema.fields:
        if isinstance(field.dataType, ArrayType) and isinstance(
            field.dataType.elementType, (ByteType, ShortType)
        ):
            column = F.col(field.name)
            rules[f"{field.name}_length"] = ~F.size(column).isin(3, 4)
            rules[f"{field.name}_range"] = F.exists(column, lambda x: (x < 0) | (x > 255))
        elif (field.name in spec.accessors or field.name.startswith("get_")) and isinstance(field.dataType, (FloatType, DoubleType)):
            # Hover values may be NaN; only what is drawn must be a number.
            rules[f"{field.name}_finite"] = ~finite(F.col(field.name))
    if spec.layer_type == "trip" and "get_timestamps" in schema.names and "geometry" in schema.names:
        rules["times_length"] = F.size("geometry") != F.size("get_timestamps")
    return rules


def check_rows(df: DataFrame, spec: LayerSpec) -> DataFrame:
    """Row count and number of rows that break each rule; one pass, one row."""
    rules = row_rules(df.schema, spec)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.when(broken, F.lit(1))).alias(name) for name, broken in rules.items()],
    )


def assert_rows(df: DataFrame, spec: LayerSpec, allow: Sequence[str] = ("geometry_null",)) -> None:
    """Raise when a rule is broken, naming each rule and its number of rows."""
    found = check_rows(df, spec).first().asDict()
    broken = {k: v for k, v in found.items() if k != "rows" and v and k not in allow}
    if broken:
        text = ", ".join(f"{k}: {v} rows" for k, v in sorted(broken.items()))
        raise ValueError(f"layer {spec.layer_id!r} breaks its contract ({text})")


def budget_verdict(sizes: DataFrame, max_mb: float, named: int = 3) -> DataFrame:
    """The largest layers with the total of all and whether it is over the limit.

    ``sizes`` has one row per layer with its encoded ``bytes``.
    """
    limit = int(max_mb * 1_000_000)
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("total")).select("total").scalar()
    largest = sizes.select("layer_id", "bytes").orderBy(F.desc("bytes"), "layer_id").limit(named)
    return largest.select("layer_id", "bytes", total.alias("total"), (total > limit).alias("over_limit"))


def check_budget(sizes: DataFrame, max_mb: float) -> None:
    """Raise when the layers' bytes exceed the limit, naming the largest."""
    top = budget_verdict(sizes, max_mb).collect()
    if top and top[0]["over_limit"]:
        names = ", ".join(f"{r['layer_id']} with {r['bytes'] / 1e6:.1f} MB" for r in top)
        raise ValueError(
            f"over budget: {top[0]['total'] / 1e6:.1f} MB encoded where {max_mb} MB are allowed. Largest "
            f"layers: {names}. Fewer rows, coarser shapes, another encoding or a higher limit would help"
        )


def list_depth(dtype) -> int:
    depth = 0
    while isinstance(dtype, ArrayType):
        depth, dtype = depth + 1, dtype.elementType
    return depth


def _on_earth(xy: Column) -> Column:
    """False only for a known place off the globe; missing numbers have rules of their own."""
    lon, lat = F.get(xy, F.lit(0)), F.get(xy, F.lit(1))
    inside = lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0)
    return F.coalesce(inside | F.isnan(lon) | F.isnan(lat), F.lit(True))


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
