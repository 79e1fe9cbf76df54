"""Bytes a row takes in Arrow buffers, as an expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from layerspark.spec import GEOMETRY_KEY

_FIXED = (
    (BooleanType, 0.125),
    (ByteType, 1),
    (ShortType, 2),
    (IntegerType, 4),
    (FloatType, 4),
    (DateType, 4),
    (LongType, 8),
    (DoubleType, 8),
    (TimestampType, 8),
    (TimestampNTZType, 8),
)


def fixed_list(field: StructField) -> bool:
    """Lists of a fixed length have no offsets: points, colours and number pairs."""
    if not isinstance(field.dataType, ArrayType) or isinstance(field.dataType.elementType, ArrayType):
        return False
    kind = (field.metadata or {}).get(GEOMETRY_KEY, "")
    is_color = isinstance(field.dataType.elementType, (ByteType, ShortType))
    return kind == "geoarrow.point" or is_color or field.name in FIXED_LIST_ACCESSORS


# Accessors whose per-row value is a list of fixed length.
FIXED_LIST_ACCESSORS = (
    "get_source_position",
    "get_target_position",
    "get_brushing_target",
    "get_filter_value",
    "get_dash_array",
)


def row_width(schema: StructType) -> Column:
    """Width of one row; a sum of it is the size of the uncompressed layer."""
    constant, parts = 0.0, []
    for field in schema.fields:
        column, dtype = F.col(f"`{field.name}`"), field.dataType
        fixed = _fixed(dtype)
        if fixed is not None:
            constant += fixed
        elif fixed_list(field):
            each = 1 if isinstance(dtype.elementType, (ByteType, ShortType)) else _fixed(dtype.elementType)
            parts.append(F.coalesce(F.size(column), F.lit(0)) * F.lit(float(each)))
        else:
            parts.append(_variable(column, dtype))
    total = F.lit(constant)
    for part in parts:
        total = total + part
    return total


def _fixed(dtype: DataType) -> float | None:
    if isinstance(dtype, DecimalType):
        # Wide whole numbers are unsigned 64-bit cell ids.
        return 8 if dtype.scale == 0 and dtype.precision <= 20 else 16
    return next((float(w) for t, w in _FIXED if isinstance(dtype, t)), None)


def _variable(column: Column, dtype: DataType) -> Column:
    if isinstance(dtype, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + F.lit(4.0)
    if isinstance(dtype, StructType):
        total = F.lit(0.0)
        for field in dtype.fields:
            fixed = _fixed(field.dataType)
            inner = column[field.name]
            total = total + (F.lit(fixed) if fixed is not None else _variable(inner, field.dataType))
        return total
    if isinstance(dtype, ArrayType):
        element = dtype.elementType
        fixed = _fixed(element)
        if fixed is not None:
            body = F.coalesce(F.size(column), F.lit(0)) * F.lit(fixed)
        elif _is_vertex(element):
            # Vertices are fixed pairs or triples: no offsets for them.
            body = F.coalesce(
                F.aggregate(column, F.lit(0.0), lambda acc, v: acc + F.coalesce(F.size(v), F.lit(0)) * 8.0),
                F.lit(0.0),
            )
        else:
            body = F.coalesce(
                F.aggregate(column, F.lit(0.0), lambda acc, v: acc + _variable(v, element)), F.lit(0.0)
            )
        return body + F.lit(4.0)
    raise ValueError(f"no width rule for {dtype.simpleString()}")


def _is_vertex(dtype: DataType) -> bool:
    return isinstance(dtype, ArrayType) and isinstance(dtype.elementType, DoubleType)
