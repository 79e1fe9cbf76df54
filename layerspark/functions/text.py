"""Hover text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    FloatType,
    LongType,
    MapType,
    StructType,
)

# Characters escaped in hover text, ampersand first.
HTML_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;"))


def escape_html(text: Column) -> Column:
    for char, entity in HTML_ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def escape_html_literal(text: str) -> str:
    for char, entity in HTML_ESCAPES:
        text = text.replace(char, entity)
    return text


def display_text(column: Column, dtype: DataType) -> Column:
    """Text of one value as a browser shows it; null gives empty text."""
    if isinstance(dtype, (StructType, ArrayType, MapType)):
        text = F.to_json(_json_ready(column, dtype), {"ignoreNullFields": "false"})
    elif isinstance(dtype, (FloatType, DoubleType)):
        text = _number_text(column.cast("double"))
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(""))


def tooltip_text(columns: list[tuple[str, Column, DataType]]) -> Column:
    """One escaped ``<div>name: value</div>`` per column, joined."""
    rows = [
        F.concat(
            F.lit(f"<div>{escape_html_literal(name)}: "),
            escape_html(display_text(column, dtype)),
            F.lit("</div>"),
        )
        for name, column, dtype in columns
    ]
    return F.concat(*rows) if rows else F.lit(None).cast("string")


def _number_text(value: Column) -> Column:
    """Shortest text of a double without a trailing ``.0`` or an exponent below 1e21."""
    size = F.abs(value)
    trim = lambda text: F.regexp_replace(text, r"\.?0+$", "")
    return (
        F.when(F.isnan(value), F.lit("NaN"))
        .when(size == F.lit(float("inf")), F.when(value > 0, "Infinity").otherwise("-Infinity"))
        .when((size < 1e15) & (value == F.floor(value)), F.floor(value).cast("string"))
        .when((size >= 1e-3) & (size < 1e7), value.cast("string"))
        .when((size >= 1e7) & (size < 1e20), trim(F.format_string("%s", value.cast("decimal(38,16)"))))
        .when((size >= 1e-6) & (size < 1e-3), trim(F.format_string("%s", value.cast("decimal(38,30)"))))
        .otherwise(value.cast("string"))
    )


def _json_ready(column: Column, dtype: DataType) -> Column:
    """Nested values with big integers as text, which JSON numbers cannot hold exactly."""
    if isinstance(dtype, LongType):
        return column.cast("string")
    if isinstance(dtype, ArrayType):
        inner = dtype.elementType
        return F.transform(column, lambda x: _json_ready(x, inner))
    if isinstance(dtype, StructType):
        fields = [_json_ready(column[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column
