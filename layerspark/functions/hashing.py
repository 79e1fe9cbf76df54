"""Row hashes that do not depend on row order, partitioning or engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    MapType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# A hash is summed in three parts of this many bits, the top part signed.
_PART_BITS = 21
_PART_MASK = (1 << _PART_BITS) - 1
# Portable text keeps seven decimals of a float: about a centimetre in degrees.
PORTABLE_SCALE = 10_000_000


def row_hash(id_col: Column, column: Column, dtype: DataType, algo: str) -> Column:
    """Hash of one cell together with its row's id, as a BIGINT.

    ``xxhash64`` hashes Spark's own binary form and is the fast default. ``md5``
    hashes portable text, so that another engine gets the same number.
    """
    if algo == "xxhash64":
        return F.xxhash64(id_col, _hashable(column, dtype))
    if algo == "md5":
        text = F.concat_ws("|", id_col.cast("string"), F.coalesce(portable_text(column, dtype), F.lit("~")))
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    raise ValueError(f"unknown hash {algo!r}; use 'xxhash64' or 'md5'")


def hash_total(name: str) -> Column:
    """Sum of a BIGINT hash column as text, exact for up to 2**41 rows.

    Three BIGINT sums over parts of the hash stay in the fast hash aggregate;
    one wide decimal sum would not. They are put together once, at the end, in
    steps that keep within 38 digits.
    """
    low = f"sum({name} & {_PART_MASK})"
    middle = f"sum(shiftright({name}, {_PART_BITS}) & {_PART_MASK})"
    high = f"sum(shiftright({name}, {2 * _PART_BITS}))"
    wide = lambda part: f"cast(coalesce({part}, 0) as decimal(20,0))"
    step = f"cast({1 << _PART_BITS} as decimal(8,0))"
    upper = f"cast({wide(high)} * {step} + {wide(middle)} as decimal(28,0))"
    return F.expr(f"cast({upper} * {step} + {wide(low)} as string)")


def _hashable(column: Column, dtype: DataType) -> Column:
    """xxhash64 skips nulls, so say where they are; -0.0 and 0.0 already hash alike.

    A struct is taken field by field, a map as its entries by key, and a nested list
    as the hashes of its elements: a hash of all numbers alone hides their grouping.
    """
    if isinstance(dtype, StructType):
        parts = [_hashable(column[f.name], f.dataType) for f in dtype.fields]
        return F.struct(column.isNull(), *parts)
    if isinstance(dtype, MapType):
        entry = StructType().add("key", dtype.keyType).add("value", dtype.valueType)
        hashes = F.transform(F.map_entries(column), lambda e: F.xxhash64(_hashable(e, entry)))
        return F.struct(F.size(column), F.array_sort(hashes))
    if isinstance(dtype, ArrayType):
        inner = dtype.elementType
        if isinstance(inner, (ArrayType, StructType, MapType)):
            return F.struct(F.size(column), F.transform(column, lambda x: F.xxhash64(_hashable(x, inner))))
        gaps = F.when(F.exists(column, lambda x: x.isNull()), F.transform(column, lambda x: x.isNull()))
        return F.struct(F.size(column), column, gaps)
    return F.struct(column.isNull(), column)


def portable_text(column: Column, dtype: DataType) -> Column:
    """Text that two engines agree on: floats as scaled whole numbers, lists with brackets."""
    if isinstance(dtype, (FloatType, DoubleType)):
        scaled = F.round(column.cast("double") * F.lit(PORTABLE_SCALE)).cast("long").cast("string")
        limit = F.abs(column) < F.lit(9e11)
        return F.when(F.isnan(column), "NaN").when(limit, scaled).otherwise(column.cast("string"))
    if isinstance(dtype, BooleanType):
        return F.when(column, "true").when(~column, "false")
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("string")
    if isinstance(dtype, ArrayType):
        inner = dtype.elementType
        parts = F.transform(column, lambda x: F.coalesce(portable_text(x, inner), F.lit("~")))
        return F.when(column.isNotNull(), F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]")))
    if isinstance(dtype, StructType):
        raise ValueError("portable hashes cover scalars and lists; use 'xxhash64' for structs")
    if isinstance(dtype, (StringType, DecimalType)):
        return column.cast("string")
    return column.cast("string")


def stable_bucket(id_col: Column, hex_digits: int = 4) -> Column:
    """Bucket 0 .. 16**hex_digits - 1 of an id, the same in every run and engine."""
    prefix = F.substring(F.md5(id_col.cast("string")), 1, hex_digits)
    return F.conv(prefix, 16, 10).cast("int")
