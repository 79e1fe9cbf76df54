"""Layer batches as Arrow stream or Parquet bytes, encoded inside the tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from layerspark.functions.widths import fixed_list, row_width
from layerspark.operators.order import TIE, batch_of, batch_starts, with_tie
from layerspark.spec import ENCODINGS, GEOMETRY_KEY

# A batch ends at whichever comes first. The bytes, of the uncompressed columns, bound
# the memory of a task and keep a payload far below what one binary value may hold.
ROWS_PER_BATCH = 500_000
BYTES_PER_BATCH = 128 << 20
DECODED_ROWS = 10_000
PAYLOAD_SCHEMA = (
    "layer_id string, batch_id long, num_rows long, encoding string, byte_length long, payload binary"
)


def encode_layer(
    df: DataFrame,
    layer_id: str,
    encoding: str,
    rows_per_batch: int = ROWS_PER_BATCH,
    id_col: str = "feature_id",
    keep_id: bool = True,
    num_rows: int | None = None,
    num_bytes: int | None = None,
    bytes_per_batch: int = BYTES_PER_BATCH,
) -> DataFrame:
    """One row per batch with its encoded bytes.

    Batches follow the id order and the rows' widths alone, so equal content gives
    equal bytes however the input was partitioned. Each batch is encoded in the task
    that holds it. A layer known or counted to fit one batch, in rows and in bytes, is
    only sorted; of a bigger one the batches' first ids are found on narrow columns, and
    the rows themselves are shuffled once.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"unknown encoding {encoding!r}")
    if num_rows is None or num_bytes is None:
        size = F.coalesce(F.sum(F.ceil(row_width(df.schema))), F.lit(0))
        num_rows, num_bytes = df.agg(F.count(F.lit(1)), size).first()
    if num_rows <= rows_per_batch and num_bytes <= bytes_per_batch:
        ordered = df.withColumn("batch_id", F.lit(0).cast("long")).repartition(1).sortWithinPartitions(id_col)
    else:
        starts = batch_starts(df, id_col, rows_per_batch, bytes_per_batch)
        number = batch_of(starts, df.schema[id_col].dataType.simpleString())
        batched = with_tie(df).withColumn("batch_id", number(id_col, *TIE)).drop(TIE[1])
        ordered = batched.repartition("batch_id").sortWithinPartitions("batch_id", id_col, TIE[0]).drop(TIE[0])
    names = [c for c in df.columns if keep_id or c != id_col]
    plan = _wire_plan(df.schema, names)

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for part in parts:
            ids = part.column("batch_id").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                if start == stop:
                    continue
                if held and ids[start] != current:
                    yield _emit(held, plan, layer_id, current, encoding)
                    held = []
                current = int(ids[start])
                held.append(part.slice(start, stop - start))
        if held:
            yield _emit(held, plan, layer_id, current, encoding)

    return ordered.mapInArrow(encode, PAYLOAD_SCHEMA)


def decode_payload(payload: bytes, encoding: str) -> pa.Table:
    """Table of one encoded batch."""
    if encoding == "parquet":
        return pq.read_table(pa.BufferReader(payload))
    return pa.ipc.open_stream(payload).read_all()


def decode_layer(encoded: DataFrame, schema: StructType) -> DataFrame:
    """Rows of encoded batches, each decoded in its task; ``schema`` names the columns wanted.

    Arrays come back as arrays and colour bytes as the numbers they were.
    """
    wanted = to_arrow_schema(schema)

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for encoding, payload in zip(part.column(0).to_pylist(), part.column(1)):
                table = decode_payload(payload.as_buffer().to_pybytes(), encoding)
                columns = [_from_wire(_one_chunk(table.column(f.name)), f.type) for f in wanted]
                whole = pa.RecordBatch.from_arrays(columns, schema=wanted)
                # The rows of a batch go on in pieces, as Spark's own batches are.
                for start in range(0, whole.num_rows, DECODED_ROWS):
                    yield whole.slice(start, DECODED_ROWS)

    return encoded.select("encoding", "payload").mapInArrow(decode, schema)


def _from_wire(array: pa.Array, kind: pa.DataType) -> pa.Array:
    if pa.types.is_list(kind):
        if pa.types.is_fixed_size_list(array.type):
            size = array.type.list_size
            present = np.asarray(array.is_valid())
            offsets = np.concatenate([[0], np.cumsum(present * size)]).astype(np.int32)
            mask = pa.array(~present) if array.null_count else None
            # "flatten" leaves out what null rows hide.
            values = _from_wire(array.flatten(), kind.value_type)
            return pa.ListArray.from_arrays(pa.array(offsets), values, type=kind, mask=mask)
        values = _from_wire(array.values, kind.value_type)
        mask = array.is_null() if array.null_count else None
        return pa.ListArray.from_arrays(pa.array(array.offsets), values, type=kind, mask=mask)
    return array.cast(kind)


def table_bytes(table: pa.Table, encoding: str) -> bytes:
    """Bytes of one batch. The whole batch is one record batch, or one row group."""
    table = table.combine_chunks()
    sink = pa.BufferOutputStream()
    if encoding == "parquet":
        split, dictionary = leaf_policy(table.schema)
        pq.write_table(
            table,
            sink,
            compression="zstd",
            use_dictionary=dictionary,
            use_byte_stream_split=split,
            row_group_size=max(1, table.num_rows),
        )
    else:
        codec = "zstd" if encoding == "ipc-zstd" else None
        options = pa.ipc.IpcWriteOptions(compression=codec)
        with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
            writer.write_table(table)
    return sink.getvalue().to_pybytes()


def leaf_policy(schema: pa.Schema) -> tuple[list[str], list[str]]:
    """Parquet leaves to byte-stream-split, and leaves to dictionary-encode.

    Flat and point-like numbers are split; vertices of lines and polygons stay
    plain, because splitting hides the repeats that compress them; other leaves
    keep a dictionary.
    """
    split: list[str] = []
    dictionary: list[str] = []

    def walk(path: str, dtype: pa.DataType, lists: int) -> None:
        if pa.types.is_list(dtype) or pa.types.is_fixed_size_list(dtype) or pa.types.is_large_list(dtype):
            walk(f"{path}.list.element", dtype.value_type, lists + 1)
        elif pa.types.is_struct(dtype):
            for child in dtype:
                walk(f"{path}.{child.name}", child.type, lists)
        elif _splittable(dtype):
            if lists <= 1:
                split.append(path)
        else:
            dictionary.append(path)

    for field in schema:
        walk(field.name, field.type, 0)
    return split, dictionary


def _splittable(dtype: pa.DataType) -> bool:
    """Types stored as 4- or 8-byte numbers."""
    return (
        pa.types.is_integer(dtype)
        or pa.types.is_float32(dtype)
        or pa.types.is_float64(dtype)
        or pa.types.is_timestamp(dtype)
        or pa.types.is_date32(dtype)
    )


def _wire_plan(schema: StructType, names: list[str]) -> list[tuple[str, str, dict]]:
    """How each column goes on the wire: as it is, as a fixed list, or as colour bytes."""
    plan = []
    for name in names:
        field = schema[name]
        meta = {k: str(v) for k, v in sorted((field.metadata or {}).items())}
        shape = "plain"
        if fixed_list(field):
            element = field.dataType.elementType.typeName()
            shape = "color" if element in ("short", "byte") else "fixed"
        elif isinstance(field.dataType, ArrayType) and meta.get(GEOMETRY_KEY, "").startswith("geoarrow."):
            shape = "vertices"
        elif field.dataType.simpleString() == "decimal(20,0)":
            shape = "uint64"
        plan.append((name, shape, meta))
    return plan


def _emit(
    held: list[pa.RecordBatch], plan: list, layer_id: str, batch_id: int, encoding: str
) -> pa.RecordBatch:
    source = pa.Table.from_batches(held).drop_columns(["batch_id"]).combine_chunks()
    arrays, fields = [], []
    for name, shape, meta in plan:
        array = _to_wire(_one_chunk(source.column(name)), shape, encoding)
        arrays.append(array)
        fields.append(pa.field(name, array.type, metadata=meta or None))
    body = table_bytes(pa.Table.from_arrays(arrays, schema=pa.schema(fields)), encoding)
    rows = source.num_rows
    return pa.RecordBatch.from_pydict(
        {
            "layer_id": [layer_id],
            "batch_id": pa.array([batch_id], pa.int64()),
            "num_rows": pa.array([rows], pa.int64()),
            "encoding": [encoding],
            "byte_length": pa.array([len(body)], pa.int64()),
            "payload": pa.array([body], pa.binary()),
        }
    )


def _to_wire(array: pa.Array, shape: str, encoding: str) -> pa.Array:
    if encoding == "parquet" and array.null_count and shape in ("color", "fixed"):
        # Parquet holds no null lists of fixed length: such a column stays variable.
        element = pa.uint8() if shape == "color" else array.type.value_type
        return array.cast(pa.list_(pa.field("element", element)))
    if shape == "uint64":
        return array.cast(pa.decimal128(20, 0)).cast(pa.uint64())
    if shape == "color":
        return _fixed_size(array, pa.uint8(), "")
    if shape == "fixed":
        return _fixed_size(array, array.type.value_type, "xy")
    if shape == "vertices":
        return _fixed_vertices(array)
    return array


def _fixed_vertices(array: pa.Array) -> pa.Array:
    """Nested lists whose innermost lists, the vertices, have one fixed length."""
    inner = array.type.value_type
    if not (pa.types.is_list(inner) or pa.types.is_large_list(inner)):
        return _fixed_size(array, inner, "xy")
    # "values" keeps offsets valid where null rows still own children.
    values = _fixed_vertices(array.values)
    field = pa.field("element", values.type)
    return pa.ListArray.from_arrays(
        pa.array(array.offsets), values, type=pa.list_(field), mask=array.is_null() if array.null_count else None
    )


def _fixed_size(array: pa.Array, element: pa.DataType, name: str) -> pa.Array:
    """Variable list to fixed-size list; null rows stay null, other lengths must agree."""
    lengths = np.asarray(array.value_lengths().fill_null(-1))
    known = np.unique(lengths[lengths >= 0])
    if len(known) > 1:
        raise ValueError(f"lists of one column must have one length, found {known.tolist()}")
    size = int(known[0]) if len(known) else 2
    child = {2: "xy", 3: "xyz"}.get(size, name) if name == "xy" else name
    starts = np.asarray(array.offsets)[:-1].astype(np.int64)
    slots = (starts[:, None] + np.arange(size)).reshape(-1)
    missing = np.repeat(lengths < 0, size)
    slots[missing] = 0
    values = array.values.take(pa.array(slots, pa.int64(), mask=missing)).cast(element)
    return pa.FixedSizeListArray.from_arrays(
        values, type=pa.list_(pa.field(child, element), size), mask=array.is_null() if array.null_count else None
    )


def _one_chunk(column: pa.ChunkedArray) -> pa.Array:
    merged = column.combine_chunks()
    return merged.chunk(0) if isinstance(merged, pa.ChunkedArray) else merged
