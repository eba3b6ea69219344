"""Unit vectors for the vector operators: one row per record."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space that may stand around a vector in text.
_SPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _not_json(name: str) -> None:
    raise ValueError(name)


def unit(value: str | list | None, dim: int) -> np.ndarray | None:
    """The vector over its length, None if it is not usable: not ``dim`` finite numbers, or all zero.

    Text must be a JSON array of numbers, outer white space allowed.
    """
    if isinstance(value, str):
        try:
            value = json.loads(value.strip(_SPACE), parse_constant=_not_json)
        except (ValueError, RecursionError):
            return None
    if not isinstance(value, list) or len(value) != dim or not all(type(x) is int or type(x) is float for x in value):
        return None
    try:
        v = np.array(value, np.float64)
    except OverflowError:
        return None
    top = np.abs(v).max(initial=0.0)
    if not 0 < top < np.inf:
        return None
    v /= top  # so that no scale over- or underflows
    return v / np.sqrt(v @ v)


def _units(df: DataFrame, record: str, vector: str, dim: int, dtype: type) -> DataFrame:
    given = F.col(f"`{vector}`")
    if dict(df.dtypes)[vector] != "string":
        given = given.cast("array<double>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [unit(x, dim) for x in batch.column(1).to_pylist()]
            at = [i for i, v in enumerate(units) if v is not None]
            rows = np.array([units[i] for i in at], dtype).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), packed(rows)], names=["record", "vector"])

    named = df.select(F.col(f"`{record}`").cast("string").alias("record"), given.alias("vector")).where(F.col("record").isNotNull() & F.col("vector").isNotNull())
    return named.mapInArrow(run, "record string, vector binary").groupBy("record").agg(F.max("vector").alias("vector"))


def unit_vectors(df: DataFrame, record: str, vector: str, dim: int) -> DataFrame:
    """(record string, vector binary) of length 1, packed as float32, for every record with a usable vector.

    ``vector`` is a number list in text or an array of numbers.  Rows that
    repeat a record count once, with one of their usable vectors, always the
    same; null records, and vectors that are null, of another length, all zero,
    not finite or not a valid list are left out.
    """
    return _units(df, record, vector, dim, np.float32)


def double_units(df: DataFrame, record: str, vector: str, dim: int) -> DataFrame:
    """``unit_vectors`` packed as float64."""
    return _units(df, record, vector, dim, np.float64)


def packed(rows: np.ndarray) -> pa.Array:
    """A binary column, the bytes of a row each: what Spark copies as one piece instead of number by number."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(0, (len(rows) + 1) * width, width, np.int64) if width else np.zeros(len(rows) + 1, np.int64)
    if ends[-1] >= 1 << 31:
        raise ValueError("too many rows for one batch")
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(rows)])


def matrix(column: pa.Array, dim: int, dtype: type = np.float32, stored: type = np.float32) -> np.ndarray:
    """The rows of a column of ``dim`` numbers each: packed numbers of type ``stored``, or a list."""
    if pa.types.is_binary(column.type):
        if not len(column):
            return np.zeros((0, dim), dtype)
        _, ends, data = column.buffers()
        ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
        flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(stored)
    else:
        flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim).astype(dtype, copy=False)


def as_packed(vectors: DataFrame, dim: int) -> DataFrame:
    """(record string, vector binary) of a frame whose vectors are packed already or arrays of numbers."""
    named = vectors.select(F.col("record").cast("string").alias("record"), "vector")
    if dict(named.dtypes)["vector"] == "binary":
        return named

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), packed(matrix(batch.column(1), dim))], names=["record", "vector"])

    return named.mapInArrow(run, "record string, vector binary")
