"""Embeddings as vectors of whole numbers in a compact binary form that groups and joins well."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole steps that a component of 1.0 has, and bytes of doubles that one matrix holds at most.
STEPS, MATRIX_BYTES = 256, 8 << 20
# The largest double below 2**63.
_MOST = 9223372036854774784.0


def whole_vectors(df: DataFrame, vector: str, keep: dict[str, Column], steps: int = STEPS) -> DataFrame:
    """The `keep` columns and `x`, the vector's floor(steps * component) in bytes, of rows with a usable vector.

    A vector that is NULL, empty, or holds a NULL or non-finite component is left out.  Equal vectors have equal
    bytes: the bytes a number takes (1, 2, 4 or 8, the fewest that hold all), then the numbers.  Numbers beyond a long become the
    nearest long.
    """
    rows = df.select(F.col(vector).alias("x"), *[value.alias(name) for name, value in keep.items()])
    names = [*keep, "x"]
    schema = T.StructType([*[rows.schema[name] for name in keep], T.StructField("x", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, codes in _coded(batch.column("x"), steps):
                kept = batch.drop_columns(["x"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(codes, pa.binary())], names)

    return rows.mapInArrow(run, schema)


def _coded(lists: pa.Array, steps: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Places of usable vectors and their bytes, some rows of one length and number size at a time."""
    if pa.types.is_null(lists.type):
        return
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = pc.fill_null(pc.cast(lists.values, pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    length = np.diff(offsets)
    usable = (bad[offsets[1:]] == bad[offsets[:-1]]) & (length > 0) & np.asarray(lists.is_valid())
    for size in np.unique(length[usable]):
        places = np.flatnonzero(usable & (length == size))
        for part in np.array_split(places, -(-len(places) * 8 * int(size) // MATRIX_BYTES)):
            numbers = np.floor(steps * values[offsets[part][:, None] + np.arange(size)])
            numbers = np.clip(numbers, -_MOST, _MOST).astype(np.int64)
            low, high = numbers.min(axis=1), numbers.max(axis=1)
            wide = np.select([(low >= -(1 << b - 1)) & (high < 1 << b - 1) for b in (8, 16, 32)], [1, 2, 4], 8)
            for w in np.unique(wide):
                own = wide == w
                yield part[own], [bytes([w]) + row.tobytes() for row in numbers[own].astype(f"<i{w}")]


def dimensions(x: str = "x") -> Column:
    """Components of a vector in bytes."""
    bytes_each = F.conv(F.hex(F.substring(F.col(x), 1, 1)), 16, 10).cast("int")
    return ((F.octet_length(x) - 1) / bytes_each).cast("int")


def common_dimensions(frame: DataFrame) -> int:
    """The number of components that most vectors of the frame have, the larger one of a tie; 0 without vectors."""
    counts = frame.groupBy(dimensions().alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    row = counts.first()
    return row["d"] if row else 0


def decoded(codes: pa.Array | list[bytes], size: int) -> np.ndarray:
    """Vectors in bytes, all of one number of components, as a matrix of longs."""
    codes = codes.to_pylist() if isinstance(codes, (pa.Array, pa.ChunkedArray)) else codes
    wide = np.fromiter((code[0] for code in codes), np.int64, len(codes))
    out = np.empty((len(codes), size), np.int64)
    for w in np.unique(wide):
        own = np.flatnonzero(wide == w)
        out[own] = np.frombuffer(b"".join(codes[k][1:] for k in own), f"<i{w}").reshape(len(own), size)
    return out


def matrices(batches: Iterator[pa.RecordBatch], size: int, column: str = "x") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of the batches in slices of bounded size, each with its matrix."""
    step = max(1, MATRIX_BYTES // (8 * max(1, size)))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield part, decoded(part.column(column), size)
