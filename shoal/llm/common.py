"""Helpers shared by the operators: input tables, scratch tables, Arrow text buffers."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from shoal.session import checkpoint_dir

#: Bytes of text handled at once inside a task; a longer single text is handled alone.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts the lineage: what is lost with an executor is read again from the
    shared files, not from a cache.
    """
    spark = df.sparkSession
    path = posixpath.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column in a row, and where each row starts (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges ``[lo, hi)`` of about ``most`` bytes; at least one row each."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES):
    """``(lo, hi, bytes, offsets)`` of each chunk of a string column."""
    data, offsets = utf8(column)
    for lo, hi in chunks(offsets, most):
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
    del data
    pa.default_memory_pool().release_unused()  # workers live on between batches


def arrow_schema(**fields: pa.DataType) -> pa.Schema:
    return pa.schema(list(fields.items()))


def ragged(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and row lengths."""
    off = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, kind))


def blobs(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
