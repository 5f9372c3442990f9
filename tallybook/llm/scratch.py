"""Where intermediate tables go, and how a text column reaches numpy."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.lineage import freed_shuffles, kept_in

#: Bytes of text that a task turns into arrays at once; a longer document is a slice of its own.
SLICE_BYTES = (1 << 20) - 1


def folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Both are shared by the driver and the executors of a cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, lineage cut, columns still prunable."""
    spark, path = df.sparkSession, folder(df.sparkSession)
    with freed_shuffles(spark):
        df.write.parquet(path)
    return kept_in(path, spark.read.schema(df.schema).parquet(path))


def row_key(*columns) -> "F.Column":
    """A 64-bit key of a row's id and text: rows that repeat share it, rows that differ do not."""
    return F.xxhash64(*columns)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as (bytes, offsets); nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, pa.scalar(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "", column.type))
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    held = column.buffers()
    offsets = np.frombuffer(held[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(held[2], np.uint8) if held[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(column: pa.Array, most: int = SLICE_BYTES):
    """(first row, last row + 1, bytes, offsets from 0) of runs of rows of about ``most`` bytes."""
    data, offsets = bytes_of(column)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        high = min(high, n)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high
