"""Shared pieces: text as bytes for the Python workers, slices of bounded size, label samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Python workers look at this much text at a time, whatever the size of an Arrow batch.
SLICE_BYTES = 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(text: str = "text") -> Column:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and offsets of a binary array without a copy: value ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""
    kind = np.int64 if pa.types.is_large_binary(array.type) else np.int32
    _, offsets, data = array.buffers()
    n = len(array)
    if not n or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, kind)[array.offset : array.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole, at


def slices(array: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer text is a range of its own."""
    _, at = bytes_of(array)
    low = 0
    while low < len(array):
        high = int(np.searchsorted(at, at[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), len(array))
        yield low, high
        low = high


def label_sample(labels: DataFrame, label: str, limit: int, learn: Column) -> DataFrame:
    """``(doc_id, label)`` of at most ``limit`` labelled rows for which ``learn`` holds, the same rows every time.

    Rows with a null id or label are left out; of several labels for one id the smallest counts.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learn)
    unique = usable.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    return unique.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
