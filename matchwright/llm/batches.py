"""Arrow batches of texts: cut into slices of bounded bytes, words as bytes."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8(text: str | Column) -> Column:
    """The bytes of a text; none for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into pieces of about ``most`` bytes of text (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_slices(
    df: DataFrame,
    text: str,
    schema: str | StructType,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
) -> DataFrame:
    """``mapInArrow`` over slices; ``make`` builds a task's function once.

    Python workers outlive their tasks: what a task held is given back at its
    end, and cycles are collected again if ``make`` turned that off.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        try:
            for batch in batches:
                for piece in slices(batch, text):
                    yield work(piece)
        finally:
            work = batch = piece = None
            gc.enable()
            gc.collect()
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def gram_codes(texts: list[bytes], n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte n-grams of all texts, and where each text's grams start.

    A gram never crosses from one text into the next; texts shorter than ``n``
    have none. n is 8 at most.
    """
    joined = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(lengths - n + 1, 0)
    starts = np.concatenate([[0], np.cumsum(counts)])
    if len(joined) < n:
        return np.zeros(0, np.int64), starts
    code = joined[: len(joined) - n + 1].astype(np.uint64)
    for k in range(1, n):
        code |= joined[k : len(joined) - n + 1 + k].astype(np.uint64) << np.uint64(8 * k)
    code *= np.uint64(0x9E3779B97F4A7C15)
    code >>= np.uint64(64 - bits)
    inside = np.ones(len(joined), bool)
    ends = np.cumsum(lengths)
    for k in range(1, n):
        at = ends - k
        inside[at[(at >= 0) & (at >= ends - lengths)]] = False
    return code[inside[: len(code)]].astype(np.int64), starts
