"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Batches = Iterator[pa.RecordBatch]
PIECES = 16  # of a long text, spread evenly over it


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns: whatever else the input holds cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null ids are in no fold."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def map_batches(df: DataFrame, work: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``mapInArrow``; a task that ends gives back the memory it does not need any more."""

    def task(batches: Batches) -> Batches:
        yield from work(batches)
        give_back()

    return df.mapInArrow(task, schema)


def give_back() -> None:
    """Workers live on for the tasks of other stages, and what their allocators have free still counts as the executor's memory."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc only
        trim(0)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a batch; null reads as empty."""
    return [t or "" for t in column.to_pylist()]


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a batch behind each other, and the n + 1 offsets (null: empty)."""
    parts = column.cast(pa.large_binary()).fill_null(b"")
    if isinstance(parts, pa.ChunkedArray):
        parts = parts.combine_chunks()
    offsets = np.frombuffer(parts.buffers()[1], np.int64, len(parts) + 1, parts.offset * 8)
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(parts.buffers()[2], np.uint8, last - first, first) if last > first else np.zeros(0, np.uint8)
    return data, offsets - first


def text_blocks(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each; a longer text has a slice of its own."""
    sizes = np.diff(joined_bytes(batch.column(column))[1])
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def excerpt(text: str, most: int) -> Column:
    """The text, or of one with more bytes than ``most`` pieces with about as many, without the words cut at their ends."""
    length, size = F.char_length(text), F.octet_length(text)
    each = F.greatest(F.lit(1), F.floor(length / size * most / PIECES).cast("int"))
    piece = lambda i: F.substring(F.col(text), (length * i / PIECES).cast("int") + 1, each)
    pieces = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda i: F.regexp_replace(piece(i), r"^\S+\s|\s\S+$", ""))
    return F.when(size > most, F.concat_ws(" ", pieces)).otherwise(F.col(text))
