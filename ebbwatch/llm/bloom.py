"""Bloom filters of a column of longs, of bounded size: with more values they only let more through."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ebbwatch.llm.common import Batches, map_batches

MOST_BYTES = 64 << 20
_SHIFTS = (0, 17, 33)  # of hashed values


def _bits(values: np.ndarray, bits: int) -> list[np.ndarray]:
    keys = values.astype(np.int64).view(np.uint64)
    return [(keys >> np.uint64(s) & np.uint64(bits - 1)).astype(np.int64) for s in _SHIFTS]


def bloom_filter(values: DataFrame, n: int) -> np.ndarray:
    """Of a frame with one column of about n hashes; made in eight parts, which the driver joins one by one."""
    bits = min(MOST_BYTES * 8, 1 << max(13, (12 * n).bit_length()))

    def work(batches: Batches) -> Batches:
        table = np.zeros(bits // 8, np.uint8)
        for b in batches:
            for at in _bits(b.column(0).to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(table, at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8)))
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary())], ["table"])

    table = np.zeros(bits // 8, np.uint8)
    for row in map_batches(values.coalesce(8), work, "table binary").toLocalIterator():
        table |= np.frombuffer(row[0], np.uint8)
    return table


def may_hold(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    keep = np.ones(len(values), bool)
    for at in _bits(values, len(table) * 8):
        keep &= (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return keep
