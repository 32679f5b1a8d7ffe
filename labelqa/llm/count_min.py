"""Count-min counters of 64-bit keys, gathered by Spark tasks.

Every task counts into a small array, sends its touched blocks compressed, and
the blocks are summed one by one as a stream. What reaches the driver is coded
to one byte (or bit) a counter, so its size is ``rows * width`` at most, fixed
by the caller and not by the data.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

BLOCK = 1 << 13
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def width_for(keys: int, load: float, least: int = 1 << 16, most: int = 1 << 24) -> int:
    """A power of two of about ``keys / load`` counters. ``most`` bounds what is
    held and broadcast; beyond it estimates get worse, never wrong."""
    return min(most, max(least, 1 << int(np.ceil(np.log2(max(1.0, keys / load))))))


def cells(keys: np.ndarray, width: int, row: int) -> np.ndarray:
    """Counters of ``keys`` (int64) in one row, by multiply and shift."""
    bits = int(width).bit_length() - 1
    return ((keys.view(np.uint64) * ODD[row]) >> np.uint64(64 - bits)).astype(np.int64)


def _flat(column) -> np.ndarray:
    column = column.flatten() if pa.types.is_list(column.type) else column
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


class Counters:
    """One task's counters."""

    def __init__(self, width: int, rows: int = 1):
        self.width, self.rows = width, rows
        self.total = np.zeros(rows * width, np.uint32)

    def add(self, keys: np.ndarray) -> None:
        top = np.iinfo(np.uint32).max
        for row in range(self.rows):
            at, n = np.unique(cells(keys, self.width, row) + row * self.width, return_counts=True)
            self.total[at] = np.minimum(self.total[at].astype(np.int64) + n, top)

    def blocks(self):
        """``(first counter, compressed block)`` of the blocks that were touched."""
        codec = zstandard.ZstdCompressor(level=1)
        for at in range(0, len(self.total), BLOCK):
            part = self.total[at:at + BLOCK]
            if part.any():
                yield at, codec.compress(part.tobytes())


def merged(parts: DataFrame, width: int, rows: int, code: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``parts(block, data)`` of all tasks -> ``code(counts)`` for the ``rows * width`` counters."""

    def add(batches):
        """Rows in order of block; one block is held at a time."""
        codec = zstandard.ZstdDecompressor()
        at, total = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([code(total).tobytes()], pa.binary())], ["block", "data"])

        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block != at:
                    if at is not None:
                        yield out()
                    at, total = block, np.zeros(BLOCK, np.int64)
                total += np.frombuffer(codec.decompress(data), np.uint32)
        if at is not None:
            yield out()

    done = parts.repartition("block").sortWithinPartitions("block").mapInArrow(add, "block long, data binary")
    none = code(np.zeros(BLOCK, np.int64))
    table = np.tile(none, rows * width // BLOCK)
    for row in done.collect():          # bounded as the table is; an iterator would run one job a partition
        found = np.frombuffer(row["data"], np.uint8)
        start = row["block"] // BLOCK * len(none)
        table[start:start + len(none)] = found
    return table


def counters(keys: DataFrame, width: int, rows: int, code: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``keys`` has one column, a long or an array of longs without nulls.
    Returns ``code(counts)`` (uint8 out) for the ``rows * width`` counters."""

    def gather(batches):
        own = Counters(width, rows)
        for batch in batches:
            own.add(_flat(batch.column(0)))
        for at, data in own.blocks():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([data], pa.binary())], ["block", "data"])

    return merged(keys.mapInArrow(gather, "block long, data binary"), width, rows, code)
