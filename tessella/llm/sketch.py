"""How often hashes occur, folded into a fixed number of slots.

The sketch only puts words or shingles in an order, rarest first, for prefix filters.  Any order that all tasks
share gives the same result, so its size is fixed whatever the corpus; hashes that share a slot count together.
Tasks send their counts as bytes on a scale that is exact below 16, and sums are made in two steps, so that no task
takes in more than a fixed share of them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy
from .words import SMALL_CHUNK, U, Chunk, chunks

SLOTS = 1 << 22
PIECE = 1 << 18
TASKS = 256  # whose counts are summed together at first
_VALUES = np.array([k if k < 16 else round(16 * 2 ** ((k - 16) / 8)) for k in range(256)], np.uint64)
_SCHEMA = "piece int, part long, counts binary"


def _coded(n: np.ndarray) -> bytes:
    return np.where(n < 16, n, np.minimum(255, 16 + np.rint(8 * np.log2(np.maximum(n, 16) / 16)))).astype(np.uint8).tobytes()


def _row(piece: int, part: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([part], pa.int64()), pa.array([_coded(counts)], pa.binary())], ["piece", "part", "counts"])


def _counted(hashes_of: Callable[[Chunk], np.ndarray]):
    def count(batches):
        sums = np.zeros(SLOTS, np.uint32)
        for batch in batches:
            for c in chunks(batch.column(0), size=SMALL_CHUNK):
                np.add.at(sums, (hashes_of(c) & U(SLOTS - 1)).view(np.int64), np.uint32(1))
        part = TaskContext.get().partitionId() // TASKS
        for piece, own in enumerate(sums.reshape(-1, PIECE)):
            if own.any():
                yield _row(piece, part, own)

    return count


def _summed(batches):
    """Rows in the order of (piece, part), those of one key added up."""
    key, sums = None, np.zeros(PIECE, np.uint64)
    for batch in batches:
        for piece, part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if key not in (None, (piece, part)):
                yield _row(*key, sums)
                sums[:] = 0
            key = piece, part
            sums += _VALUES[np.frombuffer(counts.as_buffer(), np.uint8)]
    if key is not None:
        yield _row(*key, sums)


def rarity_levels(texts: DataFrame, hashes_of: Callable[[Chunk], np.ndarray]) -> tuple[np.ndarray, int]:
    """(levels, total): for each of SLOTS slots 0 where its hashes occur once at most in `texts` (text), else a number
    from 3 to 63 that grows by two whenever their count doubles; and about how many hashes there are in all."""
    parts = texts.select("text").mapInArrow(tidy(_counted(hashes_of)), _SCHEMA)
    for _ in range(2):
        parts = parts.repartition("piece", "part").sortWithinPartitions("piece", "part").mapInArrow(tidy(_summed), _SCHEMA).withColumn("part", F.lit(0).cast("long"))
    counts = np.zeros(SLOTS, np.uint8)
    for row in parts.collect():
        counts[row.piece * PIECE : (row.piece + 1) * PIECE] = np.frombuffer(row.counts, np.uint8)
    return level_of(_VALUES)[counts], int(_VALUES[counts].sum())


def level_of(n) -> np.ndarray:
    """The level of a slot that is counted `n` times."""
    n = np.asarray(n, np.uint64)
    return np.where(n < 2, 0, np.minimum(63, np.floor(2 * np.log2(np.maximum(n, 1))) + 1)).astype(np.uint8)
