"""Bounded-space online best-fit packing of tokenised documents (operator 3).

One pass tokenises, cuts documents longer than a sequence and keeps a row per piece; texts are not shuffled.
Pieces are then dealt by document order into packers of about `packer_tokens` tokens, whatever the number of
input files.  A packer keeps at most `open_bins` unfinished sequences, indexed by a bitset over free space:
a piece goes to the sequence with the least room that still takes it; where none does and no further one may
be opened, the fullest is closed.  Memory is one bitset and `open_bins` entries per task.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, materialise, table, tidy
from .tokens import END, TokenIds, in_slices

LENGTH = 4096
OPEN_BINS = 512
PACKER_TOKENS = 64_000_000
BATCH = 1000  # texts that a task takes at once
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """`place(n)` gives (sequence, offset) for a piece of n tokens; sequences are numbered from 0."""

    def __init__(self, length: int = LENGTH, open_bins: int = OPEN_BINS):
        self.length, self.open_bins = length, open_bins
        self.free = 0  # bit f: some open sequence has f tokens of room
        self.by_room: dict[int, list[int]] = {}
        self.open = self.made = 0

    def _take(self, room: int) -> int:
        own = self.by_room[room]
        sequence = own.pop()
        if not own:
            del self.by_room[room]
            self.free &= ~(1 << room)
        self.open -= 1
        return sequence

    def place(self, n: int) -> tuple[int, int]:
        if not 0 < n <= self.length:
            raise ValueError(f"a piece of {n} tokens doesn't fit in {self.length}")
        wide = self.free >> n
        if wide:
            room = n + (wide & -wide).bit_length() - 1
            sequence = self._take(room)
        else:
            room, sequence = self.length, self.made
            self.made += 1
            if n < room and self.open >= self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
        if room > n:
            self.by_room.setdefault(room - n, []).append(sequence)
            self.free |= 1 << (room - n)
            self.open += 1
        return sequence, self.length - room


def token_pieces(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None) -> DataFrame:
    """The pieces of every document: its identifiers, then the end identifier, cut each `length` tokens."""

    def cut(batches):
        ids_of = TokenIds.open(vocabulary)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = [[], [], [], [], []]
            for first, own in in_slices(x.as_py() for x in batch.column(1)):
                for k, tokens in enumerate(ids_of.of_all(own), first):
                    tokens += END.to_bytes(4, "little")
                    for piece, at in enumerate(range(0, len(tokens), 4 * length)):
                        part = tokens[at : at + 4 * length]
                        for column, value in zip(out, (ids[k], piece, at // 4, len(part) // 4, zlib.crc32(part))):
                            column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(cut, tokens=True), PIECES)


def pack(pieces: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, packer_tokens: int = PACKER_TOKENS) -> DataFrame:
    """`pieces` with sequence_id and offset; `pieces` should be a table, as it is read twice."""
    total = pieces.agg(F.sum("length")).first()[0] or 0
    packers = max(1, -(-total // packer_tokens))

    def fill(batches):
        bins, base = BestFit(length, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + s for s, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                [*batch.schema.names, "sequence_id", "offset"],
            )

    order = ["doc_id", "piece", "ids_crc32", "length"]
    dealt = pieces.repartitionByRange(packers, *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(tidy(fill), f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None, **bins) -> DataFrame:
    """One row per piece of `docs` (doc_id, text) with its sequence and place.

    A null or empty text is the end identifier alone; a null doc_id stays null; a text longer than a sequence
    is cut, whatever its length; repeated rows are packed each; an empty table gives an empty one; other
    columns are ignored.
    """
    with batches_of(docs.sparkSession, BATCH):
        pieces = materialise(token_pieces(docs, length, vocabulary), "pieces")
    return pack(pieces, length, **bins)


def op3_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))
