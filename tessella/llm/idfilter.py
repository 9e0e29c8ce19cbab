"""Drops most rows that a later exact join would drop, before they are shuffled."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import unused

FILTER_BITS = 1 << 24
PIECE_BITS = 1 << 18
_FOLD = 1 << 40


def bits_for(n: int) -> int:
    """Bits of a filter of `n` keys, at most 128 MB: about a sixteenth of the other keys pass; beyond that, more."""
    return min(max(PIECE_BITS, 1 << max(0, 16 * n - 1).bit_length()), 1 << 30)


def slot(key: Column, second: Column | None = None, bits: int = FILTER_BITS) -> Column:
    """A place in the bitmap, by arithmetic that `slots` repeats in numpy."""
    at = F.pmod(key, F.lit(_FOLD)) * 1000003
    return F.pmod(at + second * 7919 if second is not None else at, F.lit(bits))


def slots(key: np.ndarray, second: np.ndarray | int = 0, bits: int = FILTER_BITS) -> np.ndarray:
    return (np.mod(key, _FOLD) * 1000003 + np.asarray(second, np.int64) * 7919) % bits


def bitmap(at: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The slots in column `slot` as a bitmap of `bits` bits, whatever the number of rows: one small row a piece reaches the driver."""

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(PIECE_BITS, np.uint8)
        marks[rows["slot"].to_numpy() % PIECE_BITS] = 1
        return pd.DataFrame({"piece": [key[0]], "bits": [np.packbits(marks, bitorder="little").tobytes()]})

    pieces = at.select("slot").distinct().groupBy(F.expr(f"slot div {PIECE_BITS}").alias("piece")).applyInPandas(pack, "piece long, bits binary")
    packed = np.zeros(bits // 32, np.uint32)
    for piece, own in pieces.collect():
        packed[piece * PIECE_BITS // 32 : (piece + 1) * PIECE_BITS // 32] = np.frombuffer(own, "<u4")
    return packed


def inside(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((packed[at // 32] >> (at % 32).astype(np.uint32)) & np.uint32(1)).astype(bool)


def held(packed: np.ndarray, key: np.ndarray, second: np.ndarray | int = 0) -> np.ndarray:
    """Whether the bitmap has the keys' slots."""
    return inside(packed, slots(key, second, 32 * len(packed)))


def maybe_in(spark: SparkSession, at: Column, keys: DataFrame, bits: int = FILTER_BITS) -> Column:
    """Whether slot `at` is that of some row of `keys` (slot): always where it is one, and now and then by chance.

    Only the slots go to Python; the rest of the row, such as its text, stays in the JVM.
    """
    packed = spark.sparkContext.broadcast(bitmap(keys, bits))

    @F.pandas_udf("boolean")
    def look(slots_of: pd.Series) -> pd.Series:
        return pd.Series(inside(packed.value, slots_of.to_numpy()))

    return F.coalesce(look(F.coalesce(at, F.lit(0))), F.lit(False))


def without(docs: DataFrame, key: Column, keys: DataFrame, also: str | None = None) -> DataFrame:
    """The rows of `docs` whose `key` (a long), and column `also` if one is named, are not in `keys` (key, also).

    Only rows that may be in it are shuffled.  A key that is a hash of a row should come with a column of the row.
    """
    own, may = unused(docs, "own_key"), unused(docs, "may_go")
    bits = bits_for(keys.count())
    maybe = maybe_in(docs.sparkSession, slot(key, bits=bits), keys.select(slot(F.col("key"), bits=bits).alias("slot")), bits)
    rows = docs.withColumns({own: key, may: maybe})
    likely = F.col(may) & F.col(own).isNotNull()
    checked = rows.where(likely).join(keys.select(F.col("key").alias(own), *([also] if also else [])), [own, *([also] if also else [])], "left_anti")
    return rows.where(~likely).select(docs.columns).union(checked.select(docs.columns))
