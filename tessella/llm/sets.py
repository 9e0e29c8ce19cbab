"""Exact overlaps of many pairs of sets of hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .words import U

BITS = 50  # of a hash that name a member
MEMBERS = 1 << 20  # compared at once, about


def pair_overlaps(left: pa.Array, right: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last, left sizes, right sizes, shared) for slices of two columns of sets, each the bytes of sorted numbers
    of BITS bits.

    Members of all pairs of a slice are sorted at once, each under its pair's number, so that common ones stand
    together: a plain sort of numbers costs far less than a comparison pair by pair.
    """
    sides = [np.diff(np.frombuffer(x.buffers()[1], np.int32)[x.offset : x.offset + len(x) + 1]) // 8 if len(x) else np.zeros(0, np.int64) for x in (left, right)]
    upto, first = np.cumsum(sides[0] + sides[1], dtype=np.int64), 0
    while first < len(left):
        before = int(upto[first - 1]) if first else 0
        last = min(max(first + 1, int(np.searchsorted(upto, before + MEMBERS, side="right"))), first + (1 << (64 - BITS)), len(left))
        number = np.arange(last - first, dtype=np.uint64) << U(BITS)
        sizes = [s[first:last].astype(np.int64) for s in sides]
        members = [np.frombuffer(x.as_buffer(), np.uint64) | number[k] for side in (left, right) for k, x in enumerate(side[first:last])]
        both = np.sort(np.concatenate(members))
        common = (both[1:][both[1:] == both[:-1]] >> U(BITS)).astype(np.int64)
        yield first, last, *sizes, np.bincount(common, minlength=last - first)
        first = last
