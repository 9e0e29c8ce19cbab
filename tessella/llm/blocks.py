"""Columns of numbers as one binary value, for rows that only Python reads.

A row for each number costs the JVM far more than the number: a block of thousands is shuffled as one row.
"""

from __future__ import annotations

import numpy as np

_KINDS = [np.uint8, np.uint16, np.uint32, np.uint64]


def pack(columns: list[np.ndarray]) -> bytes:
    """The columns, of equal length; signed ones as differences from their least value, in as few bytes as it takes.

    A column's lowest bytes come first, then the next: high bytes are mostly alike, so the shuffle compresses them.
    """
    parts, head = [], [len(columns[0]), len(columns)]
    for x in columns:
        base, signed = 0, x.dtype.kind == "i"
        if signed and len(x):
            base = int(x.min())
            x = (x.astype(np.int64) - base).view(np.uint64)
        kind = next(k for k, t in enumerate(_KINDS) if not len(x) or int(x.max()) <= np.iinfo(t).max)
        x = x.astype(_KINDS[kind])
        # Shifts byte by byte are several times faster than a transposed copy.
        parts += [(x >> _KINDS[kind](8 * k)).astype(np.uint8).tobytes() for k in range(1 << kind)]
        head += [kind, int(signed), base]
    return np.array(head, "<i8").tobytes() + b"".join(parts)


def unpack(raw) -> list[np.ndarray]:
    """The columns of `pack`: signed ones as int64, the others as uint64."""
    n, width = np.frombuffer(raw, "<i8", 2).tolist()
    head, at, columns = np.frombuffer(raw, "<i8", 3 * width, 16).tolist(), 8 * (2 + 3 * width), []
    for kind, signed, base in zip(head[::3], head[1::3], head[2::3]):
        planes = np.frombuffer(raw, np.uint8, n << kind, at).reshape(1 << kind, n)
        at += planes.nbytes
        x = planes[0].astype(np.uint64)
        for k in range(1, 1 << kind):
            x |= planes[k].astype(np.uint64) << np.uint64(8 * k)
        columns.append(x.view(np.int64) + base if signed else x)
    return columns
