"""Text columns as flat byte arrays, and vectorised words and hashes over them.

Arrow hands a binary column over as one buffer plus offsets. The helpers work on runs of
whole rows of a bounded size, so memory does not follow the size of an Arrow batch; a row
that is larger than the bound is a run of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_powers = {}


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    size = np.dtype(kind).itemsize
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * size).astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def runs(offsets: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most limit bytes, or of one row."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of the rolling hash and of its inverse, modulo 2^64."""
    have = _powers.get("p")
    if have is None or len(have[0]) < n:
        n = max(n, 2 * RUN_BYTES)
        p = np.full(n, _P, np.uint64)
        p[0] = 1
        back = np.full(n, np.uint64(pow(int(_P), -1, 1 << 64)), np.uint64)
        back[0] = 1
        _powers["p"] = have = np.multiply.accumulate(p), np.multiply.accumulate(back)
    return have


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _P
    return h ^ (h >> np.uint64(32))


def prefix_sums(body: np.ndarray) -> np.ndarray:
    """Sums of byte times power up to each place; their differences hash any piece."""
    p, _ = powers(len(body) + 1)
    out = np.zeros(len(body) + 1, np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * p[: len(body)], out=out[1:])
    return out


def piece_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, back = powers(len(sums))
    return mixed((sums[end] - sums[start]) * back[start])


def spans_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the maximal runs of True, cut at row ends."""
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    begins[cuts] = inside[cuts]
    ends = np.zeros(n + 1, bool)
    ends[1:n] = inside[:-1] & ~inside[1:]
    ends[n] = inside[-1]
    cuts = cuts[cuts > 0]
    ends[cuts] = inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return start, end, np.searchsorted(offsets, start, "right") - 1


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive bounds."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def table(wanted: str) -> np.ndarray:
    """A lookup of 256 flags from a byte-class pattern."""
    import re

    return np.array([bool(re.fullmatch(wanted.encode("latin-1"), bytes([b]), re.S)) for b in range(256)])
