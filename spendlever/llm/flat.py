"""Texts of an Arrow batch as flat numpy arrays: bytes, word bounds, word hashes.

Work is done on a few megabytes of text at a time, so memory follows the longest
single document, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
#: For stages that share their worker processes with others: numpy needs about 50 times a block, and keeps much of it.
SMALL_CHUNK_BYTES = 1 << 19
#: Space, tab, line feed, vertical tab, form feed, carriage return.
WORD_BREAKS = bytes([32, 9, 10, 11, 12, 13])

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def byte_set(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


_BREAK = byte_set(WORD_BREAKS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if len(offsets) == 0:
        offsets = np.zeros(1, np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together hold at most ``limit`` bytes; one longer text is a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), n)
        yield row, stop
        row = stop


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the n + 1 positions in them where each row's words begin."""
    inside = ~_BREAK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    begins[cuts] = inside[cuts]  # a text ends the word of the text before it
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = cuts[cuts > 0] - 1
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII capitals made small."""
    return _LOWER[data]


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        size = (1 << max(n - 2, 0).bit_length()) + 1
        for name, base in (("_powers", _BASE), ("_inverses", _BASE_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            globals()[name] = np.cumprod(table, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the hash base, and of its inverse, modulo 2 ** 64."""
    _grow(n)
    return _powers, _inverses


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each byte range, from prefix sums of a polynomial."""
    _grow(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[:len(data)], dtype=np.uint64, out=sums[1:])
    raw = (sums[ends] - sums[starts]) * _inverses[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = starts - np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.repeat(shift, lengths) + np.arange(total, dtype=np.int64)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
