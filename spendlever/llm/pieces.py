"""Distinct words of a batch of texts, so that a tokenizer sees each of them once.

Both tokenizers here cut a text before a space that follows a visible character, whatever
comes before or after. A text is therefore split there, and at further places where a
tokenizer always cuts; each distinct piece is encoded once while it is remembered, and the ids of a
text are gathered from the ids of its pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd

from spendlever.llm import flat

#: Ids of about so many bytes of distinct pieces are remembered by a worker process, in three to five times the bytes.
CACHE_BYTES = 4 << 20


def _grown(array: np.ndarray, need: int) -> np.ndarray:
    if need <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(need, 2 * len(array)) - len(array), array.dtype)])


class Ragged:
    """Growing list of integer lists in one flat array; list k is flat[ends[k]:ends[k + 1]]."""

    def __init__(self, dtype):
        self.flat, self.ends, self.n = np.zeros(1 << 16, dtype), np.zeros(1 << 12, np.int64), 0

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Append lists; returns their numbers."""
        used, n = int(self.ends[self.n]), len(sizes)
        self.flat = _grown(self.flat, used + len(values))
        self.ends = _grown(self.ends, self.n + n + 1)
        self.flat[used:used + len(values)] = values
        self.ends[self.n + 1:self.n + n + 1] = used + np.cumsum(sizes)
        self.n += n
        return np.arange(self.n - n, self.n)


class PieceCache:
    """Ids of distinct pieces, by the 64-bit hashes of their bytes, in flat arrays; emptied when it has grown to its bound."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]],
                 limit: int = CACHE_BYTES, dtype=np.int32):
        """``encode`` returns the places of its pieces in an order of its own, their ids one after the other, and the numbers of ids."""
        self.encode, self.limit, self.dtype = encode, limit, dtype
        self._empty()

    def _empty(self) -> None:
        self.names, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.bytes, self.ids = 0, Ragged(self.dtype)

    def look_up(self, names: np.ndarray, body: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size in ``self.ids.flat`` of every piece; ``names`` are the pieces' hashes, all different."""
        if self.bytes > self.limit:
            self._empty()
        at = np.searchsorted(self.names, names)
        known = at < len(self.names)
        known[known] = self.names[at[known]] == names[known]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            starts, ends = starts[fresh], ends[fresh]
            self.bytes += int((ends - starts).sum())
            order, values, sizes = self.encode([body[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
            number = np.empty(len(fresh), np.int32)
            number[order] = self.ids.extend(values, sizes)
            by_name = np.argsort(names[fresh])
            before = at[fresh[by_name]]
            self.names = np.insert(self.names, before, names[fresh[by_name]])
            self.place = np.insert(self.place, before, number[by_name])
            at = np.searchsorted(self.names, names)
        number = self.place[at]
        return self.ids.ends[number], self.ids.ends[number + 1] - self.ids.ends[number]


def cut(data: np.ndarray, offsets: np.ndarray, visible: np.ndarray, further=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every piece and the n + 1 positions of the rows in them.

    ``visible`` marks bytes that are not white space. A piece starts with a text, at each
    space after a visible byte, and where ``further`` of the bytes says so.
    """
    begins = further(data) if further else np.zeros(len(data), bool)
    begins[1:] |= (data[1:] == 32) & visible[data[:-1]]
    texts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[texts] = True
    starts = np.flatnonzero(begins)
    rows = np.searchsorted(starts, offsets)
    return starts, np.concatenate([starts[1:], [len(data)]]) if len(starts) else starts, rows


def encode_rows(
    data: np.ndarray, offsets: np.ndarray, visible: np.ndarray, cache: PieceCache, further=None
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows in one array, and the n + 1 offsets of the rows in it."""
    starts, ends, rows = cut(data, offsets, visible, further)
    code, names = pd.factorize(flat.hashes(data, starts, ends))
    first = np.zeros(code.max() + 1 if len(code) else 0, np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    begin, size = cache.look_up(names, data.tobytes(), starts[first], ends[first])
    size = size[code]
    ids = cache.ids.flat[flat.ranges(begin[code], size)]
    return ids, np.concatenate(([0], np.cumsum(size)))[rows]
