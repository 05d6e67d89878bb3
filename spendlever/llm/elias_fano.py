"""Elias-Fano sequences and the levels of an n-gram trie, in one mappable buffer.

A sequence of n whole numbers that never falls, below u, keeps the low floor(log2(u / n)) bits of
each number packed one after the other, and the rest as gaps in unary: about 2 + log2(u / n) bits a
number. A number is read by one select, and the first number not below x is found by a select of
zeros and a binary search among the numbers with the same high part.

A ``Trie`` holds one level of contexts and the successors below them. Contexts are sorted hashes.
A context's successors begin at its pointer; they are kept relative to their context, as sorted
fingerprints above the context's place in its level, so that one sequence that never falls holds
the whole level and a search for a successor can't leave its context. Next to each successor stands
one byte, the number of its smoothed value in a code book. Everything is read in place from a buffer,
which may be a mapped file.
"""

from __future__ import annotations

import json
import mmap

import numpy as np

FINGERPRINT_BITS = 40
_ONE = np.uint64(1)


def _u(x) -> np.ndarray:
    return np.asarray(x).astype(np.uint64)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` bits of each value, one after the other in 64-bit words; a spare word at the end."""
    words = np.zeros((len(values) * width + 63) // 64 + 2, np.uint64)
    if width and len(values):
        at = np.arange(len(values), dtype=np.int64) * width
        shift = _u(at & 63)
        _join(words, at >> 6, values << shift)
        spill = np.flatnonzero((at & 63) + width > 64)
        words[(at[spill] >> 6) + 1] |= values[spill] >> (np.uint64(64) - shift[spill])  # one value at most spills into a word
    return words


def _join(words: np.ndarray, place: np.ndarray, bits: np.ndarray) -> None:
    """Set ``bits`` in the words at ``place``, which never falls."""
    if len(place):
        first = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
        words[place[first]] |= np.bitwise_or.reduceat(bits, first)


def _unpacked(words: np.ndarray, width: int, place: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(place), np.uint64)
    at = place * width
    shift = _u(at & 63)
    high = np.where(shift > 0, words[(at >> 6) + 1] << (np.uint64(64) - np.maximum(shift, _ONE)), np.uint64(0))
    return (words[at >> 6] >> shift | high) & np.uint64((1 << width) - 1)


class Sequence:
    """Numbers that never fall, read in place."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones = np.concatenate(([0], np.cumsum(ones)))  # the directory: ones before each word
        self.zeros = np.arange(len(high) + 1) * 64 - self.ones

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> Sequence:
        values, n = _u(values), len(values)
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        at = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(((universe >> width) + n) // 64 + 2, np.uint64)
        _join(high, at >> 6, _ONE << _u(at & 63))
        return cls(n, width, _packed(values & np.uint64((1 << width) - 1), width), high)

    def _select(self, k: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the k-th one, or zero, counted from 0."""
        word = np.searchsorted(before, k, "right") - 1
        bits = self.high[word]
        bits = ~bits if flip else bits
        left, place = k - before[word], np.zeros(len(k), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            part = bits & np.uint64((1 << half) - 1)
            count = np.bitwise_count(part).astype(np.int64)
            beyond = left >= count
            left -= np.where(beyond, count, 0)
            place += np.where(beyond, half, 0)
            bits = np.where(beyond, bits >> np.uint64(half), part)
        return word * 64 + place

    def at(self, place: np.ndarray) -> np.ndarray:
        """The numbers at these places."""
        place = np.asarray(place, np.int64)
        high = self._select(place, self.ones, False) - place
        return _u(high) << np.uint64(self.width) | _unpacked(self.low, self.width, place)

    def all(self) -> np.ndarray:
        """All numbers, read from the first to the last."""
        place = np.arange(self.n, dtype=np.int64)
        high = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little")) - place
        return _u(high) << np.uint64(self.width) | _unpacked(self.low, self.width, place)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first number that is not below each x; n if there is none."""
        x = _u(x)
        high = x >> np.uint64(self.width)
        inside = high < np.uint64(self.zeros[-1])  # beyond the last bucket there is nothing
        bucket = np.where(inside, high, np.uint64(0)).astype(np.int64)
        first = np.where(bucket > 0, self._select(np.maximum(bucket - 1, 0), self.zeros, True) + 1 - bucket, 0)
        last = self._select(bucket, self.zeros, True) - bucket
        low = x & np.uint64((1 << self.width) - 1)
        a, b = np.minimum(first, self.n), np.minimum(last, self.n)
        while (open_ := a < b).any():
            mid = (a + b) >> 1
            less = open_ & (_unpacked(self.low, self.width, np.where(open_, mid, 0)) < low)
            a = np.where(less, mid + 1, a)
            b = np.where(open_ & ~less, mid, b)
        return np.where(inside, a, self.n)

    def parts(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "high": self.high}


def least_kind(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes each as they need."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _matched(sorted_: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted number, or -1."""
    if not len(sorted_):
        return np.full(len(wanted), -1, np.int64)
    place = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return np.where(sorted_[place] == wanted, place, -1)


class Trie:
    """One level of contexts with their successors; build with ``of``, read with ``on`` or ``map``."""

    def __init__(self, contexts: Sequence, pointers: Sequence, successors: Sequence, codes, totals, counts):
        self.contexts, self.pointers, self.successors = contexts, pointers, successors
        self.codes, self.totals, self.counts = codes, totals, counts

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, totals: np.ndarray, pointers: np.ndarray,
           fingerprints: np.ndarray, codes: np.ndarray) -> Trie:
        """``keys`` ascend; the successors of key i are fingerprints[pointers[i]:pointers[i + 1]], ascending."""
        owner = np.repeat(np.arange(len(keys), dtype=np.int64), np.diff(pointers))
        values = _u(owner) << np.uint64(FINGERPRINT_BITS) | _u(fingerprints)
        return cls(
            Sequence.of(keys, int(keys[-1]) + 1 if len(keys) else 1), Sequence.of(pointers, len(fingerprints) + 1),
            Sequence.of(values, max(1, len(keys)) << FINGERPRINT_BITS), codes.astype(np.uint8), least_kind(totals), least_kind(counts))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each context, or -1."""
        place = self.contexts.successor(keys)
        there = place < self.contexts.n
        there[there] = self.contexts.at(place[there]) == keys[there]
        return np.where(there, place, -1)

    def find_ascending(self, keys: np.ndarray) -> np.ndarray:
        """Like ``find`` for keys that never fall: one pass over the level instead of a search for each."""
        return _matched(self.contexts.all(), keys)

    def children(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the successors of these contexts begin and end."""
        return self.pointers.at(context).astype(np.int64), self.pointers.at(context + 1).astype(np.int64)

    def find_successors(self, context: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
        """Code of each successor of a context; 0 where the context, or the successor in it, is unknown."""
        out = np.zeros(len(context), np.uint8)
        known = np.flatnonzero(context >= 0)
        if len(known) and self.successors.n:
            wanted = _u(context[known]) << np.uint64(FINGERPRINT_BITS) | _u(fingerprints[known])
            place = self.successors.successor(wanted)
            there = place < self.successors.n
            there[there] = self.successors.at(place[there]) == wanted[there]
            out[known[there]] = self.codes[place[there]]
        return out

    def find_successors_ascending(self, context: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
        """Like ``find_successors`` where the known contexts, and the fingerprints in a context, never fall."""
        out = np.zeros(len(context), np.uint8)
        known = np.flatnonzero(context >= 0)
        place = _matched(self.successors.all(), _u(context[known]) << np.uint64(FINGERPRINT_BITS) | _u(fingerprints[known]))
        there = place >= 0
        out[known[there]] = self.codes[place[there]]
        return out

    def kinds(self) -> np.ndarray:
        """Number of successors of each context."""
        return np.diff(self.pointers.all().astype(np.int64))

    def tobytes(self) -> bytes:
        arrays, head = [], {"sequences": {}, "arrays": []}
        for name in ("contexts", "pointers", "successors"):
            seq = getattr(self, name)
            head["sequences"][name] = [seq.n, seq.width]
            arrays += [seq.low, seq.high]
        arrays += [self.codes, self.totals, self.counts]
        head["arrays"] = [[a.dtype.str, len(a)] for a in arrays]
        text = json.dumps(head).encode()
        text += b" " * (-len(text) % 8)
        body = b"".join(a.tobytes() + bytes(-a.nbytes % 8) for a in arrays)
        return len(text).to_bytes(8, "little") + text + body

    @classmethod
    def on(cls, buffer) -> Trie:
        """Read in place from anything with a buffer."""
        view = memoryview(buffer)
        size = int.from_bytes(view[:8], "little")
        head, at, arrays = json.loads(bytes(view[8:8 + size])), 8 + size, []
        for kind, n in head["arrays"]:
            array = np.frombuffer(view, kind, n, at)
            arrays.append(array)
            at += array.nbytes + -array.nbytes % 8
        sequences = [
            Sequence(*head["sequences"][name], arrays[2 * i], arrays[2 * i + 1])
            for i, name in enumerate(("contexts", "pointers", "successors"))]
        return cls(*sequences, *arrays[6:])

    @classmethod
    def map(cls, path: str) -> Trie:
        """Read in place from a mapped file."""
        with open(path, "rb") as file:
            return cls.on(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
