"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of words with smallest period q, at least ``LEAST_WORDS`` long and ``EXPONENT``
times as long as q, that no neighbouring word extends with period q. All texts of a few
megabytes are one sequence of word numbers, with a number of its own after every text.

At scale t = 4, 8, 16, ... a position is selected if, among the hashes of the t-word windows
that start in the t + 1 places from it on, the least one stands first or last. The choice
depends on the next 2t words alone, so equal contexts are selected alike. Windows of a period of
at most t / 3 are left out of the minimum, and every stretch of 3t - 1 words without such a period holds a
selected position among its first t. So a run of period p, 1.5 t <= p < 3t, holds a selected position
whose context returns p words later. Selected positions of one context lie more than t / 3 apart:
eight neighbours in the list of a context are all that can propose such a p. A proposed period is
extended to both sides by binary search over prefix hashes, and each stretch is then compared
word by word.

The highly periodic regions, which the selection leaves out, are detected separately: periods
of up to 5 words by direct comparison, longer ones as the runs of the smaller scales. They supply the
small periods, and at each scale the windows to leave out. A multiple of a run's period gives the
same stretch, of which the smallest period is kept.

Work per text is O(n log n), and no text leaves its task.

Defined results. Null text has no words. Rows are judged one by one, so repeated rows repeat their
result. The columns ``n_words``, ``runs`` and ``collapsed`` replace input columns of these names;
others are kept. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from spendlever.llm import flat
from spendlever.llm.stages import without

LEAST_WORDS = 24
EXPONENT = 3
#: Periods up to this are found by comparing the text with itself.
DIRECT = 5
FIRST_SCALE = 4
#: Selected positions of one context are more than a third of a scale apart, periods below three scales.
NEIGHBOURS = 8

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words and for these only."""
    code, _ = pd.factorize(flat.hashes(data, starts, ends))
    first = np.zeros(code.max() + 1 if len(code) else 0, np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    size, twin = ends - starts, first[code]
    if (size == size[twin]).all() and (data[flat.ranges(starts, size)] == data[flat.ranges(starts[twin], size)]).all():
        return code.astype(np.int64)
    body = data.tobytes()  # two words of one hash
    return pd.factorize(np.array([body[a:b] for a, b in zip(starts.tolist(), ends.tolist())] + [None], object)[:-1])[0].astype(np.int64)


class Sequence:
    """Word numbers of several texts, each followed by a number that occurs once."""

    def __init__(self, texts: list[np.ndarray]):
        size = np.array([len(t) + 1 for t in texts], np.int64)
        self.begin = np.concatenate(([0], np.cumsum(size)))
        self.words = np.empty(int(self.begin[-1]), np.int64)
        for a, t in zip(self.begin.tolist(), texts):
            self.words[a:a + len(t)] = t
        self.words[self.begin[1:] - 1] = -1 - np.arange(len(texts))
        self.n = len(self.words)
        value = flat.mix(self.words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        powers, self.inverses = flat.powers(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(value * powers[:self.n], dtype=np.uint64, out=self.sums[1:])

    def window(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Hash of the ``size`` words from each start on."""
        return (self.sums[start + size] - self.sums[start]) * self.inverses[start]

    def common(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words agree from a and b on (a < b), or before them."""
        agreed = np.zeros(len(a), np.int64)
        step = 1 << max(self.n, 1).bit_length()
        while step:
            if back:
                fits = a - agreed - step >= 0
                at, to = a - agreed - step, b - agreed - step
            else:
                fits = b + agreed + step <= self.n
                at, to = a + agreed, b + agreed
            which = np.flatnonzero(fits)
            same = self.window(at[which], step) == self.window(to[which], step)
            agreed[which[same]] += step
            step >>= 1
        return agreed


def _stretches(equal: np.ndarray, period: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal stretches of a period; ``equal[i]``: word i equals word i + period."""
    edge = np.diff(np.concatenate(([0], equal.view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + period
    long = end - start >= least
    return start[long], end[long]


def _selected(seq: Sequence, scale: int, periodic: list[np.ndarray]) -> np.ndarray:
    """The synchronising set of a scale. ``periodic``: (start, end, period) of regions found before."""
    places = seq.n - 2 * scale + 1
    if places <= 0:
        return np.zeros(0, np.int64)
    ident = flat.mix(seq.window(np.arange(seq.n - scale + 1), scale))
    out = np.zeros(seq.n + 1, np.int64)
    for start, end, period in periodic:
        fits = (3 * period <= scale) & (end - start >= scale)
        np.add.at(out, start[fits], 1)
        np.add.at(out, end[fits] - scale + 1, -1)
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    ident[np.cumsum(out)[:len(ident)] > 0] = most
    least, width = ident, 1
    while width < scale:
        least = np.minimum(least[:len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[:places], least[1:places + 1])
    return np.flatnonzero((least != most) & ((least == ident[:places]) | (least == ident[scale:scale + places])))


def _proposed(seq: Sequence, scale: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of selected positions with one context, (3/2) scale to 3 scales apart: position and distance."""
    context = seq.window(places, 2 * scale)
    order = np.lexsort((places, context))
    place, context = places[order], context[order]
    found = []
    for step in range(1, NEIGHBOURS + 1):
        gap = place[step:] - place[:-step]
        fits = (context[step:] == context[:-step]) & (2 * gap >= 3 * scale) & (gap < 3 * scale)
        found.append((place[:-step][fits], gap[fits]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _extended(seq: Sequence, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct maximal stretches around the proposed places, compared word by word."""
    start = place - seq.common(place, place + period, back=True)
    end = place + period + seq.common(place, place + period)
    long = end - start >= EXPONENT * period
    found = np.unique(np.stack([start[long], end[long], period[long]]), axis=1)
    good = []
    for a, b, p in found.T.tolist():
        if (seq.words[a:b - p] == seq.words[a + p:b]).all():
            good.append(([a], [b], [p]))
        else:  # two stretches of one hash: compare all words at this distance
            more = _stretches(seq.words[:-p] == seq.words[p:], p, EXPONENT * p)
            good.append((*more, np.full(len(more[0]), p)))
    if not good:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*good))


def _shared(regions: list[tuple[np.ndarray, ...]], keep: np.ndarray, begin: np.ndarray, now: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Regions of the texts that are kept, moved to where these texts now begin."""
    moved = []
    for start, end, period in regions:
        text = np.searchsorted(begin, start, "right") - 1
        place = np.cumsum(keep) - 1
        stay = keep[text]
        shift = now[place[text[stay]]] - begin[text[stay]]
        moved.append((start[stay] + shift, end[stay] + shift, period[stay]))
    return moved


def runs_of(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run, by text, start and period. A text is its word numbers."""
    whole = Sequence(texts)
    regions = []
    for period in range(1, DIRECT + 1):
        if whole.n > period:
            start, end = _stretches(whole.words[:-period] == whole.words[period:], period, EXPONENT * period)
            regions.append((start, end, np.full(len(start), period)))
    size = np.diff(whole.begin) - 1
    scale = FIRST_SCALE
    while True:
        # A run of this scale's periods has 4.5 scales of words at least.
        keep = size >= max(LEAST_WORDS, (9 * scale) // 2)
        if not keep.any():
            break
        part = whole if keep.all() else Sequence([t for t, k in zip(texts, keep) if k])
        known = _shared(regions, keep, whole.begin[:-1], part.begin[:-1])
        place, period = _proposed(part, scale, _selected(part, scale, known))
        found = _extended(part, place, period)
        regions += _shared([found], np.ones(int(keep.sum()), bool), part.begin[:-1], whole.begin[:-1][keep])
        scale *= 2
    start, end, period = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*regions)) if regions else [np.zeros(0, np.int64)] * 3
    long = end - start >= np.maximum(LEAST_WORDS, EXPONENT * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    fresh = np.ones(len(start), bool)  # the smallest period of each stretch
    fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[fresh], end[fresh], period[fresh]
    text = np.searchsorted(whole.begin, start, "right") - 1
    order = np.lexsort((period, start))
    return text[order], (start - whole.begin[text])[order], (end - start)[order], period[order]


def _analysed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of words, runs and collapsed text of every row."""
    starts, ends, rows = flat.words(data, offsets)
    n = np.diff(rows)
    number = word_numbers(data, starts, ends)
    text, start, length, period = runs_of([number[a:b] for a, b in zip(rows[:-1], rows[1:])])
    entry = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], names=["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(n) + 1)).astype(np.int32)), entry)
    drop = np.zeros(len(number) + 1, np.int64)
    np.add.at(drop, rows[text] + start + period, 1)
    np.add.at(drop, rows[text] + start + length, -1)
    kept = np.cumsum(drop)[:-1] == 0
    # Words that stay, with one space between those of a text.
    size = (ends - starts)[kept]
    last = np.concatenate(([0], np.cumsum(kept)))[rows]
    place = np.concatenate(([0], np.cumsum(size + 1)))
    body = np.full(int(place[-1]), 32, np.uint8)
    body[flat.ranges(place[:-1], size)] = data[flat.ranges(starts[kept], size)]
    begin, stop = place[last[:-1]], place[last[1:]]
    collapsed = [body[a:max(a, b - 1)].tobytes() for a, b in zip(begin.tolist(), stop.tolist())]
    return n, runs, pa.array(collapsed, pa.binary()).cast(pa.string())


def periodic_runs(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``runs`` (start, length, period) and ``collapsed``.

    ``collapsed`` is the text with one space between words and without the words that a run
    contains after its first period.
    """
    df = without(df, *[c for c in ("n_words", "runs", "collapsed") if c != text_col])
    place = df.columns.index(text_col)
    schema = T.StructType([
        *df.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat.utf8(batch.column(place))
            for a, b in flat.chunks(offsets):
                n, runs, collapsed = _analysed(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(n, pa.int64()), runs.cast(_RUNS), collapsed], names=schema.names)

    return df.mapInArrow(run, schema)
