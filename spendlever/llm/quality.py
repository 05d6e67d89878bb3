"""Quality classifier: a factorisation machine on hashed words, structure statistics and metadata.

Features of a text are its hashed words (weighted by the logarithm of their counts, unit length),
the bins its structure statistics fall in, and hashed metadata values. Every feature has a weight and ``FACTORS`` latent
factors; the sum of all pairwise interactions is taken in linear time as half of (the square
of the sum minus the sum of squares), factor by factor.

The machine is fitted with adaptive gradient steps on at most ``SAMPLE`` labelled rows, whose features are made on
the executors; the fitted arrays (a few megabytes, of fixed size) travel with the scoring job, which is one narrow pass.

Defined results. Null text counts as empty and is scored by its statistics alone. A null metadata value is a value
of its own. Rows are independent, so repeated rows get equal scores. Without any labelled row, or with
labels of one class only, every score is the share of label 1 (one half without labels). Other columns are kept by
``scored``; an input column of the output's name is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from spendlever.llm import flat, samples
from spendlever.llm.stages import free_name, without

SAMPLE = 12_000
BUCKETS = 1 << 16
FACTORS = 8
BINS = 12
EPOCHS = 6
RATE = 0.1
DECAY = 1e-5
BATCH = 128

_SYMBOL = flat.byte_set(b"#*$%&|<>{}[]\\^~=_@")
_UPPER = flat.byte_set(bytes(range(65, 91)))
_LETTER = flat.byte_set(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_DIGIT = flat.byte_set(b"0123456789")
_STOP = flat.byte_set(b".!?")
_SHOUT = flat.byte_set(b"!")
STATISTICS = ["words", "word_length", "symbols", "capitals", "digits", "stops", "shouts", "distinct_words",
              "commonest_word", "distinct_pairs", "lines", "symbol_words"]


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _distinct(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: number of distinct values, and the count of the commonest."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    begin = np.flatnonzero(fresh)
    most = np.zeros(n)
    np.maximum.at(most, row[begin], np.diff(np.append(begin, len(row))))
    return np.bincount(row[begin], minlength=n).astype(float), most


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets and weights of all rows, the rows' n + 1 offsets in them, and the statistics."""
    n = len(offsets) - 1
    low = flat.lowered(data)
    starts, ends, rows = flat.words(low, offsets)
    word = flat.hashes(low, starts, ends)
    count = np.diff(rows)
    row = np.repeat(np.arange(n), count)
    size = np.maximum(np.diff(offsets), 1).astype(float)
    total = np.maximum(count, 1).astype(float)
    letters = np.maximum(_per_row(_LETTER[data], offsets), 1)
    distinct, most = _distinct(row, word, n)
    inner = np.flatnonzero(row[1:] == row[:-1])
    pairs, _ = _distinct(row[inner], word[inner] * np.uint64(3) + word[inner + 1], n)
    symbol = _SYMBOL[data]
    marked = np.concatenate(([0], np.cumsum(symbol)))
    marked = (marked[ends] - marked[starts]) > 0
    statistics = np.column_stack([
        np.log1p(count), _per_row(~flat._BREAK[data], offsets) / total, _per_row(symbol, offsets) / size,
        _per_row(_UPPER[data], offsets) / letters, _per_row(_DIGIT[data], offsets) / size,
        _per_row(_STOP[data], offsets) / total, _per_row(_SHOUT[data], offsets) / total, distinct / total,
        most / total, pairs / np.maximum(total - 1, 1), np.log1p(_per_row(data == 10, offsets)) - np.log1p(count),
        np.bincount(row[marked], minlength=n) / total,
    ]) if n else np.zeros((0, len(STATISTICS)))
    key, times = np.unique(row * BUCKETS + (word % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    weight = np.log1p(times)
    owner = key // BUCKETS
    norm = np.sqrt(np.bincount(owner, weights=weight * weight, minlength=n))
    bounds = np.searchsorted(owner, np.arange(n + 1))
    return (key % BUCKETS).astype(np.int32), (weight / np.maximum(norm, 1e-9)[owner]).astype(np.float32), bounds, statistics


@dataclass
class Machine:
    """Weights by feature: word buckets first, then bins of statistics, then hashed metadata."""

    edges: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    @property
    def hashed_from(self) -> int:
        return BUCKETS + len(STATISTICS) * BINS

    def assembled(self, bucket, value, bounds, statistics, metadata) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features of every row: index, value, n + 1 offsets."""
        n = len(bounds) - 1
        bins = np.column_stack([np.searchsorted(self.edges[j], statistics[:, j]) for j in range(len(STATISTICS))]) if n else \
            np.zeros((0, len(STATISTICS)), np.int64)
        dense = np.concatenate([
            BUCKETS + np.arange(len(STATISTICS)) * BINS + bins, self.hashed_from + metadata], axis=1).astype(np.int32)
        at = np.repeat(bounds[1:], dense.shape[1])
        index = np.insert(bucket, at, dense.ravel())
        return index, np.insert(value, at, np.float32(0.5)), bounds + dense.shape[1] * np.arange(n + 1)

    def margins(self, index, value, bounds) -> np.ndarray:
        first = bounds[:-1]
        if not len(first):
            return np.zeros(0)
        scaled = self.factor[index] * value[:, None]
        sums = np.add.reduceat(scaled, first)
        squares = np.add.reduceat(np.einsum("ij,ij->i", scaled, scaled), first)
        return self.bias + np.add.reduceat(self.weight[index] * value, first) + 0.5 * ((sums * sums).sum(1) - squares)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gathered(by: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``what`` for each distinct value of ``by``."""
    order = np.argsort(by, kind="stable")
    sorted_by = by[order]
    begin = np.flatnonzero(np.concatenate(([True], sorted_by[1:] != sorted_by[:-1])))
    return sorted_by[begin], np.add.reduceat(what[order], begin)


META_BUCKETS = 1 << 10


def fit(rows: pa.Table, n_meta: int) -> Machine:
    """Fit on collected features: label, bucket, value, statistics, metadata."""
    label = rows["label"].to_numpy().astype(float)
    n = len(label)
    statistics = np.stack(rows["statistics"].to_pylist()) if n else np.zeros((0, len(STATISTICS)))
    edges = np.quantile(statistics, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T if n else np.zeros((len(STATISTICS), BINS - 1))
    random = np.random.default_rng(17)
    size = BUCKETS + len(STATISTICS) * BINS + n_meta * META_BUCKETS
    share = label.mean() if n else 0.5
    bias = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    machine = Machine(edges, bias, np.zeros(size, np.float32), random.normal(0, 0.03, (size, FACTORS)).astype(np.float32))
    if n == 0 or share in (0.0, 1.0):
        machine.factor[:] = 0
        return machine
    column = lambda c: rows[c].combine_chunks()
    bucket, value = column("bucket"), column("value")
    meta = np.array(rows["metadata"].to_pylist(), np.int64).reshape(n, n_meta)
    index, value, bounds = machine.assembled(
        bucket.values.to_numpy(), value.values.to_numpy(), bucket.offsets.to_numpy().astype(np.int64), statistics, meta)
    seen_w, seen_f = np.full(size, 1e-3), np.full((size, FACTORS), 1e-3)
    for _ in range(EPOCHS):
        order = random.permutation(n)
        for part in np.array_split(order, max(1, n // BATCH)):
            length = bounds[part + 1] - bounds[part]
            at = flat.ranges(bounds[part], length)
            i, v, cuts = index[at], value[at], np.concatenate(([0], np.cumsum(length)))
            error = _sigmoid(machine.margins(i, v, cuts)) - label[part]
            machine.bias -= 0.05 * float(error.mean())
            pull = np.repeat(error, length) * v / len(part)
            scaled = machine.factor[i] * v[:, None]
            total = np.repeat(np.add.reduceat(scaled, cuts[:-1]), length, axis=0)
            ids, got = _gathered(i, np.column_stack([pull, pull[:, None] * (total - scaled)]))
            got[:, 0] += DECAY * machine.weight[ids]
            got[:, 1:] += DECAY * machine.factor[ids]
            seen_w[ids] += got[:, 0] ** 2
            seen_f[ids] += got[:, 1:] ** 2
            machine.weight[ids] -= RATE * got[:, 0] / np.sqrt(seen_w[ids])
            machine.factor[ids] -= 0.5 * RATE * got[:, 1:] / np.sqrt(seen_f[ids])
    return machine


def _metadata(columns: list[str]):
    """A small hash of every metadata value; numbers are grouped by powers of two."""
    group = "if(try_cast({0} as double) > 0, cast(floor(log2(try_cast({0} as double))) as string), cast({0} as string))"
    return F.array(*[
        F.pmod(F.xxhash64(F.lit(c), F.expr(group.format(f"`{c}`"))), F.lit(META_BUCKETS)) + F.lit(i * META_BUCKETS)
        for i, c in enumerate(columns)
    ]).cast("array<bigint>")


def _meta_rows(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat.utf8(batch.column(0))
        for a, b in flat.chunks(offsets, flat.SMALL_CHUNK_BYTES):
            bucket, value, bounds, statistics = features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays([
                batch.column(2).slice(a, b - a), flat.lists(bucket, bounds, pa.int32()), flat.lists(value, bounds, pa.float32()),
                flat.lists(statistics.ravel(), len(STATISTICS) * np.arange(b - a + 1), pa.float64()), batch.column(1).slice(a, b - a),
            ], names=["label", "bucket", "value", "statistics", "metadata"])


def train(documents: DataFrame, sample: DataFrame, text_col: str = "text", metadata: list[str] = [],
          id_col: str = "doc_id") -> Machine:
    """Fit on a bounded sample of (doc_id, label)."""
    rows = samples.texts(documents, sample, list(dict.fromkeys([text_col, *metadata])), id_col)
    table = rows.select(text_col, _metadata(metadata).alias("metadata"), "label").mapInArrow(
        _featured, "label int, bucket array<int>, value array<float>, statistics array<double>, metadata array<bigint>").toArrow()
    return fit(table, len(metadata))


def scored(documents: DataFrame, machine: Machine, text_col: str = "text", metadata: list[str] = [],
           name: str = "quality_score") -> DataFrame:
    """``documents`` with the probability of label 1."""
    documents = without(documents, name)
    place = documents.columns.index(text_col)
    carried = len(documents.columns)
    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat.utf8(batch.column(place))
            meta = _meta_rows(batch.column(carried), batch.num_rows)
            score = [np.zeros(0)]
            for a, b in flat.chunks(offsets, flat.SMALL_CHUNK_BYTES):
                got = features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                score.append(_sigmoid(machine.margins(*machine.assembled(*got, meta[a:b]))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:carried], pa.array(np.concatenate(score).astype(float))], names=schema.names)

    return documents.withColumn(free_name(documents, "metadata"), _metadata(metadata)).mapInArrow(run, schema)
