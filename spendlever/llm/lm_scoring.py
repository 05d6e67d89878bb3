"""Scores of texts under an n-gram model of the corpus, kept as Elias-Fano tries.

The model. A token's probability interpolates absolute discounting from the longest context down:
P(w | c) = max(n(cw) - D, 0) / n(c) + D n1(c) / n(c) P(w | shorter c), n1 being the number of distinct
successors; below the contexts stands the add-``ALPHA`` distribution of single words, in which all
unknown words share one place. Discounted counts are quantised to one byte, rounded down, so the
probabilities of a context never sum to more than 1. Every text ends with an end token and begins
after a start mark.

Neither the model nor the vocabulary is ever in one place. Texts are cut into blocks of a few
megabytes. First each block sends each shard of the vocabulary its distinct words with their counts in training texts, and learns
the counts in the corpus and a name for each word, a small number from which the count follows: frequent words have the
least names. Then each token travels once for all orders: the names of its context and of itself go to the shard of the
last context word, in which all its contexts lie. A shard builds the tries of its contexts (Elias-Fano), one for each order,
reads the answers to all its tokens from them in the order of the trie, and returns a partial sum for each text. The shards are
dealt over ``PASSES`` passes, and a pass's lists are freed before the next begins, so only a part of them is on disk at a time.

A context that owns more than a 256th of all tokens, or more than two shards have, is dealt by its successors over the shards
of the vocabulary, which answer it before the passes; its tokens go on to the shard of the next longer context that is not so
frequent. The number of shards grows with the tokens, so a shard stays small. Only these hot contexts and the number of words of
each count, at most a few thousand, reach the driver.

Defined results. Null text counts as empty: it has the end token alone. Rows that share an id are
texts of their own; a null ``train`` condition counts as false. Extra columns are ignored. Without training
texts every token has base probability 1. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spendlever.llm import flat
from spendlever.llm.elias_fano import FINGERPRINT_BITS, Trie, least_kind
from spendlever.llm.stages import Stages

#: Words of the longest n-grams that the query counts.
ORDER = 5
DISCOUNT = 0.75
ALPHA = 0.1
BLOCK_BYTES = 6 << 20
SHARD_TOKENS = 250_000
HOT_SHARE = 256
#: A block tells of contexts that own so much less of it than hot ones; no context with that share is left to one shard.
COLD_SHARE = 16
#: Shards are dealt over so many passes; the lists of one pass are on disk at a time.
PASSES = 4
#: A block sends one list to so many shards, if enough lists are left to deal out.
TOGETHER = 4
LEAST_PARTS = 12
#: Keys that no word has: the end of a text and the mark before its first word.
END, START = np.uint64(1), np.uint64(2)

_CHAIN = np.uint64(0x9E3779B97F4A7C15)
_PRINT = np.uint64(FINGERPRINT_BITS)
BLOCKS = ("block bigint, ids array<bigint>, trained array<boolean>, ends array<bigint>, tokens binary, words binary, "
          "n_tokens bigint, n_trained bigint, frequent array<struct<level: int, key: bigint, n: bigint>>")
WORDS = "shard bigint, block bigint, keys binary, counts binary, n_pairs bigint, owners binary, places binary, seen binary"
COUNTED = ("block bigint, shard bigint, n_keys bigint, counts binary, serials binary, codes binary, n_words bigint, "
           "classes array<struct<n: bigint, size: bigint>>, hot array<struct<hot: bigint, total: bigint, kinds: bigint>>, "
           "level int, trie binary")
NAMED = ("block bigint, ids array<bigint>, trained array<boolean>, ends array<bigint>, tokens binary, n_tokens bigint, names binary, "
         "words binary, depths binary, n_low bigint, low binary, known array<bigint>, base array<double>, own array<double>")
LISTS = "part bigint, block bigint, n bigint, n_low bigint, sizes binary, data binary, words binary"
SUMS = "block bigint, part bigint, n bigint, texts binary, sums binary, shard bigint, level int, trie binary"
FOLDED = "block bigint, turn int, sums binary"
SCORES = "doc_id bigint, trained boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def code_book(most: int) -> np.ndarray:
    """Discounted counts of codes 1 to 255 (0: unseen): exact up to 64, then geometric up to ``most``."""
    top = max(float(most), 65.0)
    grown = 64 * (top / 64) ** (np.arange(1, 192) / 191)
    return np.concatenate(([0.0], np.arange(1, 65) - DISCOUNT, grown - DISCOUNT))


def codes_of(counts: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (np.searchsorted(book, counts - DISCOUNT + 1e-9, "right") - 1).astype(np.uint8)


def _numbers(data: bytes, n: int) -> np.ndarray:
    """Whole numbers of a binary list; their size follows from their number."""
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _ascending(values: np.ndarray) -> np.ndarray:
    """Order of the values: their high bits and places are sorted together, which is faster than an argsort."""
    n = len(values)
    if not n:
        return np.zeros(0, np.int64)
    bits = n.bit_length()
    spare = np.uint64(max(0, int(values.max()).bit_length() + bits - 64))
    packed = values >> spare << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    packed.sort()
    order = (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
    ranked = values[order]
    return order if (ranked[1:] >= ranked[:-1]).all() else order[np.argsort(ranked, kind="stable")]


def _zipped(data: bytes) -> bytes:
    return pa.compress(data, "zstd", asbytes=True)


def _unzipped(data: bytes, kind, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, np.dtype(kind).itemsize * n, "zstd"), kind)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _before(tokens: np.ndarray, within: np.ndarray, at: np.ndarray, back: int, start: int) -> np.ndarray:
    """The word ``back`` places before each of the tokens ``at``; ``start`` before a text's first word."""
    return np.where(within[at] < back, start, tokens[at - back])


def contexts(tokens: np.ndarray, within: np.ndarray, keys: np.ndarray, order: int,
             pick: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple]:
    """(level, tokens, context of each, keys, counts) of the contexts of one word, two words and so on that ``pick`` keeps.

    Of longer contexts only those are looked at that end with one that was kept. ``keys`` are those of the words and, last,
    of the start mark; a context's key grows from its last word to its first.
    """
    at, owner, chain = np.arange(len(tokens)), np.zeros(len(tokens), np.int64), np.zeros(1, np.uint64)
    for level in range(order - 1):
        word = _before(tokens, within, at, level + 1, len(keys) - 1)
        code, pairs = pd.factorize(owner * len(keys) + word)
        chain = _longer(level, chain[pairs // len(keys)], keys[pairs % len(keys)])
        n = np.bincount(code, minlength=len(pairs))
        kept = pick(level, chain, n)
        stays = kept[code]
        at, owner, chain = at[stays], (np.cumsum(kept) - 1)[code[stays]], chain[kept]
        yield level, at, owner, chain, n[kept]


def _longer(level: int, chain: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keys of contexts that have one more word before; a single word's is its own."""
    return flat.mix(chain * _CHAIN + key) if level else key


def blocks(documents: DataFrame, train: str, order: int, id_col: str, text_col: str) -> DataFrame:
    """Texts as blocks of numbered tokens, with the contexts that own much of each block."""
    share = 2 * HOT_SHARE * COLD_SHARE

    def packed(seq: int, ids: list, trained: list, sizes: np.ndarray, keys: np.ndarray) -> dict:
        code, words = pd.factorize(keys)
        by_count = np.argsort(-np.bincount(code, minlength=len(words)), kind="stable")
        number = np.empty(len(words), np.int64)
        number[by_count] = np.arange(len(words))
        tokens, words, ends = number[code], words[by_count].astype(np.uint64), np.cumsum(sizes)
        frequent = []
        for level, _, _, names, n in contexts(
                tokens, _within(ends), np.append(words, START), order, lambda level, names, n: n > len(tokens) // share):
            frequent += [{"level": level, "key": k, "n": m} for k, m in zip(names.view(np.int64).tolist(), n.tolist())]
        flags = np.array(trained, bool)
        return {
            "block": (TaskContext.get().partitionId() << 32) + seq, "ids": ids, "trained": trained, "ends": ends.tolist(),
            "tokens": _zipped(_planes(tokens.astype(np.uint32), 4)), "words": words.tobytes(),
            "n_tokens": len(tokens), "n_trained": int(sizes[flags].sum()), "frequent": frequent}

    schema = _arrow(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, trained, size, seq = [], [], [], 0, 0

        def done() -> pa.RecordBatch:
            sizes, keys = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_pylist([packed(seq, ids, trained, sizes, keys)], schema)

        for batch in batches:
            data, offsets = flat.utf8(batch.column(1))
            for a, b in flat.chunks(offsets, flat.SMALL_CHUNK_BYTES):
                part = flat.lowered(data[offsets[a]:offsets[b]])
                starts, ends, rows = flat.words(part, offsets[a:b + 1] - offsets[a])
                n = np.diff(rows)
                keys = np.full(len(starts) + len(n), END)
                keys[np.arange(len(starts)) + np.repeat(np.arange(len(n)), n)] = flat.hashes(part, starts, ends)
                held.append((n + 1, keys))
                ids += batch.column(0).slice(a, b - a).to_pylist()
                trained += batch.column(2).slice(a, b - a).to_pylist()
                size += int(offsets[b] - offsets[a])
                if size >= BLOCK_BYTES:
                    yield done()
                    held, ids, trained, size, seq = [], [], [], 0, seq + 1
        if held:
            yield done()

    chosen = documents.select(F.col(id_col).cast("bigint"), text_col, F.coalesce(F.expr(train), F.lit(False)))
    return chosen.mapInArrow(run, BLOCKS)


def _planes(values: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes of whole numbers: all lowest bytes, then all second bytes and so on, which packs better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize)[:, :width].T).tobytes()


def _unplaned(data: np.ndarray, n: int, width: int) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = data.reshape(width, n).T
    return wide.view(np.int64).reshape(-1)


def _within(ends: np.ndarray) -> np.ndarray:
    """Place of each token in its text."""
    begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
    return np.arange(ends[-1]) - np.repeat(begins, ends - begins)


def _block(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, ends of texts and whether each text is a training text."""
    n = row["n_tokens"]
    return _unplaned(_unzipped(row["tokens"], np.uint8, 4 * n), n, 4), np.array(row["ends"], np.int64), np.array(row["trained"], bool)


class Hot:
    """Contexts that are dealt by their successors, numbered level by level."""

    def __init__(self, keys: list[np.ndarray]):
        self.keys = [np.sort(k) for k in keys]
        self.first = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int64)

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, int, int]]:
        return zip(range(len(self.keys)), self.keys, self.first[:-1].tolist(), self.first[1:].tolist())


class Shares:
    """Words of a block and their pairs with hot contexts, dealt over the shards of the vocabulary.

    ``found`` has for each level the tokens after hot contexts, their contexts and their pairs.
    """

    def __init__(self, tokens: np.ndarray, ends: np.ndarray, words: np.ndarray, order: int, hot: Hot, shards: int):
        self.found, owner, word, n = [], [], [], 0
        for level, at, context, keys, _ in contexts(
                tokens, _within(ends), np.append(words, START), order, lambda level, keys, n: np.isin(keys, hot.keys[level])):
            number = (hot.first[level] + np.searchsorted(hot.keys[level], keys))[context]
            pair, pairs = pd.factorize(number * len(words) + tokens[at])
            self.found.append((at, number, n + pair))
            owner.append(pairs // len(words))
            word.append(pairs % len(words))
            n += len(pairs)
        self.owner, self.word = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (owner, word))
        self.shard = (flat.mix(words) % np.uint64(shards)).astype(np.int64)
        self.order = np.argsort(self.shard, kind="stable")
        self.pairs = np.argsort(self.shard[self.word], kind="stable")

    def lists(self, block: int, words: np.ndarray, counts: np.ndarray, seen: np.ndarray) -> Iterator[tuple]:
        """One row per shard; ``counts`` of words and ``seen`` of pairs, in training texts."""
        shard = self.shard[self.order]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]))
        rank = np.empty(len(words), np.int64)
        rank[self.order] = np.arange(len(words))
        own = self.shard[self.word[self.pairs]]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            x, y = np.searchsorted(own, shard[a]), np.searchsorted(own, shard[a], "right")
            pairs, mine = self.pairs[x:y], self.order[a:b]
            yield (int(shard[a]), block, words[mine].tobytes(), least_kind(counts[mine]).tobytes(), len(pairs),
                   least_kind(self.owner[pairs]).tobytes(), least_kind(rank[self.word[pairs]] - a).tobytes(), least_kind(seen[pairs]).tobytes())

    def read(self, answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts and serials of the words and codes of the pairs, from the shards' answers."""
        answers = sorted(answers, key=lambda r: r["shard"])
        out = np.empty((2, len(self.order)), np.int64)
        for to, name in zip(out, ("counts", "serials")):
            to[self.order] = np.concatenate([_numbers(r[name], r["n_keys"]) for r in answers])
        codes = np.zeros(len(self.pairs), np.uint8)
        codes[self.pairs] = np.concatenate([np.frombuffer(r["codes"], np.uint8) for r in answers])
        return *out, codes


def _words(table: DataFrame, order: int, hot: Hot, shards: int) -> DataFrame:
    """What each block tells the shards of the vocabulary."""
    schema = _arrow(WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                tokens, ends, trained = _block(row)
                words = np.frombuffer(row["words"], np.uint64)
                own = np.repeat(trained, np.diff(ends, prepend=0))
                shares = Shares(tokens, ends, words, order, hot, shards)
                seen = np.zeros(len(shares.pairs), np.int64)
                for at, _, pair in shares.found:
                    seen += np.bincount(pair[own[at]], minlength=len(seen))
                counts = np.bincount(tokens[own], minlength=len(words))
                yield from _table([*shares.lists(row["block"], words, counts, seen)], schema).to_batches()

    return table.select("block", "tokens", "n_tokens", "ends", "words", "trained").mapInArrow(run, WORDS)


def build(keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray, seen: np.ndarray, book: np.ndarray) -> Trie:
    """Trie of ascending context keys with their counts as words, and of (context, fingerprint) pairs, which never fall, with theirs."""
    pairs, seen = pairs[seen > 0], seen[seen > 0]
    if len(pairs):
        first = np.concatenate(([0], np.flatnonzero(pairs[1:] != pairs[:-1]) + 1))
        pairs, seen = pairs[first], np.add.reduceat(seen, first)
    above = (pairs >> _PRINT).astype(np.int64)
    total = np.bincount(above, weights=seen, minlength=len(keys)).astype(np.int64)
    kept = (counts > 0) | (total > 0)
    pointers = np.concatenate(([0], np.cumsum(np.bincount(above, minlength=len(keys))[kept])))
    return Trie.of(keys[kept], counts[kept], total[kept], pointers, pairs & np.uint64((1 << FINGERPRINT_BITS) - 1), codes_of(seen, book))


def _read(trie: Trie, keys: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(counts, totals, distinct successors) of ascending keys, and codes of ascending pairs (place among the keys, fingerprint)."""
    place = trie.find_ascending(keys)
    found = place >= 0
    values = np.zeros((3, len(keys)), np.int64)
    for to, value in zip(values, (trie.counts, trie.totals, trie.kinds())):
        to[found] = value[place[found]]
    codes = trie.find_successors_ascending(place[(pairs >> _PRINT).astype(np.int64)], pairs & np.uint64((1 << FINGERPRINT_BITS) - 1))
    return *values, codes


def _counted(lists: DataFrame, order: int, hot: Hot, shards: int, book: np.ndarray, keep: bool) -> DataFrame:
    """Counts and serials of all words, and what follows hot contexts, for each block and in all."""
    schema = _arrow(COUNTED)

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        shard = rows[0]["shard"]
        keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        n, m = np.array([len(k) for k in keys]), [r["n_pairs"] for r in rows]
        words, place = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(place, weights=np.concatenate([_numbers(r["counts"], len(k)) for r, k in zip(rows, keys)])).astype(np.int64)
        begins = np.concatenate(([0], np.cumsum(n)))
        word = place[np.concatenate([_numbers(r["places"], k) + b for r, k, b in zip(rows, m, begins)])]
        owner, seen = (np.concatenate([_numbers(r[x], k) for r, k in zip(rows, m)]) for x in ("owners", "seen"))
        pair, at = np.unique(owner * len(words) + word, return_inverse=True)
        seen = np.bincount(at, weights=seen, minlength=len(pair)).astype(np.int64)
        owner, word = pair // len(words), pair % len(words)
        codes, frequent, out = np.zeros(len(pair), np.uint8), [], []
        for level, names, a, b in hot:
            own = slice(*np.searchsorted(owner, [a, b]))
            known = np.union1d(words, names) if level == 0 else names
            counts = np.zeros(len(known), np.int64)
            if level == 0:
                counts[np.searchsorted(known, words)] = count
            begin = np.searchsorted(known, names)
            pairs = begin[owner[own] - a].astype(np.uint64) << _PRINT | words[word[own]] >> np.uint64(64 - FINGERPRINT_BITS)
            data = build(known, counts, pairs, seen[own], book).tobytes()
            counts, totals, kinds, codes[own] = _read(Trie.on(data), known, pairs)
            if level == 0:
                count = counts[np.searchsorted(known, words)]
            frequent += [{"hot": a + i, "total": int(totals[x]), "kinds": int(kinds[x])} for i, x in enumerate(begin)]
            if keep:
                out.append((None, shard, *[None] * 7, level, data))
        by_count = np.argsort(-count, kind="stable")
        classes, first, size = np.unique(-count[by_count], return_index=True, return_counts=True)
        serial = np.empty(len(words), np.int64)
        serial[by_count] = (np.arange(len(words)) - np.repeat(first, size)) * shards + shard
        found = np.concatenate(([0], np.cumsum(m)))
        for i, r in enumerate(rows):
            mine = place[begins[i]:begins[i + 1]]
            out.append((r["block"], shard, len(mine), least_kind(count[mine]).tobytes(), least_kind(serial[mine]).tobytes(),
                        codes[at[found[i]:found[i + 1]]].tobytes(), *[None] * 5))
        sizes = [{"n": -c, "size": s} for c, s in zip(classes.tolist(), size.tolist())]
        out.append((None, shard, *[None] * 4, int((count > 0).sum()), sizes, frequent, None, None))
        return _table(out, schema)

    return lists.groupBy("shard").applyInArrow(run, COUNTED)


class Corpus:
    """What all tasks know of the corpus: sizes, the code book, and counts of words and of hot contexts.

    Names are dealt by falling counts, so the count of a word follows from its name; 0 is the start mark.
    """

    def __init__(self, n_trained: int, n_words: int, book: np.ndarray, classes: list[tuple[int, int]], hot: dict[int, tuple[int, int]]):
        self.n_trained, self.n_words, self.book = n_trained, n_words, book
        classes = sorted(classes, reverse=True)
        self.counts = np.array([c for c, _ in classes], np.int64)
        ends = 1 + np.cumsum([size for _, size in classes], dtype=np.int64)
        self.first = np.concatenate(([1], ends))[:-1]
        self.width = max(1, math.ceil(int(ends[-1] if len(ends) else 1).bit_length() / 8))
        self.totals, self.kinds = (np.array([hot[i][k] for i in range(len(hot))], np.int64) for k in (0, 1))

    def names(self, counts: np.ndarray, serials: np.ndarray) -> np.ndarray:
        return self.first[np.searchsorted(-self.counts, -counts)] + serials

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ALPHA) / (self.n_trained + ALPHA * (self.n_words + 1))

    def count(self, names: np.ndarray) -> np.ndarray:
        return self.counts[np.searchsorted(self.first, names, "right") - 1]


def _steps(book: np.ndarray, codes: np.ndarray, totals: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a and b of P = a + b P(shorter context); a context that no training text has changes nothing."""
    n = np.maximum(totals, 1)
    return np.where(totals > 0, book[codes] / n, 0.0), np.where(totals > 0, DISCOUNT * kinds / n, 1.0)


def _named(table: DataFrame, answers: DataFrame, order: int, hot: Hot, shards: int, corpus: Corpus, keep: bool) -> DataFrame:
    """Blocks with the names of their words, the number of hot contexts of each token and the probability after the longest of them."""
    schema = _arrow(NAMED)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        tokens, ends, _ = _block(row)
        words = np.frombuffer(row["words"], np.uint64)
        shares = Shares(tokens, ends, words, order, hot, shards)
        counts, serials, codes = shares.read(right.to_pylist())
        base = corpus.base(counts)[tokens]
        p, depth = base.copy(), np.zeros(len(tokens), np.uint8)
        for level, (at, number, pair) in enumerate(shares.found):
            a, b = _steps(corpus.book, codes[pair], corpus.totals[number], corpus.kinds[number])
            p[at] = a + b * p[at]
            depth[at] = level + 1
        begins = np.concatenate(([0], ends[:-1]))
        sums = [np.add.reduceat(x, begins).tolist() for x in (
            (counts > 0)[tokens].astype(np.int64), np.log10(base), np.where(depth == order - 1, np.log10(p), 0.0))]
        low = p[(depth > 0) & (depth < order - 1)]
        return _table([(
            row["block"], row["ids"], row["trained"], row["ends"], row["tokens"], len(tokens), least_kind(corpus.names(counts, serials)).tobytes(),
            row["words"] if keep else None, _zipped(depth.tobytes()), len(low), _zipped(low.tobytes()), *sums)], schema)

    left = table.select("block", "tokens", "n_tokens", "ends", "words", "trained", "ids")
    right = answers.filter("block is not null").select("block", "shard", "n_keys", "counts", "serials", "codes")
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(run, NAMED)


def _lists(named: DataFrame, order: int, shards: int, together: int, turn: int, width: int) -> DataFrame:
    """Tokens with the names of their contexts, and their texts, for the shards of this turn, so many of them in a list."""
    schema = _arrow(LISTS)

    def rows(row: dict) -> Iterator[tuple]:
        tokens, ends, trained = _block(row)
        words = np.frombuffer(row["words"], np.uint64) if row["words"] is not None else None
        depth = _unzipped(row["depths"], np.uint8, len(tokens))
        n_words = int(tokens.max()) + 1
        names = np.append(_numbers(row["names"], n_words), 0)
        within = _within(ends)
        part = (flat.mix(names.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
        shard = np.empty(len(tokens), np.int64)
        shard[1:] = part[tokens[:-1]]
        shard[within == 0] = part[-1]
        hot = np.flatnonzero((depth > 0) & (depth < order - 1))
        for level in range(1, order - 1):  # the first context that is not hot says where a token goes
            at = hot[depth[hot] == level]
            key = np.zeros(len(at), np.uint64)
            for back in range(1, level + 2):
                key = flat.mix(key * _CHAIN + names[_before(tokens, within, at, back, n_words)].astype(np.uint64))
            shard[at] = (key % np.uint64(shards)).astype(np.int64)
        at = np.flatnonzero((shard % PASSES == turn) & (depth < order - 1))
        place = shard[at] // PASSES
        by = np.argsort(place.astype(np.uint16) if shards // PASSES < 1 << 16 else place, kind="stable")
        at, place = at[by], place[by]
        low = np.zeros(len(tokens))
        low[hot] = _unzipped(row["low"], np.float64, row["n_low"])
        text = np.repeat(np.arange(len(ends), dtype=np.uint32), np.diff(ends, prepend=0))[at]
        flags = depth[at] << 1 | trained[text]
        used = [names[tokens[at]], *[names[_before(tokens, within, at, back, n_words)] for back in range(1, order)]]
        step, starts = np.diff(text, prepend=np.uint32(0)), np.flatnonzero(np.diff(place, prepend=-1))
        step[starts] = text[starts]
        cuts = np.append(np.flatnonzero(np.diff(place // together, prepend=-1)), len(place))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            lows = low[at[a:b]][flags[a:b] > 1]
            data = [_planes(x[a:b], width) for x in used] + [_planes(step[a:b], 4), flags[a:b].tobytes(), lows.tobytes()]
            own = None
            if words is not None:
                mine = np.unique(np.concatenate([tokens[at[a:b]], *[_before(tokens, within, at[a:b], k, n_words) for k in range(1, order)]]))
                own = np.stack([names[mine].astype(np.uint64), np.append(words, START)[mine]]).tobytes()
            number = int(place[a]) // together
            sizes = least_kind(np.bincount(place[a:b] - number * together, minlength=together))
            yield number, row["block"], b - a, len(lows), sizes.tobytes(), _zipped(b"".join(data)), own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _table([*rows(batch.slice(i, 1).to_pylist()[0])], schema).to_batches()

    return named.select("block", "tokens", "n_tokens", "ends", "trained", "names", "words", "depths", "n_low", "low").mapInArrow(run, LISTS)


def _logs(word: np.ndarray, before: list[np.ndarray], trained: np.ndarray, depth: np.ndarray, low: np.ndarray, corpus: Corpus,
          key_of: Callable[[np.ndarray], np.ndarray], tries: list[bytes] | None) -> np.ndarray:
    """Log10 probabilities of all tokens of a shard from its tries, one for each order; ``tries`` gets them.

    ``before`` has the names of the words before, the nearest first, and is used up; the first ``depth`` contexts of a token are hot,
    and ``low`` is the probability after the longest of those.
    """
    bits = np.int64(8 * corpus.width)
    mask = (np.int64(1) << bits) - 1
    p = corpus.base(corpus.count(word))
    p[depth > 0] = low
    owner, chain = np.zeros(len(word), np.int64), np.zeros(1, np.uint64)
    for level in range(len(before)):
        owner, pairs = pd.factorize(owner << bits | before.pop(0))
        chain = _longer(level, chain[pairs >> bits], key_of(pairs & mask))
        pair, pairs = pd.factorize(owner << bits | word)
        context, own = pairs >> bits, depth <= level
        live = np.zeros(len(chain), bool)
        live[owner[own]] = True
        seen = np.bincount(pair[trained & own], minlength=len(pairs))
        keys = np.flatnonzero(live)
        keys = keys[_ascending(chain[keys])]
        place = np.full(len(chain), -1, np.int64)
        place[keys] = np.arange(len(keys))
        mine = np.flatnonzero(live[context])
        value = place[context[mine]].astype(np.uint64) << _PRINT | key_of(pairs[mine] & mask) >> np.uint64(64 - FINGERPRINT_BITS)
        by = _ascending(value)
        mine, value = mine[by], value[by]
        data = build(chain[keys], np.zeros(len(keys), np.int64), value, seen[mine], corpus.book).tobytes()
        _, totals, kinds, codes = _read(Trie.on(data), chain[keys], value)
        if tries is not None:
            tries.append(data)
        a, b = np.zeros(len(pairs)), np.ones(len(pairs))
        at = place[context[mine]]
        a[mine], b[mine] = _steps(corpus.book, codes, totals[at], kinds[at])
        p = a[pair] + b[pair] * p
        del pair, pairs, context, place, mine, value, by, data, codes, a, b, at
    return np.log10(p)


def _sums(lists: DataFrame, order: int, together: int, corpus: Corpus, keep: bool) -> DataFrame:
    """Log10 probabilities of every list's tokens, summed by text; the tries of the shards are returned as well if ``keep``."""
    schema = _arrow(SUMS)
    width = corpus.width

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        got = table.drop_columns("data").to_pylist()
        part, out, sums, key_of = got[0]["part"], [], [[] for _ in got], lambda names: flat.mix(names.astype(np.uint64))
        if keep:
            known = np.concatenate([np.frombuffer(r["words"], np.uint64).reshape(2, -1) for r in got], axis=1)
            ids, at = np.unique(known[0].astype(np.int64), return_index=True)
            hashes = known[1][at]
            key_of = lambda names: hashes[np.searchsorted(ids, names)]
        for r, data in zip(got, table.column("data")):
            size = (order * width + 5) * r["n"]
            data = _unzipped(data.as_buffer(), np.uint8, size + 8 * r["n_low"])
            r["planes"], r["low"] = data[:size].reshape(-1, r["n"]), np.frombuffer(data[size:].tobytes(), np.float64)
            r["cuts"] = np.concatenate(([0], np.cumsum(_numbers(r["sizes"], together))))
            r["lows"] = np.concatenate(([0], np.cumsum(r["planes"][-1] > 1)))[r["cuts"]]
        for i in range(together):
            planes = [r["planes"][:, r["cuts"][i]:r["cuts"][i + 1]] for r in got]
            word, *before = (np.concatenate([_unplaned(x[k * width:(k + 1) * width], x.shape[1], width) for x in planes]) for k in range(order))
            if not len(word):
                continue
            texts = [np.cumsum(_unplaned(x[order * width:order * width + 4], x.shape[1], 4)) for x in planes]
            flags = np.concatenate([x[-1] for x in planes])
            low = np.concatenate([r["low"][r["lows"][i]:r["lows"][i + 1]] for r in got])
            tries = [] if keep else None
            logs = _logs(word, before, (flags & 1).astype(bool), flags >> 1, low, corpus, key_of, tries)
            begin = 0
            for mine, text in zip(sums, texts):
                if len(text):
                    first = np.flatnonzero(np.diff(text, prepend=-1))
                    mine.append((text[first], np.add.reduceat(logs[begin:begin + len(text)], first)))
                    begin += len(text)
            out += [(*[None] * 5, part * together + i, level, data) for level, data in enumerate(tries or [])]
        for r, mine in zip(got, sums):
            text, value = (np.concatenate(x) for x in zip(*mine))
            texts, at = np.unique(text, return_inverse=True)
            out.append((r["block"], part, len(texts), least_kind(np.diff(texts, prepend=0)).tobytes(), np.bincount(at, value).tobytes(), *[None] * 3))
        return _table(out, schema)

    return lists.groupBy("part").applyInArrow(run, SUMS)


def _folded(sums: DataFrame, turn: int) -> DataFrame:
    """The sums of a turn, one for each text of a block."""
    schema = _arrow(FOLDED)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        text = np.concatenate([np.cumsum(_numbers(r["texts"], r["n"])) for r in rows])
        return _table([(rows[0]["block"], turn, np.bincount(text, np.concatenate([np.frombuffer(r["sums"]) for r in rows])).tobytes())], schema)

    return sums.filter("block is not null").select("block", "part", "n", "texts", "sums").groupBy("block").applyInArrow(run, FOLDED)


def _scores(named: DataFrame, sums: DataFrame) -> DataFrame:
    schema = _arrow(SCORES)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        score = np.array(row["own"])
        for r in sorted(right.to_pylist(), key=lambda r: r["turn"]):
            value = np.frombuffer(r["sums"])
            score[:len(value)] += value
        sizes = np.diff(np.array(row["ends"], np.int64), prepend=0)
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(
            (row["ids"], row["trained"], sizes, row["known"], row["base"], score), schema)], schema=schema)

    left = named.select("block", "ids", "trained", "ends", "known", "base", "own")
    return left.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(run, SCORES)


def scored(
    documents: DataFrame, train: str = "true", order: int = 2, id_col: str = "doc_id", text_col: str = "text",
    model_path: str | None = None,
) -> tuple[DataFrame, int]:
    """Scores of all texts under the model of those that meet ``train``, and the number of training tokens.

    Returns doc_id, trained, n_tokens, n_known, base_score (single words only) and score, both the
    log10 probability of the text with its end. ``model_path`` keeps the tries as Parquet
    (shard, level, trie): those of the vocabulary, with the counts of words, and after them those of the contexts that are not hot.
    """
    spark, keep = documents.sparkSession, model_path is not None
    stages = Stages(spark, "ngrams")
    table = stages.settle(blocks(documents, train, order, id_col, text_col), "blocks")
    n_tokens, n_trained = table.agg(
        F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_trained"), F.lit(0))).first()
    shards = max(1, math.ceil(n_tokens / SHARD_TOKENS))
    much = max(n_tokens // (HOT_SHARE * COLD_SHARE), min(n_tokens // HOT_SHARE, 2 * SHARD_TOKENS))
    owned = table.select(F.explode("frequent").alias("f")).groupBy("f.level", "f.key").agg(F.sum("f.n").alias("n"))
    found: list[list[int]] = [[] for _ in range(max(1, order - 1))]
    for r in owned.filter(F.col("n") > much).collect():  # fewer than HOT_SHARE * COLD_SHARE a level
        found[r["level"]].append(r["key"] % (1 << 64))
    hot, book, few = Hot([np.array(x, np.uint64) for x in found]), code_book(n_trained), math.ceil(shards / 8)
    answers = stages.settle(_counted(_words(table, order, hot, few), order, hot, few, book, keep), "words", free=True)
    n_words = answers.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    classes = answers.select(F.explode("classes").alias("c")).groupBy("c.n").agg(F.max("c.size").alias("size")).collect()
    totals = answers.select(F.explode("hot").alias("h")).groupBy("h.hot").agg(F.sum("h.total").alias("total"), F.sum("h.kinds").alias("kinds"))
    corpus = Corpus(n_trained, n_words, book, [(r["n"], r["size"] * few) for r in classes], {r["hot"]: (r["total"], r["kinds"]) for r in totals.collect()})
    halves = [[t.filter(f"pmod(xxhash64(block), 2) = {i}") for t in (table, answers)] for i in range(2)]  # one after the other, for disk
    named = reduce(DataFrame.union, [stages.settle(_named(*half, order, hot, few, corpus, keep), "named", free=True) for half in halves])
    stages.drop(table)
    together = min(TOGETHER, max(1, shards // (PASSES * LEAST_PARTS)))
    tries, folded = [answers.select("shard", "level", "trie")], []
    for turn in range(PASSES):
        sums = _sums(_lists(named, order, shards, together, turn, corpus.width), order, together, corpus, keep)
        if keep:
            sums = stages.settle(sums, "sums", free=True)
            tries.append(sums.select(F.col("shard") * PASSES + turn + few, "level", "trie"))
        folded.append(stages.settle(_folded(sums, turn), "folded", free=True))
    if keep:
        reduce(DataFrame.union, tries).filter("trie is not null").write.parquet(model_path)
    stages.drop(answers)
    return _scores(named, reduce(DataFrame.union, folded)), n_trained
