"""Toxicity by fuzzy lexicon matches and their context.

Lexicon. Words and word beginnings (stems) that are far more frequent in toxic than in other
documents of a bounded labelled sample, counted on the executors; at most ``TERMS`` of them.

Matching. The terms lie in a trie. A Levenshtein automaton runs over the trie: its state is the
set of trie nodes reached with so many edits, built when first needed and kept in a table. All distinct
words of a few megabytes of text step through the table together, one character at a time, and
leave when no term can match. Words of five to seven letters may differ by one edit, longer ones by
two, stems of six letters or more by one. A term whose misspellings also turn up in other
documents of the sample loses its edits.

Context. Each match gets a score from the words around it: more if the reader is addressed, less inside quotation
marks or near words that report speech or talk about a word. Sums of plain and of quoted evidence, and its density, go into
a logistic model fitted on the same sample.

Scoring is one narrow pass; the fitted lexicon and model have a bounded size.

Defined results. Null or empty text has no evidence and gets the lowest score. Rows are independent, so
repeated rows get equal scores. Without labelled rows of both classes the lexicon is empty, and every score is the share of
label 1 (zero without labels). Other columns are kept by ``scored``; an input column of the output's name is replaced.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from spendlever.llm import flat, samples
from spendlever.llm.stages import Stages, without

SAMPLE = 12_000
TERMS = 2_000
LEAST_DOCUMENTS = 5
LEAST_SHARE = 0.005
#: Least logarithm of how much likelier a term is in a toxic document, and the one that counts in full.
LEAST_ODDS, FULL_ODDS = 2.5, 5.0
STEMS = range(4, 9)
REACH = 6

# Cues of address, and of quoting or reporting, in four languages.
ADDRESS = "you your you're youre u du dich dein ihr euch tu toi te ton vous tú ti te vosotros".split()
REPORT = (
    "said says quote quoted quotes called calls word words term terms wrote writes sagte zitat zitiert wort dit cite mot "
    "citation dijo dice cita palabra").split()
_QUOTES = flat.byte_set(b'"')
# Digits and signs that stand for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_INSIDE = flat.byte_set(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)) + b"@$")
_APART = np.where(_INSIDE, np.arange(256), 32).astype(np.uint8)


def _lower(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals made small, bytes that are no letters made spaces."""
    low = flat.lowered(_APART[data])
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    low[second] += 32
    return low


def _words(data: np.ndarray, offsets: np.ndarray):
    """Number of the distinct word at every place, row of every place, start of every place, and the distinct words."""
    low = _lower(data)
    starts, ends, rows = flat.words(low, offsets)
    code, _ = pd.factorize(flat.hashes(low, starts, ends))
    first = np.zeros(code.max() + 1 if len(code) else 0, np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    body = low.tobytes()
    distinct = [body[a:b].decode(errors="replace") for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    return code, np.repeat(np.arange(len(offsets) - 1), np.diff(rows)), starts, distinct


def _documents_with(row: np.ndarray, code: np.ndarray, toxic: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Toxic and other rows that hold each code."""
    pair = np.unique(row * np.int64(n) + code)
    bad = toxic[pair // n]
    return np.bincount((pair % n)[bad], minlength=n), np.bincount((pair % n)[~bad], minlength=n)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat.utf8(batch.column(0))
        label = batch.column(1).to_numpy(zero_copy_only=False) == 1
        for a, b in flat.chunks(offsets, 8 << 20):
            code, row, _, distinct = _words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            if not distinct:
                continue
            toxic = label[a:b]
            sides = [(distinct, False, *_documents_with(row, code, toxic, len(distinct)))]
            for length in STEMS:
                names = np.array([w[:length] if len(w) > length else "" for w in distinct], object)
                stem, stems = pd.factorize(names)
                sides.append((stems.tolist(), True, *_documents_with(row, stem[code], toxic, len(stems))))
            for names, is_stem, bad, good in sides:
                keep = [i for i, w in enumerate(names) if len(w) >= 4 and not w.isdigit()]
                yield pa.RecordBatch.from_arrays([
                    pa.array([names[i] for i in keep], pa.string()), pa.array([is_stem] * len(keep), pa.bool_()),
                    pa.array(bad[keep], pa.int64()), pa.array(good[keep], pa.int64()),
                ], names=["term", "stem", "n_toxic", "n_other"])


def _lexicon(counts: list) -> list[tuple[str, bool]]:
    """Stems that stand for many forms, and the words that no such stem covers.

    A stem that hardly goes beyond one of its longer stems or words says no more than that one. Of
    nested stems the shortest that is left is kept, for the forms that the sample doesn't hold.
    """
    words = {r.term: r.n_toxic for r in counts if not r.stem}
    stems = {r.term: r.n_toxic for r in counts if r.stem}
    narrow: set[str] = set()
    for term, n in [*words.items(), *stems.items()]:
        narrow |= {term[:k] for k in STEMS if k < len(term) and n >= 0.9 * stems.get(term[:k], n + n)}
    kept: set[str] = set()
    for term in sorted(set(stems) - narrow, key=len):
        if not any(term[:k] in kept for k in STEMS if k < len(term)):
            kept.add(term)
    free = [t for t in words if not any(t[:k] in kept for k in STEMS if k < len(t))]
    return sorted([(t, True) for t in kept] + [(t, False) for t in free])


def edits_allowed(term: str, stem: bool) -> int:
    return (1 if len(term) >= 6 else 0) if stem else (0 if len(term) < 5 else 1 if len(term) < 8 else 2)


class Automaton:
    """Levenshtein automaton over a trie of terms, determinised on demand."""

    def __init__(self, terms: list[tuple[str, bool]], edits: list[int]):
        self.terms, self.edits = terms, edits
        self.child: list[dict[str, int]] = [{}]
        self.room, self.ends = [0], [[]]  # most edits of any term below, terms that end here
        for number, ((text, _), most) in enumerate(zip(terms, edits)):
            node = 0
            self.room[0] = max(self.room[0], most)
            for c in text:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.room.append(0)
                    self.ends.append([])
                node = self.child[node][c]
                self.room[node] = max(self.room[node], most)
            self.ends[node].append(number)
        letters = sorted({c for text, _ in terms for c in text})
        self.classes = np.zeros(0x110000, np.int32)
        for i, c in enumerate(letters):
            self.classes[ord(c)] = i + 1
        for sign, letter in LEET.items():
            if letter in letters and sign not in letters:
                self.classes[ord(sign)] = self.classes[ord(letter)]
        self.letters = ["", *letters]
        self.number: dict[tuple, int] = {((), None): 0}
        self.sets: list[tuple] = [((), None)]
        self.match: list[tuple[int, int]] = [(-1, 0)]
        self.live = [False]
        self.table = np.full((1024, len(self.letters)), -1, np.int32)
        self.table[0] = 0
        self.start = self._state({0: 0}, None)

    def _state(self, nodes: dict[int, int], sticky: tuple[int, int] | None) -> int:
        queue = list(nodes.items())
        while queue:  # a letter of the term may be missing from the word
            node, e = queue.pop()
            for after in self.child[node].values():
                if e < self.room[after] and e + 1 < nodes.get(after, 99):
                    nodes[after] = e + 1
                    queue.append((after, e + 1))
        whole = None
        for node, e in nodes.items():
            for term in self.ends[node]:
                if e <= self.edits[term]:
                    if self.terms[term][1]:
                        sticky = min(sticky, (e, term)) if sticky else (e, term)
                    else:
                        whole = min(whole, (e, term)) if whole else (e, term)
        key = (tuple(sorted(nodes.items())), sticky)
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            best = min(x for x in (sticky, whole) if x) if sticky or whole else None
            self.match.append((best[1], best[0]) if best else (-1, 0))
            self.live.append(bool(nodes))
            if len(self.sets) > len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        return self.number[key]

    def _step(self, state: int, letter: int) -> int:
        before, sticky = self.sets[state]
        c, after = self.letters[letter], {}

        def reach(node: int, e: int) -> None:
            if e <= self.room[node] and e < after.get(node, 99):
                after[node] = e

        for node, e in before:
            reach(node, e + 1)  # a letter too many
            for letter_, child in self.child[node].items():
                reach(child, e if letter_ == c else e + 1)
        return self._state(after, sticky)

    def run(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Best term and its edits for every word; term -1 where nothing matches."""
        size = np.array([len(w) for w in words], np.int64)
        letters = self.classes[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        begin = np.cumsum(size) - size
        state = np.full(len(words), self.start, np.int32)
        at, active = 0, np.flatnonzero(size > 0)
        while len(active):
            now, letter = state[active], letters[begin[active] + at]
            after = self.table[now, letter]
            missing = after < 0
            if missing.any():
                for pair in np.unique(now[missing].astype(np.int64) * len(self.letters) + letter[missing]).tolist():
                    s, c = divmod(pair, len(self.letters))
                    target = self._step(s, c)
                    self.table[s, c] = target
                after = self.table[now, letter]
            state[active] = after
            at += 1
            active = active[np.array(self.live)[after] & (size[active] > at)]
        match = np.array(self.match)[state]
        return match[:, 0], match[:, 1]


def evidence(data: np.ndarray, offsets: np.ndarray, automaton: Automaton):
    """Matches of all rows: row, term, edits, context score, quoted; and the number of words of each row."""
    code, row, starts, distinct = _words(data, offsets)
    n = len(offsets) - 1
    total = np.bincount(row, minlength=n)
    if not distinct or not automaton.terms:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0), np.zeros(0, bool), total
    term, edits = automaton.run(distinct)
    term, edits = term[code], edits[code]
    hits = np.flatnonzero(term >= 0)
    cue = np.array([(w in ADDRESS) + 2 * (w in REPORT) for w in distinct])[code]
    marks = np.concatenate(([0], np.cumsum(_QUOTES[data])))
    marks_left = marks[starts[hits]] - marks[offsets[row[hits]]]
    marks_right = marks[offsets[row[hits] + 1]] - marks[starts[hits]]
    quoted = (marks_left % 2 == 1) & (marks_right > 0)
    first = np.searchsorted(row, row[hits])
    last = np.searchsorted(row, row[hits], "right")
    near = lambda kind: (lambda s: s[np.minimum(hits + REACH + 1, last)] - s[np.maximum(hits - REACH, first)] > 0)(
        np.concatenate(([0], np.cumsum(cue == kind))))
    report = near(2)
    score = 1.0 + 0.5 * near(1) - 0.5 * report
    return row[hits], term[hits], edits[hits], score * 0.6 ** edits[hits], quoted, total


@dataclass
class Scorer:
    terms: list[tuple[str, bool]] = field(default_factory=list)
    edits: list[int] = field(default_factory=list)
    worth: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.array([-6.0, 0, 0, 0, 0]))

    def automaton(self) -> Automaton:
        return Automaton(self.terms, self.edits)

    def __call__(self, data: np.ndarray, offsets: np.ndarray, automaton: Automaton) -> np.ndarray:
        row, term, _, score, quoted, total = evidence(data, offsets, automaton)
        return _logistic(_inputs(row, score * self.worth[term], quoted, total) @ self.weights)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _inputs(row: np.ndarray, score: np.ndarray, quoted: np.ndarray, total: np.ndarray) -> np.ndarray:
    n = len(total)
    plain = np.bincount(row[~quoted], weights=score[~quoted], minlength=n)
    said = np.bincount(row[quoted], weights=score[quoted], minlength=n)
    dense = 100 * plain / np.maximum(total, 20)
    return np.column_stack([np.ones(n), np.minimum(plain, 2), np.log1p(plain), np.log1p(said), np.log1p(dense)])


def _hits(automaton_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of()
        for batch in batches:
            data, offsets = flat.utf8(batch.column(0))
            for a, b in flat.chunks(offsets):
                row, term, edits, score, quoted, total = evidence(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], automaton)
                bounds = np.searchsorted(row, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(a, b - a), pa.array(total, pa.int64()), flat.lists(term, bounds, pa.int32()),
                    flat.lists(edits, bounds, pa.int32()), flat.lists(score, bounds, pa.float64()),
                    flat.lists(quoted.astype(np.int8), bounds, pa.int8()),
                ], names=["label", "total", "term", "edits", "score", "quoted"])
    return run


def train(documents: DataFrame, sample: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Scorer:
    """Lexicon and model from a bounded sample of (doc_id, label)."""
    # Copies of one text would make all of its words look toxic. One of them labelled toxic makes the text toxic.
    rows = Stages(documents.sparkSession, "toxicity").settle(
        samples.texts(documents, sample, [text_col], id_col).groupBy(text_col).agg(F.max("label").alias("label")), "sample")
    seen = dict(rows.groupBy("label").count().collect())
    n_toxic, n_other = seen.get(1, 0), seen.get(0, 0)
    counted = rows.mapInArrow(_term_counts, "term string, stem boolean, n_toxic bigint, n_other bigint")
    least = max(LEAST_DOCUMENTS, int(LEAST_SHARE * n_toxic))
    odds = f"ln((n_toxic + 0.5D) / {n_toxic + 1}) - ln((n_other + 0.5D) / {n_other + 1})"
    found = (
        counted.groupBy("term", "stem").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_other").alias("n_other"))
        .filter(f"n_toxic >= {least}").selectExpr("*", f"{odds} as odds").filter(f"odds >= {LEAST_ODDS}")
        .orderBy(F.desc("n_toxic"), "term", "stem").limit(TERMS).collect()
    ) if n_toxic and n_other else []
    terms = _lexicon(found)
    worth = {(r.term, r.stem): min(r.odds / FULL_ODDS, 1.0) for r in found}
    scorer = Scorer(terms, [edits_allowed(*t) for t in terms], np.array([worth[t] for t in terms]))
    got = rows.mapInArrow(
        _hits(scorer.automaton), "label int, total bigint, term array<int>, edits array<int>, score array<double>, quoted array<byte>",
    ).toArrow()
    if not got.num_rows:
        return scorer
    label = got["label"].to_numpy() == 1
    column = lambda c: got[c].combine_chunks()
    bounds = column("term").offsets.to_numpy()
    row = np.repeat(np.arange(len(label)), np.diff(bounds))
    values = {c: column(c).flatten().to_numpy(zero_copy_only=False) for c in ("term", "edits", "score", "quoted")}
    # Misspellings that other documents hold as well are words of their own.
    most = np.array(scorer.edits, int)
    for level in (2, 1):
        at = values["edits"] == level
        wrong, right = (np.bincount(values["term"][at & (label[row] == x)], minlength=len(terms)) for x in (False, True))
        most = np.where(wrong > np.maximum(0.05 * right, 0.001 * n_other), np.minimum(most, level - 1), most)
    scorer.edits = most.tolist()
    keep = values["edits"] <= most[values["term"]] if len(terms) else np.zeros(0, bool)
    score = (values["score"] * scorer.worth[values["term"]])[keep] if len(terms) else values["score"]
    x = _inputs(row[keep], score, values["quoted"][keep] > 0, got["total"].to_numpy())
    scorer.weights = _fit(x, label.astype(float))
    return scorer


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = np.array([1e-3, *[0.1] * (x.shape[1] - 1)])
    if y.min() == y.max():
        w[0] = 6.0 if y[0] else -6.0
        return w
    for _ in range(30):
        p = _logistic(x @ w)
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def scored(documents: DataFrame, scorer: Scorer, text_col: str = "text", name: str = "toxicity_score") -> DataFrame:
    """``documents`` with the probability of being toxic."""
    documents = without(documents, name)
    place = documents.columns.index(text_col)
    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = scorer.automaton()
        for batch in batches:
            data, offsets = flat.utf8(batch.column(place))
            score = [np.zeros(0)]
            for a, b in flat.chunks(offsets):
                score.append(scorer(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], automaton))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(score).astype(float))], names=schema.names)

    return documents.mapInArrow(run, schema)
