"""Both classifier queries against plain scorers, document by document and word by word."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from spendlever.llm import flat, quality, queries, samples, toxicity

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_hash(word: bytes) -> int:
    return int(flat.hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])


def plain_statistics(data: bytes) -> list[float]:
    words = WORD.findall(data)
    low = [w.lower() for w in words]  # of bytes, so only A to Z
    n, size = max(len(words), 1), max(len(data), 1)
    among = lambda chars: sum(c in chars for c in data)
    symbols = rb"#*$%&|<>{}[]\^~=_@"
    letters = sum(65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in data)
    return [
        math.log1p(len(words)), sum(map(len, words)) / n, among(symbols) / size, sum(65 <= c <= 90 for c in data) / max(letters, 1),
        among(b"0123456789") / size, among(b".!?") / n, among(b"!") / n, len(set(low)) / n, max(Counter(low).values(), default=0) / n,
        len(set(zip(low, low[1:]))) / max(n - 1, 1), math.log1p(data.count(b"\n")) - math.log1p(len(words)),
        sum(any(c in symbols for c in w) for w in words) / n,
    ]


def plain_quality(machine, text, meta, known) -> float:
    """Weights and all pairs of features, one by one."""
    data = (text or "").encode()
    times = Counter(known.setdefault(w.lower(), word_hash(w.lower())) % quality.BUCKETS for w in WORD.findall(data))
    norm = math.sqrt(sum(math.log1p(t) ** 2 for t in times.values()))
    features = [(b, math.log1p(t) / max(norm, 1e-9)) for b, t in times.items()]
    for j, value in enumerate(plain_statistics(data)):
        features.append((quality.BUCKETS + j * quality.BINS + sum(e < value for e in machine.edges[j]), 0.5))
    features += [(machine.hashed_from + m, 0.5) for m in meta]
    index, x = np.array([i for i, _ in features]), np.array([v for _, v in features])
    factor = machine.factor[index].astype(float) * x[:, None]
    pairs = np.triu(factor @ factor.T, 1).sum()
    return 1 / (1 + math.exp(-(machine.bias + machine.weight[index].astype(float) @ x + pairs)))


def test_quality_query_equals_a_plain_scorer(spark, sf_dir, monkeypatch):
    docs = queries.table(spark, sf_dir, "documents")
    machine = queries.quality_machine(spark, docs, sf_dir)
    monkeypatch.setattr(queries, "quality_machine", lambda *_: machine)
    got = {r["doc_id"]: r for r in queries.op4_quality_classifier(spark, sf_dir).collect()}
    known: dict = {}
    rows = docs.select("doc_id", "text", quality._metadata(queries.QUALITY_METADATA).alias("meta")).collect()
    assert len(got) == len(rows) > 0
    for r in rows:
        want = plain_quality(machine, r["text"], r["meta"], known)
        mine = got[r["doc_id"]]
        assert mine["score"] == pytest.approx(want, abs=1e-4), r["doc_id"]
        assert mine["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and mine["predicted"] == (mine["score"] >= 0.7)


def plain_words(text: str) -> list[tuple[int, str]]:
    """Start and small form of every stretch of letters, digits, @ and $; capitals beyond Latin-1 stay."""
    return [(m.start(), "".join(c.lower() if c < "ß" and c != "×" else c for c in m[0]))
            for m in re.finditer(r"[0-9A-Za-z@$\u0080-\U0010ffff]+", text)]


def edits_to(term: str, word: str) -> list[int]:
    """Edit distances from the term to every beginning of the word."""
    row = list(range(len(word) + 1))
    for i, x in enumerate(term, 1):
        before, row = row, [i]
        for j, y in enumerate(word, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row


def plain_match(scorer, word: str, letters: set) -> tuple[int, int] | None:
    """Fewest edits, then first term, over the whole lexicon."""
    word = "".join(toxicity.LEET[c] if c in toxicity.LEET and c not in letters and toxicity.LEET[c] in letters else c for c in word)
    found = []
    for number, ((term, stem), most) in enumerate(zip(scorer.terms, scorer.edits)):
        if not stem and abs(len(word) - len(term)) > most:
            continue
        row = edits_to(term, word[:len(term) + most]) if stem else edits_to(term, word)
        least = min(row) if stem else row[-1]
        if least <= most:
            found.append((least, number))
    return min(found, default=None)


def plain_toxicity(scorer, text, known: dict, letters: set) -> float:
    words = plain_words(text or "")
    plain = said = 0.0
    for at, (start, word) in enumerate(words):
        if word not in known:
            known[word] = plain_match(scorer, word, letters)
        if known[word] is None:
            continue
        edits, term = known[word]
        near = {w for _, w in words[max(at - toxicity.REACH, 0):at + toxicity.REACH + 1]}
        score = (1 + 0.5 * bool(near & set(toxicity.ADDRESS)) - 0.5 * bool(near & set(toxicity.REPORT))) * 0.6 ** edits * scorer.worth[term]
        if text[:start].count('"') % 2 == 1 and '"' in text[start:]:
            said += score
        else:
            plain += score
    x = [1, min(plain, 2), math.log1p(plain), math.log1p(said), math.log1p(100 * plain / max(len(words), 20))]
    return 1 / (1 + math.exp(-max(-30, min(30, float(np.dot(x, scorer.weights))))))


def test_toxicity_query_equals_a_plain_scorer(spark, sf_dir, monkeypatch):
    # The lexicon is learnt from the larger tables, so that it holds words and stems; the smaller ones are scored.
    larger = "/root/testdata/sf0.01"
    sample = samples.labelled(queries.table(spark, larger, "labels"), "toxic", toxicity.SAMPLE, f"{queries.remainder(5)} != 0")
    scorer = toxicity.train(queries.table(spark, larger, "documents"), sample)
    assert 0 < len(scorer.terms) < toxicity.TERMS  # the bound cuts nothing here
    monkeypatch.setattr(toxicity, "train", lambda *_: scorer)
    got = {r["doc_id"]: r["score"] for r in queries.op7_toxicity(spark, sf_dir).collect()}
    known: dict = {}
    letters = {c for term, _ in scorer.terms for c in term}
    rows = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert len(got) == len(rows) > 0
    for r in rows:
        assert got[r["doc_id"]] == pytest.approx(plain_toxicity(scorer, r["text"], known, letters), abs=1e-9), r["doc_id"]
    # Misspelt, quoted, reported and addressed terms, and signs in place of letters.
    texts = [None, "", '"']
    for term, _ in [t for t, most in zip(scorer.terms, scorer.edits) if most][:8]:
        wrong = term[:2] + term[3:]
        texts += [f"you are {wrong}", f'they said "{wrong}" and left', f"{wrong.upper()} {term}xx {term.replace('e', '3')}", f"the word {term} " * 3, f'"{term}']
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.scored(df, scorer).collect():
        assert r["toxicity_score"] == pytest.approx(plain_toxicity(scorer, r["text"], known, letters), abs=1e-9), r["text"]
    assert any(m and m[0] > 0 for m in known.values())
