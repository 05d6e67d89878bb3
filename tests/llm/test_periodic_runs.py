import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from hostile import TEXTS, documents, nothing
from spendlever.llm import flat, periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """Every distance compared with the whole text; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        start = None
        for i in range(len(words) - q + 1):
            if i < len(words) - q and words[i] == words[i + q]:
                start = i if start is None else start
            elif start is not None:
                if i + q - start >= max(24, 3 * q):
                    found.setdefault((start, i + q), q)
                start = None
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    if doc_id is not None and words and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = s, length, q
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_query_matches_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.op11_periodic_runs(spark, sf_dir).collect()))
    assert got == sorted(plain_row(r["doc_id"], r["text"]) for r in rows)
    assert sum(r[1] for r in got) > 10


@st.composite
def periodic_text(draw):
    k = draw(st.integers(1, 4))
    words = draw(st.lists(st.integers(0, k), max_size=160))
    for _ in range(draw(st.integers(0, 3))):
        block = draw(st.lists(st.integers(0, k), min_size=1, max_size=40))
        if draw(st.booleans()):  # a block that is periodic itself, but for its end
            block = (block[:3] * len(block))[:len(block) - 1] + [9]
        at = draw(st.integers(0, len(words)))
        words[at:at] = (block * 20)[:draw(st.integers(0, 200))]
    return words


@settings(max_examples=150, deadline=None)
@given(st.lists(periodic_text(), min_size=1, max_size=4))
def test_runs_of_any_texts(texts):
    got = [[] for _ in texts]
    for text, *run in zip(*(x.tolist() for x in periodic_runs.runs_of([np.array(t, np.int64) for t in texts]))):
        got[text].append(tuple(run))
    assert got == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("kind", ["thue-morse", "fibonacci", "repeated thue-morse", "one word"])
def test_texts_that_defeat_hashes_and_nest_runs(kind):
    fibonacci, after = "a", "ab"
    while len(after) < 1500:
        fibonacci, after = after, after + fibonacci
    morse = [bin(i).count("1") & 1 for i in range(4096)]
    words = {"thue-morse": morse, "fibonacci": list(after), "repeated thue-morse": morse[:512] * 4, "one word": [0] * 2000}[kind]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    text = np.array([number[w] for w in words])
    _, *found = periodic_runs.runs_of([text])
    assert list(zip(*(x.tolist() for x in found))) == plain_runs(words)


def test_selection_depends_on_the_context_alone_and_leaves_no_gap():
    rng = np.random.default_rng(3)
    text = np.concatenate([rng.integers(0, 3, 300), np.tile(rng.integers(0, 3, 7), 30), rng.integers(0, 3, 300)])
    seq = periodic_runs.Sequence([text, text])
    for scale in (4, 8, 16, 32):
        regions = []
        for p in range(1, scale // 3 + 1):
            a, b = periodic_runs._stretches(seq.words[:-p] == seq.words[p:], p, scale)
            regions.append((a, b, np.full(len(a), p)))
        chosen = set(periodic_runs._selected(seq, scale, regions).tolist())
        context = {}
        for i in range(seq.n - 2 * scale + 1):
            assert context.setdefault(tuple(seq.words[i:i + 2 * scale]), i in chosen) == (i in chosen)
        for i in range(seq.n - 3 * scale + 2):
            inside = any(((a <= i) & (b >= i + 3 * scale - 1)).any() for a, b, _ in regions)
            assert inside or any(i + j in chosen for j in range(scale))


def test_hostile_rows(spark):
    df = documents(spark).selectExpr("*", "'x' as n_words_", "'y' as runs", "'z' as collapsed")
    rows = periodic_runs.periodic_runs(df).collect()
    assert len(rows) == df.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    for i, text in enumerate(TEXTS):
        words = WORD.findall(text or "")
        assert by[i]["n_words"] == len(words)
        if len(words) < 1000:
            assert [tuple(r) for r in by[i]["runs"]] == plain_runs(words)
    assert by[5]["runs"] and by[5]["collapsed"] == " ".join(TEXTS[5].split()[:by[5]["runs"][0]["period"]])
    assert by[0]["collapsed"] == by[2]["collapsed"] == ""
    assert "n_words_" in rows[0].asDict() and rows[0]["score"] == "score"
    assert periodic_runs.periodic_runs(nothing(spark)).count() == 0


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(flat, "hashes", lambda data, a, b: np.zeros(len(a), np.uint64))
    data, offsets = flat.utf8(__import__("pyarrow").array(["a b a c"]))
    starts, ends, _ = flat.words(data, offsets)
    assert periodic_runs.word_numbers(data, starts, ends).tolist() == [0, 1, 0, 2]
