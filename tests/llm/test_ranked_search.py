import math
import re
from collections import Counter

import numpy as np
import pytest

from hostile import documents, nothing
from spendlever.llm import fp_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms_of(text):
    return TERM.findall((text or "").translate(LOW))


def plain_ranking(docs, items, k=10):
    """Every document scored for every item."""
    found = [(i, Counter(terms_of(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        wanted, scores = set(terms_of(text)), []
        for i, c in found:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def key(row):
    return tuple((x is None, 0 if x is None else x) for x in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("leaf, postings", [(1, 50), (4, 100_000), (64, 3000)])
def test_ranking_against_brute_force_with_ties_and_copies(spark, monkeypatch, leaf, postings):
    rng = np.random.default_rng(leaf)
    words = [f"w{i}" for i in range(60)] + ["Éa", "中文", "x1y"]
    texts = [" ".join(rng.choice(words[:int(rng.integers(2, 63))], int(rng.integers(0, 40)))) for _ in range(250)]
    texts += texts[:40] * 3 + ["w1 w2 w3"] * 90 + ["W1, w2-w3"] * 5 + [None, "", " .,;"]
    docs = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)] + [(None, "w1 w2 w3 w4")]
    items = [(i, " ".join(rng.choice(words, int(rng.integers(1, 12))))) for i in range(30)] + [(100, "nowhere"), (101, None), (102, "w1 w1 w1")]
    monkeypatch.setattr(fp_search, "LEAF", leaf)
    monkeypatch.setattr(fp_search, "TREE_POSTINGS", postings)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id int, text string")
    same(fp_search.ranked(df, asked).collect(), plain_ranking(docs, items))


def test_blocks_of_items_give_the_same_ranking(spark, sf_dir, monkeypatch):
    df, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, fp_search.ranked(df, items).collect()))
    monkeypatch.setattr(fp_search, "BLOCK_TERMS", 300)
    assert sorted(map(tuple, fp_search.ranked(df, items).collect())) == whole


def test_bounds_hold_for_every_document_below_a_node():
    rng = np.random.default_rng(7)
    size = rng.integers(0, 12, 400)
    bounds = np.concatenate(([0], np.cumsum(size)))
    rank = np.concatenate([np.sort(rng.choice(30, n, replace=False)) for n in size]).astype(np.int64)
    tf, m = rng.integers(1, 9, len(rank)), rng.integers(10, 400, 400)
    tree = fp_search.Tree(bounds, rank, tf, m, 30)
    assert sorted(tree.order) == list(range(400)) and max(tree.hi[i] - tree.lo[i] for i, c in enumerate(tree.children) if not c) <= fp_search.LEAF
    for node in range(len(tree.lo)):
        below = tree.order[tree.lo[node]:tree.hi[node]]
        assert tree.least[node] == m[below].min()
        most = np.zeros(30, int)
        for d in below:
            np.maximum.at(most, rank[bounds[d]:bounds[d + 1]], tf[bounds[d]:bounds[d + 1]])
        assert (tree.most[node] == most).all()
        if tree.children[node]:
            spans = sorted((tree.lo[c], tree.hi[c]) for c in tree.children[node])
            assert spans[0][0] == tree.lo[node] and spans[-1][1] == tree.hi[node]
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_subtrees_are_left_out():
    """Documents that can't reach the best scores are never scored."""
    scored = []

    class Counting(fp_search.Search):
        def _score(self, tree, node, items, ids, unknown):
            scored.append(tree.hi[node] - tree.lo[node])
            super()._score(tree, node, items, ids, unknown)

    n = 4000
    rank = np.zeros(n, np.int64)
    rank[:20] = 1
    tree = fp_search.Tree(np.arange(n + 1), rank, np.ones(n, np.int64), np.full(n, 50), 2)
    search = Counting(np.array([1, 100]), np.array([0, 2]), np.array([0, 1]), 10)
    search.run(tree, np.arange(n), np.zeros(n, bool))
    assert search.best[0][1].tolist() == list(range(10)) and sum(scored) <= 2 * fp_search.LEAF


def test_hostile_rows(spark):
    df = documents(spark)
    items = spark.createDataFrame([(1, "the same text"), (1, "words"), (None, "word5 one"), (3, None), (4, "...")], "item_id long, text string")
    got = fp_search.ranked(df, items).collect()
    docs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    same([r for r in got if r["item_id"] is None], plain_ranking(docs, [(None, "word5 one")]))
    same([r for r in got if r["item_id"] == 1], plain_ranking(docs, [(1, "the same text"), (1, "words")]))
    assert {r["item_id"] for r in got} == {1, None}
    assert fp_search.ranked(nothing(spark), items).count() == 0 and fp_search.ranked(df, items.limit(0)).count() == 0
