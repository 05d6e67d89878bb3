import contextlib
import math
import os
import re
import threading
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from hostile import TEXTS, documents, nothing
from spendlever.functions.lineage import shared_folder
from spendlever.llm import lm_scoring as lm, queries
from spendlever.llm.elias_fano import Sequence, Trie
from spendlever.llm.stages import FREE, Stages

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)) + ["</s>\n"]


def plain_scores(texts, trained, order):
    """Interpolated absolute discounting straight from the formulas, with the operator's code book."""
    count, n = Counter(), defaultdict(Counter)
    for text, own in zip(texts, trained):
        if own:
            tokens = tokens_of(text)
            count.update(tokens)
            padded = ["<s>\n"] * (order - 1) + tokens
            for i in range(order - 1, len(padded)):
                for k in range(1, order):
                    n[tuple(padded[i - k:i])][padded[i]] += 1
    total, kinds = sum(count.values()), len(count)
    book = lm.code_book(total)
    out = []
    for text in texts:
        tokens = tokens_of(text)
        padded = ["<s>\n"] * (order - 1) + tokens
        base = score = 0.0
        for i in range(order - 1, len(padded)):
            w = padded[i]
            p = (count[w] + lm.ALPHA) / (total + lm.ALPHA * (kinds + 1))
            base += math.log10(p)
            for k in range(1, order):
                after = n.get(tuple(padded[i - k:i]))
                if after:
                    c = sum(after.values())
                    seen = book[max(x for x in range(256) if book[x] <= after[w] - lm.DISCOUNT + 1e-9)] if after[w] else 0
                    p = seen / c + lm.DISCOUNT * len(after) / c * p
            score += math.log10(p)
        out.append((len(tokens), sum(count[w] > 0 for w in tokens), base, score))
    return out, total


def close(got, want):
    assert got[:2] == want[:2]
    assert got[2:] == pytest.approx(want[2:], rel=1e-9, abs=1e-9)


def test_query_matches_a_plain_model(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    held = [zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in rows]
    want, total = plain_scores([r["text"] for r in rows], [not h for h in held], lm.ORDER)
    got = {r["doc_id"]: r for r in queries.op12_lm_scoring(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r, h, w in zip(rows, held, want):
        g = got[r["doc_id"]]
        assert g["held_out"] == h and g["train_tokens"] == total
        close((g["n_tokens"], g["n_known"], g["base_score"], g["score"]), w)
    fresh = [got[r["doc_id"]] for r, h in zip(rows, held) if h]
    assert sum(g["score"] for g in fresh) > sum(g["base_score"] for g in fresh)


def test_query_scores_with_contexts_of_four_words(spark, tmp_path):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["a", "b", "c"], 40)) for _ in range(40)]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want, _ = plain_scores(texts, [not h for h in held], 5)
    got = {r["doc_id"]: r["score"] for r in queries.op12_lm_scoring(spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx([w[3] for w in want], rel=1e-9)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_many_blocks_shards_and_hot_contexts(spark, monkeypatch, order):
    rng = np.random.default_rng(order)
    texts = [" ".join("the" if rng.random() < 0.4 else f"w{int(rng.pareto(1.0) * 3)}" for _ in range(rng.integers(0, 90))) for _ in range(300)]
    trained = [bool(i % 3) for i in range(300)]
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 500)
    monkeypatch.setattr(lm, "HOT_SHARE", 16)
    df = spark.createDataFrame([(i, t, bool(o)) for i, (t, o) in enumerate(zip(texts, trained))], "doc_id long, text string, own boolean")
    scores, total = lm.scored(df.repartition(3), "own", order)
    want, n = plain_scores(texts, trained, order)
    assert total == n
    got = {r["doc_id"]: r for r in scores.collect()}
    for i, w in enumerate(want):
        close((got[i]["n_tokens"], got[i]["n_known"], got[i]["base_score"], got[i]["score"]), w)
        assert got[i]["trained"] == trained[i]


@pytest.mark.parametrize("held_back", [False, True])
def test_lists_for_several_shards_and_hot_contexts_of_all_lengths(spark, monkeypatch, held_back):
    rng = np.random.default_rng(9)
    line = "the same line of words in one text after another"
    texts = [" ".join(line if rng.random() < 0.3 else f"w{int(rng.pareto(1.0) * 3)}" for _ in range(rng.integers(0, 60))) for _ in range(200)]
    trained = [bool(i % 4) and not held_back for i in range(200)]
    monkeypatch.setattr(lm, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 400)
    monkeypatch.setattr(lm, "LEAST_PARTS", 1)
    df = spark.createDataFrame([(i, t, bool(o)) for i, (t, o) in enumerate(zip(texts, trained))], "doc_id long, text string, own boolean")
    got = {r["doc_id"]: r for r in lm.scored(df.repartition(3), "own", 5)[0].collect()}
    if held_back:
        assert len(got) == 200 and all(r["score"] == 0 and r["base_score"] == 0 for r in got.values())
        return
    for i, w in enumerate(plain_scores(texts, trained, 5)[0]):
        close((got[i]["n_tokens"], got[i]["n_known"], got[i]["base_score"], got[i]["score"]), w)


class Disk:
    """The most bytes that shuffle files and stage tables took while it watched, beyond those at its start."""

    def __init__(self, spark):
        env = spark._jvm.org.apache.spark.SparkEnv.get()
        self.roots = [*env.blockManager().diskBlockManager().localDirsString(), shared_folder(spark).removeprefix("file:")]

    def size(self, name=""):
        total = 0
        for path in (os.path.join(d, f) for root in self.roots for d, _, files in os.walk(root) for f in files if f.startswith(name)):
            with contextlib.suppress(OSError):  # it may go meanwhile
                total += os.path.getsize(path)
        return total

    def __enter__(self):
        self.most, self.done, begin = 0, threading.Event(), self.size()

        def watch():
            while not self.done.wait(0.02):
                self.most = max(self.most, self.size() - begin)

        self.thread = threading.Thread(target=watch)
        self.thread.start()
        return self

    def __exit__(self, *_):
        self.done.set()
        self.thread.join()


def test_tokens_travel_once_for_all_orders(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"word{int(k)}" for k in rng.zipf(1.3, 500) % 50_000) for _ in range(1000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    with Disk(spark) as disk:
        lm.scored(df, "doc_id % 10 > 0", 5)[0].agg({"score": "sum"}).collect()
    assert disk.most < 20 * 501_000  # bytes a token, of which 8 are needed; lists for each order took 30


def test_stages_free_their_shuffle_files(spark):
    stages, disk = Stages(spark, "freed"), Disk(spark)
    df = spark.range(50_000).selectExpr("id % 5000 as k", "uuid() as v").repartition(4, "k")
    before, setting = disk.size("shuffle_"), spark.conf.get(FREE)
    assert stages.settle(df, "kept").count() == 50_000
    kept = disk.size("shuffle_") - before
    assert stages.settle(df, "free", free=True).count() == 50_000
    for _ in range(100):  # they go in the background
        if disk.size("shuffle_") - before < 1.5 * kept:
            break
        time.sleep(0.1)
    assert 0 < disk.size("shuffle_") - before < 1.5 * kept and spark.conf.get(FREE) == setting


def test_code_book_rounds_down_and_keeps_small_counts():
    book = lm.code_book(10**9)
    counts = np.array([1, 2, 63, 64, 65, 1000, 10**6, 10**9])
    values = book[lm.codes_of(counts, book)]
    assert (values <= counts - lm.DISCOUNT + 1e-6).all() and values[:4].tolist() == [0.25, 1.25, 62.25, 63.25]
    assert (values[4:] > 0.85 * counts[4:]).all() and len(book) == 256 and (np.diff(book) > 0).all()
    assert (lm.codes_of(np.arange(1, 65), lm.code_book(1)) == np.arange(1, 65)).all()


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(2**63, 2**63 + 9), max_size=200))
def test_order_of_large_numbers(values):
    values = np.array(values, np.uint64)
    order = lm._ascending(values)
    assert sorted(order.tolist()) == list(range(len(values))) and values[order].tolist() == sorted(values.tolist())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.sampled_from([0, 1, 7, 2**20, 2**50, 2**63]), st.lists(st.integers(0, 6000), min_size=1, max_size=50))
def test_elias_fano_against_a_sorted_list(values, stretch, asked):
    values = sorted(v * stretch % 2**64 if stretch else v for v in values)
    seq = Sequence.of(np.array(values, np.uint64), (values[-1] + 1) if values else 1)
    assert seq.at(np.arange(len(values))).tolist() == values
    wanted = np.array([v * max(stretch, 1) % 2**64 for v in asked] + values, np.uint64)
    assert seq.successor(wanted).tolist() == np.searchsorted(np.array(values, np.uint64), wanted).tolist()


def test_trie_in_a_mapped_file(tmp_path):
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2))
    size = rng.integers(0, 6, len(keys))
    pointers = np.concatenate(([0], np.cumsum(size)))
    prints = np.concatenate([np.sort(rng.choice(2**40, n, replace=False)) for n in size]).astype(np.uint64)
    codes = rng.integers(1, 256, len(prints))
    trie = Trie.of(keys, np.arange(len(keys)), size * 3, pointers, prints, codes)
    path = tmp_path / "level"
    path.write_bytes(trie.tobytes())
    for t in (trie, Trie.map(str(path))):
        assert t.find(keys).tolist() == list(range(len(keys))) and (t.find(keys + np.uint64(1)) == -1).all()
        a, b = t.children(np.arange(len(keys)))
        assert a.tolist() == pointers[:-1].tolist() and b.tolist() == pointers[1:].tolist()
        owner = np.repeat(np.arange(len(keys)), size)
        assert t.find_successors(owner, prints).tolist() == codes.tolist()
        assert t.find_successors((owner + 1) % len(keys), prints).sum() == 0  # never beyond its context
        assert t.find_successors(np.full(3, -1), prints[:3]).tolist() == [0, 0, 0]
    assert path.stat().st_size < len(prints) * 7 + len(keys) * 12 + 1000
    empty = Trie.on(Trie.of(keys[:0], size[:0], size[:0], np.zeros(1, int), prints[:0], codes[:0]).tobytes())
    assert empty.find(keys[:2]).tolist() == [-1, -1]


def test_trie_read_in_order_equals_searches():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2))
    size = rng.integers(0, 6, len(keys))
    owner = np.repeat(np.arange(len(keys)), size)
    prints = np.concatenate([np.sort(rng.choice(2**40, n, replace=False)) for n in size]).astype(np.uint64)
    trie = Trie.of(keys, np.arange(len(keys)), size, np.concatenate(([0], np.cumsum(size))), prints, rng.integers(1, 256, len(prints)))
    trie = Trie.on(trie.tobytes())
    for asked in (keys, keys + np.uint64(1), keys[::3]):
        assert trie.find_ascending(asked).tolist() == trie.find(asked).tolist()
    for context, after in ((owner, prints), (owner, prints + np.uint64(1)), (np.where(owner % 3 == 0, -1, owner), prints)):
        assert trie.find_successors_ascending(context, after).tolist() == trie.find_successors(context, after).tolist()
    assert trie.kinds().tolist() == size.tolist()
    empty = Trie.of(keys[:0], size[:0], size[:0], np.zeros(1, int), prints[:0], np.zeros(0, np.uint8))
    assert empty.find_ascending(keys[:2]).tolist() == [-1, -1] and len(empty.kinds()) == 0
    assert empty.find_successors_ascending(np.array([-1, -1]), prints[:2]).tolist() == [0, 0]


@given(st.lists(st.integers(0, 5000), max_size=300), st.sampled_from([1, 7, 2**20, 2**50]))
def test_all_numbers_of_a_sequence(values, stretch):
    values = np.array(sorted(v * stretch for v in values), np.uint64)
    assert Sequence.of(values, int(values[-1]) + 1 if len(values) else 1).all().tolist() == values.tolist()


def test_model_is_kept_as_tries(spark, tmp_path):
    df = spark.createDataFrame([(0, "a b a"), (1, "b a")], "doc_id long, text string")
    lm.scored(df, model_path=f"{tmp_path}/model")
    tries = [Trie.on(r["trie"]) for r in spark.read.parquet(f"{tmp_path}/model").collect()]
    assert sum(int(t.counts.sum()) for t in tries) == 7 and sum(t.successors.n for t in tries) == 5


def test_hostile_rows(spark):
    df = documents(spark)
    rows = lm.scored(df, "doc_id % 2 = 0")[0].collect()
    assert len(rows) == df.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    for i, text in enumerate(TEXTS):
        assert by[i]["n_tokens"] == len(tokens_of(text)) and by[i]["trained"] == (i % 2 == 0)
        assert math.isfinite(by[i]["score"]) and math.isfinite(by[i]["base_score"])
    assert by[0]["n_tokens"] == by[2]["n_tokens"] == 1 and by[0]["score"] == by[2]["score"]
    assert lm.scored(nothing(spark))[0].count() == 0
    untrained = lm.scored(df.filter("doc_id < 5"), "false")[0].collect()
    assert all(r["base_score"] == 0 and r["score"] == 0 and r["n_known"] == 0 for r in untrained)
