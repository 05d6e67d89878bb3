import random

import numpy as np
import pytest

from hostile import documents, nothing
from plain import near_duplicate_components, shingles
from spendlever.llm import near_dedup, queries


def result(df, **how):
    return {r["doc_id"]: r for r in near_dedup.near_duplicates(df, **how).collect()}


def test_query_matches_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = near_duplicate_components({r["doc_id"]: r["text"] for r in rows}, 4)
    got = {r["doc_id"]: r for r in queries.op5_minhash_near_dedup(spark, sf_dir).collect()}
    assert {k: r["component_id"] for k, r in got.items()} == want
    assert all(r["n_shingles"] == len(shingles(x["text"], 4)) for x in rows for r in [got[x["doc_id"]]])
    assert all(r["kept"] == (r["component_id"] == k) for k, r in got.items())


def test_groups_of_copies_chains_and_neighbours_below_the_threshold(spark):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = random.choices(vocabulary, k=120)
    texts, n = {}, 0
    for edits in [0] * 40 + [1, 2, 3, 4, 5, 6, 8, 10, 14] * 8:  # a large group, from copies to distant relatives
        words = list(base)
        for _ in range(edits):
            words[random.randrange(len(words))] = random.choice(vocabulary)
        texts[n], n = " ".join(words), n + 1
    chain = random.choices(vocabulary, k=100)
    for step in range(8):  # each links with the next, the first not with the last
        chain = chain[3:] + random.choices(vocabulary, k=3)
        texts[n], n = " ".join(chain), n + 1
    passage = " ".join(random.choices(vocabulary, k=60))
    for _ in range(60):  # a shared passage alone is no link
        texts[n], n = passage + " " + " ".join(random.choices(vocabulary, k=90)), n + 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = result(df, width=4)
    assert {k: r["component_id"] for k, r in got.items()} == near_duplicate_components(texts, 4)


def test_hostile_rows(spark):
    df = documents(spark)
    rows = near_dedup.near_duplicates(df).collect()
    assert len(rows) == df.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[0]["n_shingles"] == by[1]["n_shingles"] == by[2]["n_shingles"] == 0
    assert by[0]["kept"] and by[1]["kept"] and by[3]["n_shingles"] == 1
    assert by[6]["component_id"] == 5 and not by[6]["kept"] and by[8]["component_id"] == 7
    assert near_dedup.near_duplicates(nothing(spark)).count() == 0


def test_signatures_estimate_similarity():
    random.seed(1)
    left = [random.randrange(10**9) for _ in range(900)]
    a, b = np.array(sorted(left[:800]), np.uint64), np.array(sorted(left[100:]), np.uint64)
    value = near_dedup.flat.mix(np.concatenate([a, b]))
    got = near_dedup.signatures(value, np.array([0, 800, 1600]), 64)
    assert (got[0] == got[1]).mean() == pytest.approx(700 / 900, abs=0.17)
