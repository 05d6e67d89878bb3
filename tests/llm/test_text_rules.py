"""Quality rules, decontamination, personal data and chat formatting: SQL twins, plain versions, hostile rows."""

import collections
import hashlib
import random

import pytest

from hostile import TEXTS, documents, nothing
from oracle_compare import connect, differences
from plain import contained_items, personal_spans, rule_counts
from spendlever.llm import chat, decontaminate, oracle, pii, quality_rules, queries


@pytest.mark.parametrize("name", list(oracle.statements()))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(queries.registry()[name](spark, sf_dir), connect(sf_dir), oracle.statements()[name]) == []


def test_quality_rules_on_hostile_rows(spark):
    df = documents(spark)
    rows = quality_rules.judged(df).collect()
    assert len(rows) == df.count()
    for r in rows:
        want = rule_counts(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"]) and r["component_id"] == "component_id"
    assert quality_rules.judged(nothing(spark)).count() == 0


def test_repeated_windows_against_plain_counting(spark):
    random.seed(8)
    texts = [" ".join(random.choices("abc", k=random.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.measured(df).collect()}
    assert got == {i: rule_counts(t)[4] for i, t in enumerate(texts)}


def test_decontamination_finds_items_at_the_threshold(spark):
    random.seed(9)
    vocabulary = [f"v{i}" for i in range(5000)]
    items = {i: " ".join(random.choices(vocabulary, k=n)) for i, n in enumerate([3, 5, 6, 12, 25, 40, 59, 120])}
    texts = {}
    for k in range(400):
        words = items[random.choice(list(items))].split()
        for _ in range(random.choice([0, 0, 1, 1, 2, 3])):
            words[random.randrange(len(words))] = "Changed,"
        filler = random.choices(vocabulary, k=random.choice([0, 30, 3000]))
        cut = random.randint(0, len(filler))
        texts[k] = " ".join(filler[:cut] + [w.upper() + random.choice(["", "!", "###"]) for w in words] + filler[cut:])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()) + [(99, None), (98, "")], "item_id long, text string")
    got = {tuple(r) for r in decontaminate.contained(docs, bench).collect()}
    want = contained_items(texts, items)
    assert got == want and 100 < len({d for d, *_ in want}) < 400
    kept = {r["doc_id"] for r in decontaminate.cleaned(docs, bench).collect()}
    assert kept == set(texts) - {d for d, *_ in want}


def test_common_phrases_make_candidates_in_proportion(spark, monkeypatch):
    """One question phrase in all items and documents: pairs to compare grow with the documents, not with items times documents."""
    phrase = "which of the following statements about this matter is true"
    random.seed(9)
    word = lambda: f"w{random.randrange(10**6)}"
    tried = []
    for n in (60, 120):
        items = [(i, f"{phrase} " + " ".join(word() for _ in range(30))) for i in range(n)]
        docs = [(i, f"{phrase} " + (items[i][1] if i % 10 == 0 else " ".join(word() for _ in range(60)))) for i in range(n)]
        benchmark = spark.createDataFrame(items, "item_id long, text string")
        sketch = decontaminate.sketches(decontaminate.shingled(benchmark, "item_id", "text").selectExpr("id as item_id", "shingles"))
        posted = decontaminate.shingled(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text").selectExpr("id", "explode(shingles) as value")
        tried.append(posted.join(sketch, "value").select("id", "item_id").distinct().count())
        got = decontaminate.contained(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, i) for i in range(0, n, 10)}
    assert tried == [6, 12]


def test_items_shorter_than_a_shingle_are_found_whole(spark):
    docs = spark.createDataFrame([(0, "well, the QUICK brown fox."), (1, "quick the brown"), (2, "yes"), (3, None), (None, "yes"), (4, "no; yes!")], "doc_id long, text string")
    items = [(10, "The quick brown"), (11, "Yes"), (12, ""), (13, None), (14, "one two three four"), (15, "yes"), (15, "a long item of more than five words"), (16, "quick fox")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in decontaminate.contained(docs, benchmark, short_items=True).collect()}
    assert got == {(0, 10, 1, 1), (2, 11, 1, 1), (4, 11, 1, 1)}
    assert decontaminate.cleaned(docs, benchmark).count() == 6  # too short to say that a document leaks


def test_decontamination_on_hostile_rows(spark):
    df = documents(spark)
    bench = spark.createDataFrame([(0, TEXTS[5]), (1, None), (1, TEXTS[10]), (None, TEXTS[5])], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.contained(df, bench).collect()} == {5, 6, 10}
    kept = decontaminate.cleaned(df, bench)
    assert kept.columns == df.columns and kept.count() == df.count() - 5
    assert decontaminate.cleaned(nothing(spark), bench).count() == 0
    assert decontaminate.cleaned(df, bench.limit(0)).count() == df.count()


def test_personal_data_against_plain_patterns(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.op9_personal_data(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        want = personal_spans(r["text"])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        mine = got[r["doc_id"]]
        assert mine["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        counts = collections.Counter(k for k, _, _ in want)
        assert [mine[f"n_{k}"] for k in pii.KINDS[:4]] == [counts[k] for k in pii.KINDS[:4]]
        assert set(filter(None, text.split(","))) <= set(mine["spans"].split(","))


def test_personal_data_on_random_texts():
    random.seed(10)
    parts = ["a", ".", "@", "-", "1", "23", "4", "+", " ", "(", ")", "é", "255", "0", "@x.y", "9807915762804490", "+1 (974) 555-3436", "\n", "٣"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 40))) for _ in range(4000)]
    for t in [*texts, "1" * 5000, "a" * 5000 + "@", "+" * 3000, "1." * 3000, "a@" * 3000, None]:
        assert [s[:3] for s in pii.find(t) if s[0] in pii.KINDS[:4]] == personal_spans(t)


def test_scored_kinds_need_checks_and_context():
    kinds = lambda t: [s[0] for s in pii.find(t) if s[0] not in pii.KINDS[:4]]
    assert kinds("konto GB82 WEST 1234 5698 7654 32.") == ["iban"] and kinds("konto GB83 WEST 1234 5698 7654 32.") == []
    digest = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    assert kinds(f'token = "{digest}"') == ["secret"] and kinds(f"commit {digest}") == [] and kinds(digest) == []
    assert kinds("ssn 123-45-6789") == ["national_id"] and kinds("order 123-45-6789") == []
    assert pii.mask("to a@b.cc, 1.2.3.4", pii.find("to a@b.cc, 1.2.3.4")) == "to <EMAIL>, <IP>"


def test_personal_data_on_hostile_rows(spark):
    df = documents(spark)
    masked = pii.masked(df)
    assert masked.columns == df.columns and masked.count() == df.count()
    by = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert by[10] == "mail <EMAIL> or <PHONE>, <IP>, <CARD>" and by[0] is None and by[11] == TEXTS[11]
    assert pii.personal_data(df).filter("doc_id = 10").first()["personal_data"][0]["kind"] == "email"
    assert pii.digests(nothing(spark)).count() == 0 and pii.masked(nothing(spark)).count() == 0


def walked(tree, parent, score):
    """Best branch of one tree by following every leaf up."""
    best = None
    for leaf in parent:
        if leaf in parent.values():
            continue
        path, now = [], leaf
        while now is not None and now in parent and now not in path:
            path.append(now)
            now = parent[now]
        if now in path:
            continue
        key = (-sum(score[i] for i in path), -len(path), leaf)
        best = min(best, (key, path[::-1])) if best else (key, path[::-1])
    return best[1] if best else None


def test_best_branches_of_reply_trees(spark):
    random.seed(4)
    rows, want = [], {}
    for tree in [None, *range(40)]:
        n = random.randint(1, 30)
        parent = {i: random.choice([None, *range(max(0, i - 3), i), *[i - 1] * 4 * (i > 0), 999]) if i else None for i in range(n)}
        score = {i: random.randint(0, 3) for i in range(n)}
        if n > 6 and tree is not None and tree % 7 == 0:
            parent[1], parent[3] = 3, 1  # a circle
        rows += [(tree, i, parent[i], random.choice(["user", "assistant", None]), f"t{i}", float(score[i])) for i in range(n)]
        if path := walked(tree, parent, score):
            want[tree] = path
    rows += [(1000, i, i - 1 if i else None, "user", f"t{i}", 1.0) for i in range(150)]
    want[1000] = list(range(150))
    schema = "tree_id long, message_id long, parent_id long, role string, text string, score double"
    messages = spark.createDataFrame(rows, schema).selectExpr("*", "1 as branch", "2 as depth", "3 as above")
    out = chat.read_back(chat.best_conversations(messages), ["tree_id"]).collect()
    assert {r["tree_id"]: [int(x["text"][1:]) for x in r["turns"]] for r in out} == want
    two = chat.best_conversations(messages, best=2).groupBy("tree_id").count().collect()
    assert max(r["count"] for r in two) == 2
    assert chat.best_conversations(messages.limit(0)).count() == 0


def test_template_is_reversible(spark):
    random.seed(2)
    parts = ["<", "\\", "|", "\n", "<|", "<\\|", "<|im_end|>", "a", "assistant", "<|im_start|>", "\\n", "é", "$1", "\\l"]
    text = lambda n: "".join(random.choices(parts, k=random.randint(0, n)))
    rows = [(i // 4, i % 4, text(5) if random.random() < 0.5 else "assistant", text(14)) for i in range(2000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.templated(df, ["conv_id"], "turn"), ["conv_id"]).collect()
    want = collections.defaultdict(list)
    for conversation, _, role, body in rows:
        want[conversation].append((role, body, body if role == "assistant" else ""))
    assert {r["conv_id"]: [tuple(x) for x in r["turns"]] for r in back} == want


def test_conversations_with_ties_and_nulls(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 3, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as score", "2 as tree_id")
    out = {r["tree_id"]: [x["text"] for x in r["turns"]] for r in chat.read_back(
        chat.best_conversations(chat.conversations_as_trees(df)), ["tree_id"]).collect()}
    assert out == {1: ["", "a", "a", "b"], None: ["x"]}
