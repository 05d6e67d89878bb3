"""Classifiers by held-out accuracy, page extraction against a plain reader, and the pipeline."""

import html
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from hostile import documents, nothing
from plain import contained_items, near_duplicate_components, personal_spans
from spendlever.llm import html_text, near_dedup, quality, samples, toxicity
from spendlever.llm.queries import (
    op4_quality_classifier, op7_toxicity, op8_html_extraction, quality_machine,
)

LARGER = "/root/testdata/sf0.01"


def joined(spark, folder, df, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    return [(r, labels[r["doc_id"]]) for r in df.collect() if r["doc_id"] in labels]


def auc(scores, labels):
    scores, labels = np.array(scores), np.array(labels)
    good, bad = scores[labels == 1], scores[labels == 0]
    return ((good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean())


def test_quality_on_held_out_documents(spark):
    df = op4_quality_classifier(spark, LARGER)
    rows = joined(spark, LARGER, df, "quality")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r, _ in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r, _ in rows)
    held = [(r["score"], y, r["predicted"]) for r, y in rows if r["held_out"]]
    assert auc([s for s, _, _ in held], [y for _, y, _ in held]) > 0.97
    assert np.mean([p for _, y, p in held if y == 1]) > 0.95  # clean documents stay


def test_toxicity_on_held_out_documents(spark):
    rows = joined(spark, LARGER, op7_toxicity(spark, LARGER), "toxic")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r, _ in rows)
    assert auc([r["score"] for r, _ in rows if r["held_out"]], [y for r, y in rows if r["held_out"]]) > 0.8
    assert np.mean([r["predicted"] for r, y in rows if y == 0]) < 0.02


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = [("idiot", False), ("worthless", False), ("scum", False), ("lowei", True), ("strange", True), ("moron", False)]
    edits = [toxicity.edits_allowed(*t) for t in terms]
    automaton = toxicity.Automaton(terms, edits)
    words = ["idiot", "idot", "idoit", "idiott", "xidiot", "worthles", "wortles", "wothles", "scum", "scam", "lowei", "loweisch", "lowe",
             "stranger", "strangr", "stangers", "moron", "maron", "m", "", "worthlessness", "scums", "idiotic"]
    term, found = automaton.run(words)
    for word, t, e in zip(words, term.tolist(), found.tolist()):
        best = None
        for k, ((text, stem), most) in enumerate(zip(terms, edits)):
            ends = range(len(word) + 1) if stem else [len(word)]
            d = min(distance(word[:n], text) for n in ends)
            if d <= most:
                best = min(best, d) if best is not None else d
        assert (t >= 0) == (best is not None) and (best is None or e == best), word
    assert automaton.run(["1diot", "w0rthl3ss"])[0].tolist() == [0, 1]  # digits stand for letters


def test_quotation_weighs_less_than_abuse():
    import pyarrow as pa

    automaton = toxicity.Automaton([("idiot", False)], [1])
    texts = ["you are an idiot", 'he said "an idiot" to him', "an idiot", ""]
    data, offsets = toxicity.flat.utf8(pa.array(texts))
    row, _, _, score, quoted, total = toxicity.evidence(data, offsets, automaton)
    assert row.tolist() == [0, 1, 2] and quoted.tolist() == [False, True, False]
    assert score[0] > score[2] > score[1] and total.tolist() == [4, 6, 2, 0]


def test_classifiers_on_hostile_rows(spark):
    df = documents(spark)
    labels = spark.createDataFrame([(3, 0), (5, 1), (5, 0), (7, 1), (None, 1), (4, None), (12, 0)], "doc_id long, label int")
    for sample in (samples.labelled(labels, "label", 10), samples.labelled(labels.limit(0), "label", 10)):
        machine = quality.train(df, sample, metadata=["n_chars", "source"])
        rows = quality.scored(df, machine, metadata=["n_chars", "source"]).collect()
        assert len(rows) == df.count() and all(0 <= r["quality_score"] <= 1 for r in rows)
        scorer = toxicity.train(df, sample)
        rows = toxicity.scored(df, scorer).collect()
        assert len(rows) == df.count() and all(0 <= r["toxicity_score"] <= 1 for r in rows)
    assert quality.scored(nothing(spark), machine, metadata=["n_chars", "source"]).count() == 0
    assert toxicity.scored(nothing(spark), scorer).count() == 0


def test_features_of_a_machine_are_scored_as_all_pairs():
    import pyarrow as pa

    random = np.random.default_rng(0)
    data, offsets = quality.flat.utf8(pa.array(["a b c a", "", "x y"]))
    bucket, value, bounds, statistics = quality.features(data, offsets)
    size = quality.BUCKETS + len(quality.STATISTICS) * quality.BINS + quality.META_BUCKETS
    machine = quality.Machine(np.sort(random.random((len(quality.STATISTICS), quality.BINS - 1))), 0.3, random.random(size), random.random((size, 4)))
    index, x, cuts = machine.assembled(bucket, value, bounds, statistics, np.zeros((3, 1), np.int64))
    for got, a, b in zip(machine.margins(index, x, cuts), cuts[:-1], cuts[1:]):
        i, v = index[a:b], x[a:b]
        pairs = sum(machine.factor[i[p]] @ machine.factor[i[q]] * v[p] * v[q] for p in range(len(i)) for q in range(p))
        assert got == pytest.approx(0.3 + machine.weight[i] @ v + pairs)


def test_pages_against_a_plain_reader(spark, sf_dir):
    got = {r["page_id"]: r for r in op8_html_extraction(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)\b[^>]*>", inner)
        text = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in blocks]
        want = "\n".join(filter(None, text))
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>only", "only"), ("<nav>" * 3, ""), ("<a>x</a>", ""),
    ("<script>var a = '<p>no</p>'</script><p>yes &lt;b&gt; &amp;c</p>", "yes <b> &c"),
    ("<main><h2>T</h2><aside>no</aside><p>a\n b&nbsp;d</p><form>x</form><ul><li>one<li>two</ul></main><footer>f</footer>", "T\na b d\none\ntwo"),
    ("<article><p>first</p><div class='cookie notice'>no</div><section id=comments><p>nice!</p></section><p>last</article>", "first\nlast"),
    ("<div id=menu><a href=x>m</a></div><div class=post><p>A long line of text that goes on and on.</p><p>Short.</p></div>"
     "<div class=sidebar>z</div>", "A long line of text that goes on and on.\nShort."),
])
def test_pages_by_hand(page, text):
    assert html_text.main_text(page) == text


def test_pages_on_hostile_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "<p>x"), (2, "<div>" * 3000 + "deep")], "page_id long, html string").selectExpr(
        "*", "'u' as url", "'t' as text", "1 as n_chars", "2 as kept")
    rows = html_text.extract(df).collect()
    assert sorted(r["text"] for r in rows) == ["", "", "deep", "x"] and html_text.extract(df.limit(0)).count() == 0


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").filter("doc_id < 400")
    columns = docs.columns
    rows = {r["doc_id"]: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, LARGER).write.parquet(path := str(tmp_path / str(k)))
        after = spark.read.parquet(path)
        left = {r["doc_id"]: r for r in after.collect()}
        if k == 0:
            machine = quality_machine(spark, docs, LARGER)
            scores = quality.scored(docs, machine, metadata=["n_chars"]).collect()
            want = {r["doc_id"] for r in scores if r["quality_score"] >= 0.7}
        elif k == 1:
            want = {i for i, c in near_duplicate_components({i: r["text"] for i, r in rows.items()}, 5).items() if i == c}
        elif k == 2:
            bench = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{LARGER}/benchmark.parquet").collect()}
            want = set(rows) - {d for d, *_ in contained_items({i: r["text"] for i, r in rows.items()}, bench)}
        else:
            want = set(rows)
        assert set(left) == want and after.count() == len(want), name
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
            assert all(left[i] == rows[i] for i in want) or k == 3
        if k == 3:
            assert any(personal_spans(r["text"]) for r in rows.values())
            assert not any(personal_spans(r["text"]) for r in left.values())
            assert all(r["n_chars"] == len(r["text"]) for r in left.values())
        docs, rows = after, left
    assert all(r["round_trip"] and r["n_pieces"] == len(r["piece_ids"]) for r in rows.values())


def test_pipeline_stages_on_hostile_rows(spark):
    df = documents(spark)
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality classifier", "near-duplicates", "decontamination", "personal data"):
        out = stages[name](spark, df, LARGER)
        assert out.columns == df.columns and out.count() <= df.count()
        assert stages[name](spark, nothing(spark), LARGER).count() == 0
    kept = stages["near-duplicates"](spark, df, LARGER).collect()
    assert sorted(r["doc_id"] for r in kept if r["text"] and r["text"].startswith("The same")) == [5]
    assert stages["sentencepiece"](spark, df, LARGER).count() == df.count()
    assert near_dedup.near_duplicates(nothing(spark)).count() == 0
