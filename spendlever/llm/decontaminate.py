"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Test items are short and documents long, so similarity of whole texts says little; what
counts is the share of an item's shingles that a document holds. Items are partitioned by the power of
two above their number of shingles. A partition with at most u shingles per item keeps a sketch of
u - ceil(0.8 u) + 1 shingle hashes of each item (bottom-k MinHash): a document with 80 % of an item
can miss no more than that less one, so it holds a sketch value and no item is lost. This holds for any choice of an item's
shingles, so the sketch takes those that the fewest items share, and among these the smallest hashes: a phrase
that many items have in common makes candidates only for items that consist of little else. Documents with a sketch value are
candidates; only they are read again, and their full shingle sets are compared with the item's.

With ``short_items``, items with fewer words than a shingle are found by their whole sequence of words, in one more pass over the
documents for each such number of words that occurs. ``cleaned`` drops no document for them: so short a phrase says nothing about leakage.

Everything is DataFrame and SQL work. The sketch table is a stage table of known size: the planner broadcasts it where it is
small, and shuffles by hash where the benchmark is large.

Words are runs of letters and digits in lower case. Defined results. Null or empty texts hold nothing; items without words
match nothing. Rows that share an id are one document with the shingles of all its rows; repeated items with one id likewise, and
rows with fewer words than a shingle count only where none of the id's rows is longer.
Ties don't arise. Other columns are ignored by ``contained`` and kept by ``cleaned``. Empty tables give empty results
(``cleaned``: all documents).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spendlever.llm.stages import Stages

WIDTH = 5
THRESHOLD = 80
NOT_WORD = r"[^\\p{L}\\p{N}]+"


def _words(text_col: str) -> str:
    return f"filter(split(lower(coalesce(`{text_col}`, '')), '{NOT_WORD}'), x -> x != '')"


def shingled(df: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """(id, shingles): distinct hashes of the word windows of each row."""
    window = ", ".join(["x", *(f"get(w, i + {j})" for j in range(1, width))])
    windows = f"transform(slice(w, 1, greatest(size(w) - {width - 1}, 0)), (x, i) -> xxhash64({window}))"
    words = _words(text_col)
    # The words are bound to a variable, so that they are split once however the plan is rearranged.
    return df.selectExpr(f"cast(`{id_col}` as bigint) as id", f"get(transform(array({words}), w -> array_distinct({windows})), 0) as shingles")


def sketches(items: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(value, item_id): the rarest shingle hashes of every item, as many as its size partition asks for."""
    sized = items.selectExpr("item_id", "cast(pow(2, ceil(log2(size(shingles)))) as int) as most", "explode(shingles) as value")
    shared = sized.groupBy("value").agg(F.count("*").alias("items"))
    ordered = sized.join(shared, "value").groupBy("item_id", "most").agg(F.sort_array(F.collect_list(F.struct("items", "value"))).alias("held"))
    return ordered.selectExpr(
        "item_id", f"explode(slice(held.value, 1, most - cast(ceil(most * {threshold} / 100D) as int) + 1)) as value")


def _short(benchmark: DataFrame, items: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """(item_id, words, value): items with fewer words than a shingle, by their whole sequence."""
    parts = []
    for words in range(1, width):
        exact = benchmark.filter(f"size({_words(text_col)}) = {words}")
        parts.append(shingled(exact, item_col, text_col, words).selectExpr("id as item_id", f"{words} as words", "explode(shingles) as value"))
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.union(more)
    return rows.filter("item_id is not null").distinct().join(items, "item_id", "left_anti")


def _held_whole(documents: DataFrame, short: DataFrame, id_col: str, text_col: str, threshold: int) -> DataFrame | None:
    """Documents that hold enough of an item's short sequences; None if there are no such items."""
    lengths = sorted(r[0] for r in short.select("words").distinct().collect())  # fewer than a shingle has words
    hits = None
    for words in lengths:
        posted = shingled(documents, id_col, text_col, words).filter("id is not null").select("id", F.explode("shingles").alias("value"))
        found = posted.join(short.filter(f"words = {words}"), "value").select("id", "item_id", "words", "value").distinct()
        hits = found if hits is None else hits.union(found)
    if hits is None:
        return None
    sizes = short.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    return (
        hits.groupBy("id", "item_id").agg(F.count("*").alias("n_common")).join(sizes, "item_id")
        .filter(f"100 * n_common >= {threshold} * n_shingles").selectExpr("id as doc_id", "item_id", "n_shingles", "n_common")
    )


def contained(
    documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, threshold: int = THRESHOLD, short_items: bool = False,
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_common) of every item with at least ``threshold`` percent of its shingles in a document."""
    stages = Stages(documents.sparkSession, "decontaminate")
    merged = lambda df: df.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("shingles"))).alias("shingles"))
    items = stages.settle(
        merged(shingled(benchmark, item_col, item_text_col, width)).filter("id is not null and size(shingles) > 0").withColumnRenamed("id", "item_id"), "items")
    sketch = stages.settle(sketches(items, threshold), "sketch")
    posted = shingled(documents, id_col, text_col, width).select("id", F.explode_outer("shingles").alias("value"))
    found = stages.settle(posted.join(sketch, "value").filter("id is not null").select("id", "item_id").distinct(), "found")
    near = shingled(
        documents.join(found.select(F.col("id").alias(id_col)).distinct(), id_col, "left_semi"), id_col, text_col, width)
    held = near.join(found, "id").join(items.withColumnRenamed("shingles", "wanted"), "item_id")
    # Rows of one id are merged by the hits they have, not by their whole sets.
    hits = held.selectExpr("id", "item_id", "size(wanted) as n_shingles", "array_intersect(wanted, shingles) as hit")
    long = (
        hits.groupBy("id", "item_id").agg(
            F.first("n_shingles").alias("n_shingles"), F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).alias("n_common"))
        .filter(f"100 * n_common >= {threshold} * n_shingles")
        .selectExpr("id as doc_id", "item_id", "cast(n_shingles as bigint) as n_shingles", "cast(n_common as bigint) as n_common")
    )
    if not short_items:
        return long
    short = _held_whole(documents, stages.settle(_short(benchmark, items, item_col, item_text_col, width), "short"), id_col, text_col, threshold)
    return long if short is None else long.union(short)


def cleaned(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **how) -> DataFrame:
    """``documents`` without those that hold an item of at least a shingle's words; documents without an id are kept."""
    leaks = contained(documents, benchmark, id_col=id_col, **how).select(F.col("doc_id").alias(id_col)).distinct()
    return documents.join(leaks, id_col, "left_anti").select(documents.columns)
