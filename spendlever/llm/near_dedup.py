"""MinHash near-duplicates by a signature-coordinate inverted join.

Every distinct shingle set gets a signature of ``COORDINATES`` minima and is posted under each
coordinate-value pair. Values that only one set holds can't collide and are skipped; a set with
fewer than ``MATCHES`` colliding values can't have a partner and is skipped whole. The rest are
ordered from the rarest value to the most common one, and only the prefix that must hold a
common value of any pair with ``MATCHES`` equal coordinates is joined, so common passages stay
in the suffix. Collisions of a pair are counted on both signatures, and the pairs that reach
``MATCHES`` are confirmed on the full shingle sets.

Two rounds keep large groups from making all their pairs. First each posting list is merged
towards its most central member, the one whose values are the commonest, and the confirmed links
form components. Lists that lie in one component are skipped. The sets in the other lists are
joined exactly: their shingles are ordered from the rarest to the most common one, sets that
are similar enough must meet in a prefix of that order, and in each prefix list only the members
outside its largest component are paired, and only across components. Links inside a component
can't change it, so no link is lost by this.

A pair of similarity 0.8 reaches 14 of 32 equal coordinates but for one chance in 800,000.

Defined results. Null or empty text, or text without words: empty set, linked with nothing. Equal
sets are one class, known by a 64-bit sum over its hashed shingles. Rows that share an id are
judged each by its own text. A row with a null id is linked like any other, but names no component
and is kept only if no other row of its component has an id. Other columns of the input are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spendlever.llm import flat
from spendlever.llm.stages import Stages, components

COORDINATES = 32
MATCHES = 14

_STEP = [pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(256)]
SKETCH = "doc_id bigint, n_shingles bigint, cls bigint, signature array<bigint>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and the n + 1 offsets of the rows in them."""
    data = flat.lowered(data)
    starts, ends, rows = flat.words(data, offsets)
    word = flat.hashes(data, starts, ends)
    count = np.diff(rows)
    size = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    first = flat.ranges(rows[:-1], size)
    short = np.repeat(count < width, size)
    padded = np.concatenate([word, np.zeros(width, np.uint64)])
    total = np.zeros(len(first), np.uint64)
    left = np.repeat(count, size)
    for j in range(width):
        part = padded[first + j] * np.uint64(_STEP[j])
        total += np.where(short & (left <= j), np.uint64(0), part)
    total += np.where(short, left, 0).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    value = flat.mix(total)
    bounds = np.concatenate(([0], np.cumsum(size)))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            value[a:b].sort()
    fresh = np.ones(len(value), bool)
    fresh[1:] = value[1:] != value[:-1]
    edge = bounds[:-1]
    fresh[edge[size > 0]] = True
    return value[fresh], np.concatenate(([0], np.cumsum(fresh)))[bounds]


def signatures(value: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """``n`` minima of every non-empty row; each is the image of one shingle under one bijection."""
    first = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(first), n), np.uint64)
    for k in range(n):
        least = np.minimum.reduceat(value * np.uint64(_STEP[16 + k]), first) if len(first) else value[:0]
        out[:, k] = least ^ np.uint64(_STEP[128 + k])  # values of different coordinates never meet
    return out


def _classes(value: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One number per distinct set, null for the empty one."""
    some = np.diff(bounds) > 0
    out = np.zeros(len(some), np.uint64)
    if some.any():
        out[some] = flat.mix(np.add.reduceat(flat.mix(value ^ np.uint64(_STEP[200])), bounds[:-1][some]))
    return pa.array(out.astype(np.int64), mask=~some)


def _sketch(width: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.int64()),
                            ("signature", pa.list_(pa.int64()))])
        for batch in batches:
            data, offsets = flat.utf8(batch.column(1))
            for a, b in flat.chunks(offsets, flat.SMALL_CHUNK_BYTES):
                value, bounds = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)
                size = np.diff(bounds)
                got = signatures(value, bounds, n).astype(np.int64).ravel()
                ends = np.concatenate(([0], np.cumsum((size > 0) * n)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(size, pa.int64()),
                    _classes(value, bounds), flat.lists(got, ends, pa.int64()),
                ], schema=schema)
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("cls", pa.int64()), ("shingles", pa.list_(pa.int64()))])
        for batch in batches:
            data, offsets = flat.utf8(batch.column(1))
            for a, b in flat.chunks(offsets, flat.SMALL_CHUNK_BYTES):
                value, bounds = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)
                yield pa.RecordBatch.from_arrays([
                    _classes(value, bounds), flat.lists(value.astype(np.int64), bounds, pa.int64()),
                ], schema=schema)
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough (percent)."""
    joined = (
        pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("set_b")), "b")
        .selectExpr("a", "b", "cast(size(array_intersect(set_a, set_b)) as bigint) as common",
                    "cast(size(set_a) + size(set_b) as bigint) as both")
    )
    return joined.filter(f"100 * common >= {threshold} * (both - common)").select("a", "b")


def _colliding(pairs: DataFrame, posted: DataFrame, matches: int, threshold: int) -> DataFrame:
    """The pairs with enough equal coordinates whose set sizes allow the similarity at all."""
    side = lambda x: posted.select(
        F.col("cls").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("shared").alias(f"shared_{x}"))
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .filter(f"100 * least(n_a, n_b) >= {threshold} * greatest(n_a, n_b)")
        .filter(f"size(array_intersect(shared_a, shared_b)) >= {matches}").select("a", "b")
    )


def _rarest(sets: DataFrame, chosen: DataFrame, threshold: int) -> DataFrame:
    """(shingle, cls, part, n, place): the rarest shingles of every chosen set that a similar set may share.

    Shingles of one set only come first and are counted, not posted.
    """
    own = sets.join(chosen, "cls").withColumn("n", F.size("shingles").cast("bigint"))
    single = own.select("cls", F.explode("shingles").alias("shingle"))
    common = single.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
    held = single.join(common, "shingle").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("held"))
    return (
        held.join(own.select("cls", "part", "n"), "cls")
        .selectExpr("cls", "part", "n", "n - size(held) as alone", "held.shingle as shared",
                    f"n - cast(ceil({threshold} * n / 100D) as bigint) + 1 as reach")
        .filter("reach > alone")
        .selectExpr("cls", "part", "n", "alone", "posexplode(slice(shared, 1, cast(reach - alone as int))) as (at, shingle)")
        .selectExpr("shingle", "cls", "part", "n", "alone + at + 1 as place")
    )


def _crossing(prefixes: DataFrame, threshold: int) -> DataFrame:
    """Pairs that share a prefix shingle, lie in different components, and may be similar by sizes and places."""
    parts = prefixes.groupBy("shingle", "part").agg(F.count("*").alias("members"))
    largest = parts.groupBy("shingle").agg(F.max_by("part", "members").alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    listed = prefixes.join(largest, "shingle")
    one = listed.filter("part != main").selectExpr("shingle", "cls as a", "part as part_a", "n as n_a", "place as place_a")
    other = listed.selectExpr("shingle", "cls as b", "part as part_b", "n as n_b", "place as place_b")
    room = f"{threshold} * (n_a + n_b) <= {100 + threshold} * (n_{{0}} - place_{{0}} + 1)"
    return (
        one.join(other, "shingle").filter("part_a != part_b")
        .filter(f"{room.format('a')} and {room.format('b')}")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def near_duplicates(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 5, threshold: int = 80,
    coordinates: int = COORDINATES, matches: int = MATCHES,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``documents``.

    ``width`` is the number of words of a shingle and ``threshold`` the similarity in percent.
    """
    stages = Stages(documents.sparkSession, "near-dedup")
    texts = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = stages.settle(texts.mapInArrow(_sketch(width, coordinates), SKETCH), "sketch")

    # Copies become one class before anything is paired.
    classes = stages.settle(
        sketch.filter("cls is not null").groupBy("cls")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
             F.first("signature").alias("signature")), "class",
    )
    posting = classes.select("cls", F.explode("signature").alias("value"))
    common = posting.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    posted = stages.settle(
        posting.join(common, "value")
        .groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("held"))
        .filter(f"size(held) >= {matches}")
        .selectExpr("cls", "held.value as shared", "aggregate(held.df, 0L, (s, x) -> s + x) as weight", f"slice(held.value, 1, size(held) - {matches} + 1) as prefix")
        .join(classes.select("cls", "n_shingles"), "cls"), "posted",
    )
    chosen = classes.join(posted.select("cls"), "cls", "left_semi").select("doc_id", "cls")
    sets = stages.settle(
        texts.alias("t").join(chosen.select("doc_id").distinct().alias("c"), F.expr("t.doc_id <=> c.doc_id"), "left_semi")
        .mapInArrow(_sets(width), "cls bigint, shingles array<bigint>")
        .join(chosen.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]), "sets",
    )
    listed = stages.settle(posted.select("cls", "weight", F.explode("prefix").alias("value")), "listed")

    # Round one: every list is merged towards its most central member.
    heads = listed.groupBy("value").agg(F.max_by("cls", "weight").alias("a"))
    stars = listed.join(heads, "value").filter("cls != a").select(
        F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b")).distinct()
    links = stages.settle(
        _confirmed(_colliding(stars, posted, matches, threshold), sets, threshold), "links"
    )
    first = components(stages, links)

    # Round two: sets of lists that hold several components, joined by their rarest shingles.
    marked = listed.join(first.withColumnRenamed("node", "cls"), "cls", "left").selectExpr(
        "cls", "value", "coalesce(component, cls) as part")
    marked = stages.settle(marked, "marked")
    mixed = marked.groupBy("value").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low != high")
    unsettled = marked.join(mixed.select("value"), "value", "left_semi").select("cls", "part").distinct()
    prefixes = stages.settle(_rarest(sets, unsettled, threshold), "prefixes")
    more = stages.settle(_confirmed(_crossing(prefixes, threshold), sets, threshold), "more")
    final = components(stages, first.selectExpr("node as a", "component as b").union(more))

    stages.drop(posted, sets, listed, links, marked, prefixes, more)

    named = classes.select("cls", "doc_id").join(
        final.withColumnRenamed("node", "cls"), "cls", "left"
    ).selectExpr("cls", "doc_id", "coalesce(component, cls) as part")
    lowest = named.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    named = named.select("cls", "part").join(lowest, "part").select("cls", "component_id")
    return sketch.select("doc_id", "n_shingles", "cls").join(named, "cls", "left").selectExpr(
        "doc_id", "n_shingles", "coalesce(component_id, doc_id) as component_id"
    ).selectExpr("*", "doc_id <=> component_id as kept")
