"""Ranked lexical search over a document FP-tree, by branch and bound.

Documents are reduced to their term vectors restricted to the terms of the items. Inside a task
the terms of every vector stand from the most frequent one in the corpus to the rarest, so that
vectors share paths of a prefix tree (an FP-tree). A node stands for all documents below it and
knows, for each term, the largest tf among them, and their smallest m. A term's score grows with tf
and falls with m, so the two give an upper bound for every document below the node. Each item
walks the tree depth first, the most promising child first, and leaves out every subtree whose
bound is under the item's k-th best score so far; documents of a leaf are scored in full. A bound that
equals the k-th best score is still followed, since the smaller doc_id wins.

A tree holds at most ``TREE_POSTINGS`` postings (or one document); a task builds one after the
other and carries the best scores along, so its memory doesn't follow its share of the corpus. Every
task hands on at most k rows per item. Items are searched in blocks of about ``BLOCK_TERMS``
terms; a block's terms travel with the job, and each block reads all documents.

Defined results. A text that is null or has no term counts no document. Rows that share an id
are documents of their own, and rows that share an item id items of their own. Among equal scores
the smallest doc_id comes first and a null doc_id last. Items without terms, and items no
document has a term of, give no rows. Extra columns are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spendlever.llm import flat
from spendlever.llm.stages import Stages

#: Bytes of a term: digits, letters and everything beyond ASCII.
TERM = flat.byte_set(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))
BLOCK_TERMS = 16_384
TREE_POSTINGS = 2_000_000
#: Documents that are scored together at the end of a path.
LEAF = 64
K = 10

VECTORS = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
FOUND = "item_no bigint, doc_id bigint, score bigint"


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every term, and the n + 1 positions in them where each row's terms begin."""
    inside = TERM[data]
    edge = np.zeros(len(data) + 1, bool)  # a text's first byte begins a term, whatever stands before it
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def distinct_terms(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Number of every term among the distinct ones, and their bytes."""
    code, _ = pd.factorize(flat.hashes(data, starts, ends))
    first = np.zeros(code.max() + 1 if len(code) else 0, np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    body = data.tobytes()
    return code, [body[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]


def term_vectors(data: np.ndarray, offsets: np.ndarray, number: dict[bytes, int]) -> tuple[np.ndarray, ...]:
    """Per row: how many terms it has, and (bounds, term, tf) of those that ``number`` knows."""
    data = flat.lowered(data)
    starts, ends, rows = terms(data, offsets)
    code, known = distinct_terms(data, starts, ends)
    term = np.fromiter((number.get(t, -1) for t in known), np.int64, len(known))[code]
    n, size = np.diff(rows), max(len(number), 1)
    key = np.repeat(np.arange(len(n)), n) * size + term
    found, tf = np.unique(key[term >= 0], return_counts=True)
    return n, np.searchsorted(found, np.arange(len(n) + 1) * size), found % size, tf


def restricted(documents: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Documents that have a term: their number of terms and their known terms with tf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat.utf8(batch.column(1))
            for a, b in flat.chunks(offsets):
                n, bounds, term, tf = term_vectors(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], number)
                made = pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(n, pa.int64()),
                    flat.lists(term, bounds, pa.int32()), flat.lists(tf, bounds, pa.int32()),
                ], names=["doc_id", "n", "terms", "tfs"])
                yield made.filter(pa.array(n > 0))

    return documents.select(F.col(id_col).cast("bigint"), text_col).mapInArrow(run, VECTORS)


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Distinct terms of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat.utf8(batch.column(1))
            for a, b in flat.chunks(offsets):
                part = flat.lowered(data[offsets[a]:offsets[b]])
                starts, ends, rows = terms(part, offsets[a:b + 1] - offsets[a])
                code, known = distinct_terms(part, starts, ends)
                sets = [[known[i] for i in np.unique(code[x:y])] for x, y in zip(rows[:-1], rows[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sets, pa.list_(pa.binary()))], names=["item_id", "terms"])

    return items.select(F.col(item_col).alias("item_id"), text_col).mapInArrow(
        run, f"item_id {items.schema[item_col].dataType.simpleString()}, terms array<binary>")


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Saturating part of a term's score."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Tree:
    """FP-tree over some documents: rank r is the r-th most frequent term."""

    def __init__(self, bounds: np.ndarray, rank: np.ndarray, tf: np.ndarray, m: np.ndarray, n_terms: int):
        """``rank`` ascends inside each document."""
        self.children: list[list[int]] = []
        self.lo, self.hi, self.parent = [], [], []
        size = np.diff(bounds)
        order = np.arange(len(size))
        todo = [(0, len(size), 0, -1)]
        while todo:
            lo, hi, depth, parent = todo.pop()
            node = self._node(lo, hi, parent)
            while hi - lo > LEAF:
                part = order[lo:hi]
                step = np.full(hi - lo, -1)  # the next term of the path, -1 where a vector ends
                more = size[part] > depth
                step[more] = rank[bounds[part[more]] + depth]
                depth += 1
                if step[0] >= 0 and (step == step[0]).all():
                    continue
                moved = np.argsort(step, kind="stable")
                order[lo:hi] = part[moved]
                step = step[moved]
                cuts = lo + np.concatenate(([0], np.flatnonzero(step[1:] != step[:-1]) + 1, [hi - lo]))
                self._split(todo, cuts, step[cuts[:-1] - lo], depth, node)
                break
        self.order = order
        self._sum_up(bounds, rank, tf, m, n_terms)

    def _node(self, lo: int, hi: int, parent: int) -> int:
        self.lo.append(lo)
        self.hi.append(hi)
        self.parent.append(parent)
        self.children.append([])
        if parent >= 0:
            self.children[parent].append(len(self.lo) - 1)
        return len(self.lo) - 1

    def _split(self, todo: list, cuts: np.ndarray, step: np.ndarray, depth: int, node: int) -> None:
        """Large branches are split further; neighbouring small ones share a leaf."""
        start = None
        for a, b, term in zip(cuts[:-1].tolist(), cuts[1:].tolist(), step.tolist()):
            large = b - a > LEAF
            if start is not None and (large or b - start > LEAF):
                todo.append((start, a, depth, node))
                start = None
            if large and term < 0:  # equal paths to their end
                todo += [(x, min(x + LEAF, b), depth, node) for x in range(a, b, LEAF)]
            elif large:
                todo.append((a, b, depth, node))
            elif start is None:
                start = a
        if start is not None:
            todo.append((start, int(cuts[-1]), depth, node))

    def _sum_up(self, bounds: np.ndarray, rank: np.ndarray, tf: np.ndarray, m: np.ndarray, n_terms: int) -> None:
        """Largest tf of each term and smallest m below every node; postings in the order of the leaves."""
        size = np.diff(bounds)[self.order]
        at = flat.ranges(bounds[:-1][self.order], size)
        self.bounds = np.concatenate(([0], np.cumsum(size)))
        self.rank, self.tf, self.m = rank[at], tf[at], m[self.order]
        self.most = np.zeros((len(self.lo), n_terms), np.int32)
        self.least = np.full(len(self.lo), np.iinfo(np.int64).max)
        leaf = np.zeros(len(self.order), np.int64)
        for node, below in enumerate(self.children):
            if not below:
                leaf[self.lo[node]:self.hi[node]] = node
        np.maximum.at(self.most, (np.repeat(leaf, size), self.rank), self.tf)
        np.minimum.at(self.least, leaf, self.m)
        for node in range(len(self.lo) - 1, 0, -1):  # a child is numbered after its parent
            above = self.parent[node]
            np.maximum(self.most[above], self.most[node], out=self.most[above])
            self.least[above] = min(self.least[above], self.least[node])


class Search:
    """Best documents of every item of a block, over any number of trees."""

    def __init__(self, weight: np.ndarray, item_bounds: np.ndarray, item_rank: np.ndarray, k: int):
        self.weight, self.bounds, self.rank, self.k = weight, item_bounds, item_rank, k
        n = len(item_bounds) - 1
        self.floor = np.ones(n, np.int64)  # a score of 0 is no result
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in range(n)]

    def _per_item(self, parts: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Sums of each item's terms, row by row."""
        size = self.bounds[items + 1] - self.bounds[items]
        columns = self.rank[flat.ranges(self.bounds[items], size)]
        return np.add.reduceat(parts[:, columns], np.concatenate(([0], np.cumsum(size)[:-1])), axis=1)

    def run(self, tree: Tree, ids: np.ndarray, unknown: np.ndarray) -> None:
        """``ids`` and ``unknown`` (whether the id is null) of the tree's documents, as they were given."""
        every = np.arange(len(self.floor))
        if not len(every):
            return
        bound = np.concatenate([
            self._per_item(self.weight * gain(tree.most[a:a + LEAF].astype(np.int64), tree.least[a:a + LEAF, None]), every)
            for a in range(0, len(tree.lo), LEAF)])
        todo = [(0, every)]
        while todo:
            node, items = todo.pop()
            items = items[bound[node, items] >= self.floor[items]]
            if not len(items):
                continue
            if below := tree.children[node]:
                promise = (bound[np.ix_(below, items)] - self.floor[items]).max(axis=1)
                todo += [(below[i], items) for i in np.argsort(promise, kind="stable")]
            else:
                self._score(tree, node, items, ids, unknown)

    def _score(self, tree: Tree, node: int, items: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        lo, hi = tree.lo[node], tree.hi[node]
        a, b = tree.bounds[lo], tree.bounds[hi]
        row = np.repeat(np.arange(hi - lo), np.diff(tree.bounds[lo:hi + 1]))
        parts = np.zeros((hi - lo, len(self.weight)), np.int64)
        rank = tree.rank[a:b]
        parts[row, rank] = self.weight[rank] * gain(tree.tf[a:b].astype(np.int64), tree.m[lo:hi][row])
        scores = self._per_item(parts, items)
        place = tree.order[lo:hi]
        for j in np.flatnonzero((scores >= self.floor[items]).any(axis=0)):
            item = items[j]
            good = scores[:, j] >= self.floor[item]
            s, d, u = (np.concatenate(x) for x in zip(self.best[item], (scores[good, j], ids[place[good]], unknown[place[good]])))
            first = np.lexsort((d, u, -s))[:self.k]
            self.best[item] = s[first], d[first], u[first]
            if len(first) == self.k:
                self.floor[item] = s[first[-1]]


def _searched(vectors: DataFrame, rank_of: np.ndarray, weight: np.ndarray, item_no: np.ndarray,
              item_bounds: np.ndarray, item_rank: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best documents of each item in every task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(weight, item_bounds, item_rank, k)
        held: list[tuple[np.ndarray, ...]] = []
        postings = 0

        def grow() -> None:
            ids, unknown, n, size, term, tf = (np.concatenate(x) for x in zip(*held))
            held.clear()
            bounds = np.concatenate(([0], np.cumsum(size)))
            rank = rank_of[term]
            row = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((rank, row))
            m = 10 + 90 * n * n_docs // n_terms
            search.run(Tree(bounds, rank[order], tf[order], m, len(weight)), ids, unknown)

        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                ids, n, lists, tfs = (part.column(i) for i in range(4))
                held.append((
                    ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), n.to_numpy(),
                    np.diff(lists.offsets.to_numpy()).astype(np.int64), lists.flatten().to_numpy(), tfs.flatten().to_numpy()))
                postings += len(held[-1][4])
                if postings >= TREE_POSTINGS:
                    grow()
                    postings = 0
        if held:
            grow()
        scores, ids, unknown = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*search.best)) if search.best else [np.zeros(0, np.int64)] * 3
        owner = np.repeat(item_no, [len(s) for s, _, _ in search.best])
        yield pa.RecordBatch.from_arrays([
            pa.array(owner, pa.int64()), pa.array(ids, pa.int64(), mask=unknown.astype(bool)), pa.array(scores, pa.int64()),
        ], names=["item_no", "doc_id", "score"])

    return vectors.mapInArrow(run, FOUND)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def ranked(
    documents: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The k best documents of each item: item_id, rank, doc_id, score."""
    spark = documents.sparkSession
    stages = Stages(spark, "ranked")
    wanted = stages.settle(
        item_terms(items, item_col, item_text_col).withColumn("item_no", F.monotonically_increasing_id()), "items")
    postings = wanted.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(postings / BLOCK_TERMS))
    found = None
    for block in range(blocks):
        # A block is a bounded share of the items.
        mine = wanted.filter(f"pmod(xxhash64(item_no), {blocks}) = {block} and size(terms) > 0").select("item_no", "terms").toArrow()
        if not mine.num_rows:
            continue
        sets = mine.column("terms").combine_chunks()
        number = {t: i for i, t in enumerate(dict.fromkeys(sets.flatten().to_pylist()))}
        vectors = stages.settle(restricted(documents, number, id_col, text_col), "vectors")
        n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        df = np.zeros(len(number), np.int64)
        for term, count in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the block's terms
            df[term] = count
        by_frequency = np.argsort(-df, kind="stable")
        rank_of = np.empty(len(df), np.int64)
        rank_of[by_frequency] = np.arange(len(df))
        weight = np.array([term_weight(n_docs, int(x)) for x in df[by_frequency]], np.int64)
        size = np.diff(sets.offsets.to_numpy())
        best = _searched(
            vectors, rank_of, weight, mine.column("item_no").to_numpy(), np.concatenate(([0], np.cumsum(size))),
            rank_of[[number[t] for t in sets.flatten().to_pylist()]], n_docs, n_terms, k)
        found = best if found is None else found.unionByName(best)
    kind = items.schema[item_col].dataType.simpleString()
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    order = "order by score desc, doc_id asc nulls last"
    # Tasks hand on k rows each; a first cut in 64 parts an item keeps the last one small.
    few = found.selectExpr("*", f"row_number() over (partition by item_no, pmod(xxhash64(doc_id), 64) {order}) as place")
    few = few.filter(f"place <= {k}").drop("place")
    last = few.selectExpr("*", f"row_number() over (partition by item_no {order}) as rank").filter(f"rank <= {k}")
    return last.join(wanted.select("item_no", "item_id"), "item_no").select("item_id", "rank", "doc_id", "score")
