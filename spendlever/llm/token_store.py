"""Token ids as Parquet list columns: ordered, with an index, selectively readable.

``write`` deals the texts out by ranges of doc_id, encodes each range where it is sorted, and
writes one file per range. Ids are a list column with a dictionary (a page of a corpus uses few
of the 50,000 ids); lengths and offsets are delta-encoded (writer version 2). Row groups and
pages have fixed sizes and the footer holds a page index, so one document's ids are found by
reading a few pages, and lengths are read without touching ids. ``index`` gives the place of
every document in the whole stream: the running offset inside a file is stored, and the sum of
the files before it comes from a table with one row per file.

Only texts are shuffled, never ids: 4 bytes of text make about 1.6 ids.

Defined results. Null text counts as empty and gives the end id alone. A document without an id
sorts first. Rows that share an id are ordered by their text's hash, then by the text. Extra columns are left out.
An empty table gives a store without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendlever.llm import flat, pieces
from spendlever.llm.stages import Stages

STORE = "file_no int, doc_id bigint, start_in_file bigint, n_tokens bigint, tokens array<int>"
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 1 << 18
CACHE_BYTES = 12 << 20
#: White space outside ASCII, where the cut before a space would not be safe.
WIDE_SPACES = [chr(c) for c in (0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                                0x202F, 0x205F, 0x3000)]

_caches: dict[str, pieces.PieceCache] = {}
_VISIBLE = ~flat.byte_set(flat.WORD_BREAKS)
_LETTER = flat.byte_set(bytes(range(65, 91)) + bytes(range(97, 123)))
_OTHER = flat.byte_set(bytes(range(33, 127))) & ~_LETTER


def _always_cut(data: np.ndarray) -> np.ndarray:
    """Places where the pattern of byte-level tokenizers ends a word whatever surrounds it.

    Between an ASCII letter and a mark or digit, before white space after a visible byte, and after a
    single line feed between visible bytes.
    """
    begins = np.zeros(len(data), bool)
    seen = _VISIBLE[data]
    begins[1:] = (_LETTER[data[:-1]] & _OTHER[data[1:]]) | (seen[:-1] & ~seen[1:])
    begins[2:] |= seen[:-2] & (data[1:-1] == 10) & seen[2:]
    return begins


def _cache(path: str) -> pieces.PieceCache:
    """The worker's tokenizer and the ids of pieces it has seen."""
    if path not in _caches:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        line = tokenizer.encode("\n", add_special_tokens=False).ids

        def encode(fresh: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Plain pieces, visible characters after a space or none, go in one text with a line between them."""
            texts = [p.decode() for p in fresh]
            is_plain = np.array([t.rfind(" ") <= 0 and t != " " and t.isprintable() for t in texts], bool)
            plain, rest = list(compress(texts, is_plain)), list(compress(texts, ~is_plain))
            parts = [np.array(got.ids, np.int32) for got in tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            if plain:
                ids = np.array(tokenizer.encode_batch_fast(["\n".join(plain)], add_special_tokens=False)[0].ids, np.int32)
                between = ids == line[0]
                ends = np.append(np.flatnonzero(between) - np.arange(len(plain) - 1), len(ids) - len(plain) + 1)
                parts.insert(0, ids[~between])
                sizes = np.diff(ends, prepend=0)
            else:
                sizes = np.zeros(0, np.int64)
            sizes = np.concatenate([sizes, [len(x) for x in parts[bool(plain):]]]).astype(np.int64)
            return np.argsort(~is_plain, kind="stable"), np.concatenate(parts), sizes

        _caches[path] = pieces.PieceCache(encode, CACHE_BYTES)
        _caches[path].marks = [*WIDE_SPACES, *(t.content for t in tokenizer.get_added_tokens_decoder().values())]
        _caches[path].whole = lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
    return _caches[path]


def _odd_rows(data: np.ndarray, offsets: np.ndarray, marks: list[str]) -> np.ndarray:
    """Rows that hold one of the marks: white space outside the six ASCII characters, or an added token."""
    found: list[int] = []
    body = data.tobytes()
    for mark in marks:
        at = body.find(raw := mark.encode())
        while at >= 0:
            row = int(np.searchsorted(offsets, at, "right")) - 1
            found.append(row)
            at = body.find(raw, int(offsets[row + 1]))
    return np.unique(np.array(found, np.int64))


def encode_texts(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows, exactly as the tokenizer gives them for each whole text.

    Added tokens are found in a text as the library finds them by default.
    """
    cache = _cache(path)
    ids, bounds = pieces.encode_rows(data, offsets, _VISIBLE, cache, _always_cut)
    if len(odd := _odd_rows(data, offsets, cache.marks)):
        rows = np.split(ids, bounds[1:-1])
        for row in odd.tolist():
            rows[row] = cache.whole(data[offsets[row]:offsets[row + 1]].tobytes().decode())
        ids, bounds = np.concatenate(rows), np.concatenate(([0], np.cumsum([len(x) for x in rows])))
    return ids, bounds


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema([("file_no", pa.int32()), ("doc_id", pa.int64()), ("start_in_file", pa.int64()),
                            ("n_tokens", pa.int64()), ("tokens", pa.list_(pa.int32()))])
        file_no, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = flat.utf8(batch.column(1))
            for a, b in flat.chunks(offsets):
                ids, bounds = encode_texts(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], path)
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
                size = np.diff(bounds)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(b - a, file_no, np.int32)), batch.column(0).slice(a, b - a),
                    pa.array(done + bounds[:-1], pa.int64()), pa.array(size, pa.int64()),
                    flat.lists(ids, bounds, pa.int32()),
                ], schema=schema)
                done += int(bounds[-1])
    return run


def write(documents: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
          end_id: int = 0) -> None:
    """Encode every text, append ``end_id``, and write the store in ascending id order."""
    texts = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    (
        texts.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
        .mapInArrow(_encode(tokenizer, end_id), STORE).write
        .option("parquet.writer.version", "v2").option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES).option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#tokens.list.element", "true").option("compression", "zstd")
        .parquet(path)
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its number and the ids in all files before it. Reads lengths only."""
    size = spark.read.schema("file_no int, n_tokens bigint").parquet(path).groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    return size.selectExpr("file_no", "coalesce(sum(n) over (order by file_no rows between unbounded preceding and 1 preceding), 0L) as base")


def index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens): where each document lies in the stream of all ids."""
    rows = spark.read.schema("file_no int, doc_id bigint, start_in_file bigint, n_tokens bigint").parquet(path)
    return rows.join(_files(spark, path), "file_no").selectExpr("doc_id", "base + start_in_file as start", "n_tokens")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, tokens); a filter on doc_id reaches the page index."""
    rows = spark.read.schema(STORE).parquet(path)
    return rows.join(_files(spark, path), "file_no").selectExpr(
        "doc_id", "base + start_in_file as start", "n_tokens", "tokens")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(2)
        ids = column.values.to_numpy(zero_copy_only=False).astype("<u4")
        bounds = column.offsets.to_numpy()
        crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())],
            names=["file_no", "place", "n_tokens", "ids_crc32"])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, counted on the ids read back."""
    rows = spark.read.schema(STORE).parquet(path)
    got = rows.selectExpr("file_no", "struct(doc_id, start_in_file) as place", "tokens").mapInArrow(
        _digest, "file_no int, place struct<doc_id: bigint, start_in_file: bigint>, n_tokens bigint, ids_crc32 bigint")
    return got.join(_files(spark, path), "file_no").selectExpr(
        "place.doc_id as doc_id", "base + place.start_in_file as start", "n_tokens", "ids_crc32")


def written(documents: DataFrame, tokenizer: str, **how) -> str:
    """Write a store to the cluster's shared folder and return its path."""
    path = Stages(documents.sparkSession, "token-store").path("ids")
    write(documents, path, tokenizer, **how)
    return path
