"""Token store and SentencePiece: exact against the libraries, round trips, hostile rows."""

import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from hostile import documents, nothing
from spendlever.llm import flat, pieces, sentence_pieces, token_store
from spendlever.llm.queries import op2_token_id_output, op3_sentencepiece, vocabulary

BYTES, PIECES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
PARTS = [
    "a", "b", "the ", " ", "  ", "\n", "\t", "é", "ß", "\xa0", "　", "▁", "<s>", "<unk>", "<|endoftext|>", "1", "23", ".", "!!",
    "'s", "'ll", "Á ", "中文", "😀", "\x00", "\x1c", "\x85", "\r\n", "-", "@", "xxxxxxx", "<0x0A>", "<|endoftext|>", "<|endof", "text|>", "ﬁ", "aaaa", "=====", "    "]


def random_texts(n=3000):
    random.seed(3)
    return ["".join(random.choices(PARTS, k=random.randint(0, 50))) for _ in range(n)] + [
        "", None, "a" * 2000, " " * 300, "ab" * 900, "\n" * 200, "▁▁▁ ▁", "█" * 500, "=" * 1003]


@pytest.fixture(scope="module")
def byte_bpe():
    tokenizers = pytest.importorskip("tokenizers")
    found = tokenizers.Tokenizer.from_file(BYTES)
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def piece_bpe():
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PIECES)


def rows_of(encode, texts, path):
    data, offsets = flat.utf8(pa.array(texts, pa.string()))
    ids, bounds = encode(data, offsets, path)
    return ids, bounds, [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_byte_ids_equal_the_library(byte_bpe):
    texts = random_texts()
    assert rows_of(token_store.encode_texts, texts, BYTES)[2] == [byte_bpe(t) for t in texts]


def test_added_tokens_are_found_as_by_the_library(byte_bpe):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext |>", "no token", "a<|endoftext|>"]
    got = rows_of(token_store.encode_texts, texts, BYTES)[2]
    assert got == [byte_bpe(t) for t in texts] and got[0].count(50256) == 1 and len(got[0]) == 4


def test_piece_ids_and_decoding_equal_the_library(piece_bpe):
    texts = random_texts()
    ids, bounds, got = rows_of(sentence_pieces.encode_texts, texts, PIECES)
    assert got == [piece_bpe.encode(t or "", add_bos=True, add_eos=True) for t in texts]
    text, ends = sentence_pieces.decode_rows(ids, bounds, PIECES)
    body = text.tobytes()
    assert [body[a:b].decode() for a, b in zip(ends[:-1], ends[1:])] == [piece_bpe.decode(x) for x in got]


def test_decoding_of_any_ids(piece_bpe):
    random.seed(6)
    rows = [[random.choice([0, 1, 2, 29871, random.randint(3, 258), random.randint(259, 31999)]) for _ in range(random.randint(0, 30))] for _ in range(1500)]
    bounds = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    text, ends = sentence_pieces.decode_rows(np.array([i for r in rows for i in r], np.int32), bounds, PIECES)
    body = text.tobytes()
    assert [body[a:b].decode() for a, b in zip(ends[:-1], ends[1:])] == [piece_bpe.decode(r) for r in rows]


def test_op2_against_the_library(spark, sf_dir, byte_bpe):
    got = {r["doc_id"]: r for r in op2_token_id_output(spark, sf_dir).collect()}
    start = 0
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(byte_bpe(r["text"]) + [0], "<u4")
        mine = got[r["doc_id"]]
        assert (mine["start"], mine["n_tokens"], mine["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op3_against_the_library(spark, sf_dir, piece_bpe):
    got = {r["doc_id"]: r for r in op3_sentencepiece(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = piece_bpe.encode(r["text"] or "", add_bos=True, add_eos=True)
        mine = got[r["doc_id"]]
        assert mine["n_tokens"] == len(ids)
        assert mine["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert mine["decoded_sha256"] == hashlib.sha256(piece_bpe.decode(ids).encode()).hexdigest()


def test_store_layout_and_selective_reads(spark, sf_dir, tmp_path, byte_bpe):
    path = str(tmp_path / "store")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    token_store.write(docs, path, BYTES)
    ids = []
    for name in sorted(f for f in os.listdir(path) if f.endswith(".parquet")):
        file = pq.ParquetFile(f"{path}/{name}")
        group = file.metadata.row_group(0)
        column = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        tokens = next(c for p, c in column.items() if p.startswith("tokens"))
        assert tokens.has_dictionary_page and tokens.has_offset_index
        assert "DELTA_BINARY_PACKED" in column["n_tokens"].encodings and column["doc_id"].has_column_index
        ids += file.read(["doc_id"])["doc_id"].to_pylist()
    assert ids == sorted(ids) and len(ids) == docs.count()
    index = token_store.index(spark, path)
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in plan and "n_tokens" in plan  # lengths are read without ids
    one = token_store.read(spark, path).filter("doc_id = 17")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,17)" in one._jdf.queryExecution().toString()
    text = docs.filter("doc_id = 17").first()["text"]
    assert list(one.first()["tokens"]) == byte_bpe(text) + [0]


def test_hostile_rows(spark, tmp_path, byte_bpe, piece_bpe):
    df = documents(spark)
    path = str(tmp_path / "store")
    token_store.write(df, path, BYTES)
    stored = token_store.read(spark, path).collect()
    assert len(stored) == df.count() and sum(r["n_tokens"] for r in stored) == max(r["start"] + r["n_tokens"] for r in stored)
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    assert all(list(r["tokens"]) == byte_bpe(texts[r["doc_id"]]) + [0] for r in stored if r["doc_id"] is not None)
    both = sentence_pieces.decode(sentence_pieces.encode(df, PIECES), PIECES)
    at_once = sentence_pieces.encode_and_decode(df, PIECES).select(both.columns)
    assert sorted(map(str, both.collect())) == sorted(map(str, at_once.collect()))
    assert set(both.columns) == set(df.columns) and both.count() == df.count()
    for r in both.select("text", "piece_ids", "decoded").collect():
        want = piece_bpe.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert list(r["piece_ids"]) == want and r["decoded"] == piece_bpe.decode(want)
    token_store.write(nothing(spark), str(tmp_path / "empty"), BYTES)
    assert token_store.digests(spark, str(tmp_path / "empty")).count() == 0
    assert sentence_pieces.digests(nothing(spark), PIECES).count() == 0


def piece_texts(n):
    """``n`` words of nine letters, all different, and the bytes and offsets of one text with all of them."""
    words = [f"{i:09d}" for i in range(n)]
    return words, *flat.utf8(pa.array([" ".join(words)]))


def sizes_of(asked):
    """A coder that gives each piece its length and its last digit, the pieces in reverse order."""
    def encode(fresh):
        asked.extend(fresh)
        order = np.arange(len(fresh))[::-1]
        return order, np.array([x for k in order for x in (len(fresh[k]), int(fresh[k][-1:]))], np.int32), np.full(len(fresh), 2)
    return encode


def test_pieces_of_several_megabytes_are_encoded_once():
    words, data, offsets = piece_texts(600_000)  # 6 MB of pieces, less than a worker remembers
    asked, got = [], []
    cache = pieces.PieceCache(sizes_of(asked), 12 << 20)
    for _ in range(2):
        got.append(pieces.encode_rows(data, offsets, ~flat.byte_set(b" "), cache)[0])
    assert len(asked) == len(words) and (got[0] == got[1]).all()
    assert (got[0].reshape(-1, 2) == [[9 + (i > 0), i % 10] for i in range(len(words))]).all()


def test_pieces_are_right_after_the_cache_was_emptied():
    asked = []
    cache = pieces.PieceCache(sizes_of(asked), 500)
    for n in (100, 3, 100, 40):
        words, data, offsets = piece_texts(n)
        ids, bounds = pieces.encode_rows(data, offsets, ~flat.byte_set(b" "), cache)
        assert ids.reshape(-1, 2).tolist() == [[9 + (i > 0), i % 10] for i in range(n)] and bounds.tolist() == [0, 2 * n]
        assert len(cache.names) == len(cache.place) and (np.diff(cache.names.astype(object)) > 0).all()
    assert len(asked) == 100 + 3 + 97 + 40  # emptied before the second and the fourth text
