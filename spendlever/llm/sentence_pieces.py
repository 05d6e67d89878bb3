"""SentencePiece BPE by vectorised merge rounds, and its decoding.

A text gets one space in front, spaces become the piece mark, and pieces never hold a mark
after another character; so words are independent, and each distinct one is merged once per
task. All distinct words lie in one flat array of symbols. A round takes the best rank among
the neighbouring pairs of every word, merges the leftmost pair that has it (and the further
places of that same pair, unless a merge makes a pair that would have come first), and compacts the
array, until no word has a pair left. Characters without a piece become their UTF-8 bytes.

Ids and texts of a document are made and used inside one task; nothing is shuffled.

Defined results. Null text counts as empty: the begin and end ids alone, decoded to the empty
text. Rows are independent, so ties, repeated rows and clashing names don't matter; all input columns but the
named ones are left out by ``digests`` and kept by ``encode`` and ``decode``, where an input column of
the output's name is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from spendlever.llm import flat, pieces
from spendlever.llm.stages import without

MARK = "▁"
FAR = np.int32(2**31 - 1)
#: A cut is safe before a space, unless a space or a mark (whose last byte is 0x81) comes before it.
_VISIBLE = ~flat.byte_set(b" \x81")


class Model:
    """Tables of one model file: pieces, ranks, merges and surfaces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        source = SentencePieceProcessor(model_file=path)
        n = source.get_piece_size()
        name = [source.id_to_piece(i) for i in range(n)]
        byte = [source.is_byte(i) for i in range(n)]
        plain = [not (byte[i] or source.is_control(i) or source.is_unknown(i)) for i in range(n)]
        if any(source.is_unused(i) for i in range(n)) or any(MARK in p.lstrip(MARK) for p in name):
            raise ValueError("models with unused pieces or marks inside a piece are not supported")
        if sum(byte) != 256 or source.encode("  x　ﬁ ", out_type=str) and "".join(
            source.encode("  x　ﬁ ", out_type=str)
        ) != f"{MARK}{MARK}{MARK}x　<0xEF><0xAC><0x81>{MARK}".replace("<0xEF><0xAC><0x81>", "ﬁ" if "ﬁ" in name else "<0xEF><0xAC><0x81>"):
            raise ValueError("only models with byte fallback and without normalisation are supported")
        self.size, self.begin, self.end = n, source.bos_id(), source.eos_id()
        number = {p: i for i, p in enumerate(name) if plain[i]}
        spare = sorted({c for p in number for c in p} - set(number))  # characters seen only inside pieces
        number |= {c: n + 1 + k for k, c in enumerate(spare)}
        self.none = n  # any other character
        self.first = np.full(0x110000, self.none, np.int32)
        for p, i in number.items():
            if len(p) == 1:
                self.first[ord(p)] = i
        score = {i: source.get_score(i) for p, i in number.items() if i < n}
        order = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.radix = n + 1 + len(spare)
        merges = {}
        for p, i in number.items():
            for k in range(1, len(p)):
                left, right = number.get(p[:k]), number.get(p[k:])
                if left is not None and right is not None:
                    merges[left * self.radix + right] = (order[score[i]], i)
        self.pair = np.array(sorted(merges), np.int64)
        self.rank = np.array([merges[k][0] for k in self.pair.tolist()], np.int32)
        self.into = np.array([merges[k][1] for k in self.pair.tolist()], np.int32)
        self.byte_id = np.zeros(256, np.int32)
        surface = []
        for i, p in enumerate(name):
            if byte[i]:
                self.byte_id[int(p[3:5], 16)] = i
                surface.append(bytes([int(p[3:5], 16)]))
            elif source.is_control(i):
                surface.append(b"")
            else:
                surface.append((p.replace(MARK, " ") if plain[i] else " ⁇ ").encode())
        self.is_byte, self.is_control = np.array(byte), np.array([source.is_control(i) for i in range(n)])
        self.marked = np.array([plain[i] and p.startswith(MARK) for i, p in enumerate(name)])
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_size = np.array([len(s) for s in surface], np.int64)
        self.surface_start = np.concatenate(([0], np.cumsum(self.surface_size)[:-1]))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of neighbouring symbols; ``FAR`` where they don't merge."""
        key = left.astype(np.int64) * self.radix + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        known = self.pair[at] == key
        return np.where(known, self.rank[at], FAR), np.where(known, self.into[at], -1)


def _chosen(rank: np.ndarray, symbol: np.ndarray, heads: np.ndarray, size: np.ndarray, best: np.ndarray):
    """Places to merge in this round: each word's leftmost best pair, and that pair's other places."""
    wanted = rank == np.repeat(best, size)
    places = np.flatnonzero(wanted)
    word = np.searchsorted(heads, places, "right") - 1
    leading = places[np.searchsorted(word, np.arange(len(heads)))]
    same = (symbol[places] == symbol[leading][word]) & (symbol[places + 1] == symbol[leading + 1][word])
    places, word = places[same], word[same]
    run = np.ones(len(places), bool)  # neighbours overlap: of a run every other place is taken
    run[1:] = (places[1:] != places[:-1] + 1) | (word[1:] != word[:-1])
    start = np.flatnonzero(run)
    nth = np.arange(len(places)) - np.repeat(start, np.diff(np.append(start, len(places))))
    keep = nth % 2 == 0
    return places[keep], word[keep], leading


def _merged(model: Model, symbol, rank, into, place, last):
    """Symbols, ranks and merged pieces after merging at ``place``; ``fresh`` are the changed pairs."""
    symbol = symbol.copy()
    symbol[place] = into[place]
    keep = np.ones(len(symbol), bool)
    keep[place + 1] = False
    moved = np.cumsum(keep) - 1
    ends = last.copy()
    ends[place] |= last[place + 1]
    symbol, rank, into, ends = symbol[keep], rank[keep], into[keep], ends[keep]
    at = moved[place]
    fresh = np.unique(np.concatenate([at, at[at > 0] - 1]))
    inside = ~ends[fresh]
    rank[fresh], into[fresh] = FAR, -1
    fresh = fresh[inside]
    rank[fresh], into[fresh] = model.look_up(symbol[fresh], symbol[fresh + 1])
    return symbol, rank, into, ends, keep, fresh


def merge_words(model: Model, symbol: np.ndarray, size: np.ndarray, point: np.ndarray):
    """Merge all words at once. Returns the symbols left, the code points of those without a piece, and sizes."""
    n = len(size)
    out_symbol: list = [symbol[:0]]
    out_point: list = [point[:0]]
    out_word: list = [np.zeros(0, np.int64)]
    word = np.arange(n)[size > 0]
    size = size[size > 0]
    last = np.zeros(len(symbol), bool)
    last[np.cumsum(size) - 1] = True
    rank, into = np.full(len(symbol), FAR), np.full(len(symbol), -1, np.int32)
    open_ = np.flatnonzero(~last)
    rank[open_], into[open_] = model.look_up(symbol[open_], symbol[open_ + 1])
    while len(size):
        heads = np.cumsum(size) - size
        best = np.minimum.reduceat(rank, heads)
        over = best == FAR
        if over.any():
            gone = np.repeat(over, size)
            out_symbol.append(symbol[gone])
            out_point.append(point[gone])
            out_word.append(np.repeat(word[over], size[over]))
            stay = ~gone
            symbol, rank, into, last, point = symbol[stay], rank[stay], into[stay], last[stay], point[stay]
            word, size, best = word[~over], size[~over], best[~over]
            if not len(size):
                break
            heads = np.cumsum(size) - size
        place, owner, leading = _chosen(rank, symbol, heads, size, best)
        result = _merged(model, symbol, rank, into, place, last)
        many = np.bincount(owner, minlength=len(size)) > 1
        if many.any():
            # A new pair that ranks as high must come before the later places: such words take one merge.
            keep, fresh = result[4], result[5]
            home = np.searchsorted(heads, np.flatnonzero(keep)[fresh], "right") - 1
            hasty = np.zeros(len(size), bool)
            hasty[home[result[1][fresh] <= best[home]]] = True
            hasty &= many
            if hasty.any():
                stays = ~hasty[owner] | (place == leading[owner])
                place, owner = place[stays], owner[stays]
                result = _merged(model, symbol, rank, into, place, last)
        symbol, rank, into, last, keep, _ = result
        point = point[keep]
        size = size - np.bincount(owner, minlength=len(size))
    symbol, point, owner = np.concatenate(out_symbol), np.concatenate(out_point), np.concatenate(out_word)
    order = np.argsort(owner, kind="stable")
    return symbol[order], point[order], np.bincount(owner, minlength=n)


def encode_pieces(model: Model, fresh: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every word, one list after the other, and their sizes."""
    body = b"".join(fresh)
    raw = np.frombuffer(body, np.uint8)
    lead = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in fresh])))
    size = np.diff(lead[bounds])
    point = np.frombuffer(body.decode().encode("utf-32-le"), np.uint32).copy()
    point[point == 32] = ord(MARK)
    symbol, point, size = merge_words(model, model.first[point], size, point)
    spelled = symbol >= model.size
    if not spelled.any():
        return symbol, size
    text = point[spelled].astype("<u4").tobytes().decode("utf-32-le")
    spell = np.frombuffer(text.encode(), np.uint8)
    length = np.ones(len(symbol), np.int64)
    code = point[spelled]
    length[spelled] = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
    ids = np.repeat(symbol, length)
    ids[np.repeat(spelled, length)] = model.byte_id[spell]
    word = np.repeat(np.arange(len(size)), size)
    return ids, np.bincount(word, weights=length, minlength=len(size)).astype(np.int64)


_models: dict[str, tuple[Model, pieces.PieceCache]] = {}


def loaded(path: str) -> tuple[Model, pieces.PieceCache]:
    if path not in _models:
        model = Model(path)
        _models[path] = model, pieces.PieceCache(lambda fresh: (np.arange(len(fresh)), *encode_pieces(model, fresh)))
    return _models[path]


def encode_texts(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows with begin and end ids, and the n + 1 offsets of the rows in them."""
    model, cache = loaded(path)
    some = np.diff(offsets) > 0
    led = np.insert(data, offsets[:-1][some], 32)
    shifted = offsets + np.concatenate(([0], np.cumsum(some)))
    ids, bounds = pieces.encode_rows(led, shifted, _VISIBLE, cache)
    n = len(offsets) - 1
    ids = np.insert(ids, np.repeat(bounds, 2)[1:-1], np.tile([model.begin, model.end], n)) if n else ids
    return ids, bounds + 2 * np.arange(n + 1)


def decode_rows(ids: np.ndarray, bounds: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of every row of ids, and the n + 1 offsets. Bytes that are no UTF-8 become U+FFFD each."""
    model, _ = loaded(path)
    size = model.surface_size[ids]
    # The first piece that isn't a control id loses one leading mark.
    spoken = np.flatnonzero(~model.is_control[ids])
    first = np.searchsorted(spoken, bounds[:-1])
    lead = spoken[first[first < np.searchsorted(spoken, bounds[1:])]]
    begin = model.surface_start[ids]
    lead = lead[model.marked[ids[lead]]]
    begin[lead] += 1
    size[lead] -= 1
    ends = np.concatenate(([0], np.cumsum(size)))
    text, offsets = model.surface[flat.ranges(begin, size)], ends[bounds]
    spelled = model.is_byte[ids] & (model.surface[np.minimum(begin, len(model.surface) - 1)] > 0x7F)
    if spelled.any():
        rows = np.unique(np.searchsorted(bounds, np.flatnonzero(spelled), "right") - 1)
        bad = {}
        for row in rows.tolist():
            raw = text[offsets[row]:offsets[row + 1]].tobytes()
            inner = np.flatnonzero(model.is_control[ids[bounds[row]:bounds[row + 1]]]) + bounds[row]
            stops = np.unique(np.concatenate([[offsets[row]], ends[inner], [offsets[row + 1]]])) - offsets[row]
            try:
                if len(stops) > 2:  # control ids part the bytes on their two sides
                    bad[row] = b"".join(_each_byte(raw[a:b]) for a, b in zip(stops[:-1].tolist(), stops[1:].tolist()))
                raw.decode()
            except UnicodeDecodeError:
                bad.setdefault(row, _each_byte(raw))
        if bad:
            parts = [bad.get(r, text[offsets[r]:offsets[r + 1]].tobytes()) for r in range(len(bounds) - 1)]
            text = np.frombuffer(b"".join(parts), np.uint8)
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return text, offsets


def _each_byte(raw: bytes) -> bytes:
    """Valid characters as they are, every other byte as U+FFFD."""
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as error:
            out.append(raw[:error.start].decode() + "�")
            raw = raw[error.start + 1:]
    return "".join(out).encode()


def _text_array(text: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text.tobytes())).cast(pa.string())


def _mapped(df: DataFrame, source: str, made: dict[str, T.DataType], convert) -> DataFrame:
    """All columns of ``df`` and new ones, made from column ``source`` half a megabyte at a time."""
    df = without(df, *made)
    place = df.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, columns in convert(batch.column(place)):
                rows = batch.slice(start, len(columns[0]))
                yield pa.RecordBatch.from_arrays([*rows.columns, *columns], names=[*rows.schema.names, *made])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *[T.StructField(n, kind) for n, kind in made.items()]]))


_IDS = T.ArrayType(T.IntegerType())


def _encoded(column: pa.Array, model: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, offsets = flat.utf8(column)
    for a, b in flat.chunks(offsets, flat.SMALL_CHUNK_BYTES):
        yield a, *encode_texts(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], model)


def encode(df: DataFrame, model: str, text_col: str = "text", name: str = "piece_ids") -> DataFrame:
    """``df`` with the ids of ``text_col``, begin and end ids included."""
    def convert(column: pa.Array):
        for a, ids, bounds in _encoded(column, model):
            yield a, [flat.lists(ids, bounds, pa.int32())]

    return _mapped(df, text_col, {name: _IDS}, convert)


def decode(df: DataFrame, model: str, ids_col: str = "piece_ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids_col``; null ids give the empty text."""
    def convert(column: pa.Array):
        column = column.fill_null([]) if column.null_count else column
        bounds = column.offsets.to_numpy().astype(np.int64)
        ids = column.values.to_numpy(zero_copy_only=False)
        for a, b in flat.chunks(bounds, flat.SMALL_CHUNK_BYTES // 4):
            yield a, [_text_array(*decode_rows(ids[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], model))]

    return _mapped(df, ids_col, {name: T.StringType()}, convert)


def encode_and_decode(
    df: DataFrame, model: str, text_col: str = "text", ids_name: str = "piece_ids", text_name: str = "decoded"
) -> DataFrame:
    """``df`` with the ids of ``text_col`` and the text they decode to, in one pass."""
    def convert(column: pa.Array):
        for a, ids, bounds in _encoded(column, model):
            yield a, [flat.lists(ids, bounds, pa.int32()), _text_array(*decode_rows(ids, bounds, model))]

    return _mapped(df, text_col, {ids_name: _IDS, text_name: T.StringType()}, convert)


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda body, ends: [
            hashlib.sha256(body[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        for batch in batches:
            for a, ids, bounds in _encoded(batch.column(1), path):
                text, ends = decode_rows(ids, bounds, path)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, len(bounds) - 1), pa.array(np.diff(bounds), pa.int64()),
                    pa.array(sha(np.ascontiguousarray(ids.astype("<u4")), bounds)),
                    pa.array(sha(np.ascontiguousarray(text), ends)),
                ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def digests(documents: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded, and its ids decoded again."""
    return documents.select(F.col(id_col).cast("bigint"), text_col).mapInArrow(
        _digests(model), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
