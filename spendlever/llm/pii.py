"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Kinds. Fixed forms, always kept once their check passes: ``email``, ``ip`` (parts up to 255), ``card``
(16 to 19 digits, Luhn) and ``phone`` (8 to 15 digits after a plus). Scored forms, kept from
``ACCEPT`` on: ``iban`` (mod-97), ``national_id`` and ``secret`` (long hexadecimal strings); their
prior is raised by a passing checksum and by words such as "account" or "token" within
``WINDOW`` characters, and lowered by words such as "version" or "order".

Every search is linear in the text: a mail address is looked for around each ``@``, and
quantified runs are possessive or can't overlap. Work is row by row and local to a task.

Defined results. Null text counts as empty: no spans. Positions are code points. Rows are
independent, so repeated rows each get the same spans. Equal places of different kinds are all
reported; a mask covers the union. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from spendlever.llm.stages import without

KINDS = ["email", "ip", "card", "phone", "iban", "national_id", "secret"]
BASE = 4
ACCEPT = 0.6
WINDOW = 32

# Patterns of the four fixed forms, and context words of the scored ones.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![0-9A-Za-z])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])")
SCORED = {
    "iban": (0.3, 0.5, "iban account bank konto cuenta compte"),
    "national_id": (0.35, 0.0, "ssn social security insurance identity"),
    "secret": (0.4, 0.0, "token key secret password passwd api bearer"),
}
AGAINST = "version isbn order serial commit revision checksum"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    flat = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        after = at + 1
        if start < at and (found := _DOMAIN.match(text, after)):
            free = after = found.end()
            yield start, after
        at = text.find("@", after)


def _numbers(text: str) -> Iterator[tuple[str, int, int]]:
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                yield "phone", m.start(), m.end()


_near = {kind: re.compile(rf"\b(?:{'|'.join(words.split())})", re.I) for kind, (_, _, words) in SCORED.items()}
_against = re.compile(rf"\b(?:{'|'.join(AGAINST.split())})", re.I)


def _scored(text: str) -> Iterator[tuple[str, int, int, float]]:
    for kind, pattern, check in (("iban", _IBAN, mod97), ("national_id", _NATIONAL, None), ("secret", _SECRET, None)):
        prior, passed, _ = SCORED[kind]
        for m in pattern.finditer(text):
            score = prior
            if check is not None:
                if not check(m[0]):
                    continue
                score += passed
            around = text[max(0, m.start() - WINDOW):m.start()] + "\n" + text[m.end():m.end() + WINDOW]
            score += 0.3 * bool(_near[kind].search(around)) - 0.3 * bool(_against.search(around))
            if score >= ACCEPT:
                yield kind, m.start(), m.end(), min(score, 1.0)


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in the order of ``KINDS``, then of places."""
    if not text:
        return []
    found = [("email", a, b, 1.0) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [(kind, a, b, 1.0) for kind, a, b in _numbers(text)]
        found += _scored(text)
    order = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(found, key=lambda x: (order[x[0]], x[1]))


def mask(text: str | None, spans: list[tuple[str, int, int, float]]) -> str | None:
    """``text`` with the union of the spans replaced by the first kind's name in angle brackets."""
    if not spans:
        return text
    out, free = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if end <= free:
            continue
        if start >= free:
            out += [text[free:start], f"<{kind.upper()}>"]
        free = end
    return "".join(out) + text[free:]


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType()),
]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _per_text(df: DataFrame, schema: T.StructType, make: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(make(batch), names=schema.names)

    return df.mapInArrow(run, schema)


def personal_data(df: DataFrame, text_col: str = "text", name: str = "personal_data") -> DataFrame:
    """``df`` with an array of (kind, start, end, score); an input column of that name is replaced."""
    df = without(df, name)
    place = df.columns.index(text_col)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find(t.as_py())] for t in batch.column(place)]
        return [*batch.columns, pa.array(found, _ARROW_SPANS)]

    return _per_text(df, T.StructType([*df.schema.fields, T.StructField(name, SPANS)]), make)


def masked(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with every span replaced by its kind's name; other columns are kept as they are."""
    place = df.columns.index(text_col)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = [mask(t, find(t)) for t in batch.column(place).to_pylist()]
        return [pa.array(texts, pa.string()) if i == place else c for i, c in enumerate(batch.columns)]

    return _per_text(df, df.schema, make)


def _places(spans: list[tuple[str, int, int, float]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b, _ in spans)


def digests(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the fixed forms, a digest of their places, and the places of all spans."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:BASE]],
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
    ])

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [find(t) for t in batch.column(1).to_pylist()]
        base = [[s for s in spans if s[0] in KINDS[:BASE]] for spans in found]
        return [
            batch.column(0), *[pa.array([sum(s[0] == k for s in spans) for spans in base], pa.int64()) for k in KINDS[:BASE]],
            pa.array([hashlib.sha256(_places(spans).encode()).hexdigest() for spans in base]),
            pa.array([_places(spans) for spans in found]),
        ]

    return _per_text(documents.select(F.col(id_col).cast("bigint"), text_col), schema, make)
