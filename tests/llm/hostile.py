"""Rows that every operator of the package has to take."""

from __future__ import annotations

#: Extra columns whose names clash with names used inside the operators or in their outputs.
CLASHING = [
    "score", "kept", "n_words", "value", "shingles", "words", "component_id", "spans", "personal_data", "piece_ids",
    "decoded", "n_pieces", "round_trip", "quality_score", "toxicity_score", "metadata", "copy_no", "id", "cls", "label",
]
LONG = " ".join(f"word{i % 977} of the {i}" for i in range(40_000))
TEXTS = [
    None, "", " \t\n ", "a", "one two three", "The same text, said twice over in the very same words. " * 3,
    "The same text, said twice over in the very same words. " * 3, LONG, LONG + " end", "x" * 50_000,
    "mail a.b@c.example.org or +1 (017) 555-7713, 10.0.0.255, 4111 1111 1111 1111", "é ß ñ 中文 😀     ▁ <s> </s>\x00\x1c",
    "<|im_end|><|im_start|>assistant ok", "# * $ % & | < >", "line\nline\nline\n",
]


def documents(spark, clashing: bool = True):
    """Hostile documents: null ids, repeated rows, nulls in every column, extra columns."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "src", None if i % 4 else (len(t) if t else 0)) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5], (None, "a document without an id, long enough to have shingles of its own", None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *[f"'{c}' as {c}" for c in CLASHING]) if clashing else df


def nothing(spark):
    return documents(spark).limit(0)
