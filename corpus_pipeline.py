"""Corpus preparation: five stages, each a function of (spark, docs, sf_dir).

Each stage works on all rows that the one before kept and, but for the last, returns the
columns it was given. Defined results. Nulls in any column, empty texts, repeated rows, extra columns and empty tables pass through; a
document without text is rejected by the first stage like any text that scores too low.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spendlever.llm import decontaminate, near_dedup, pii, quality, sentence_pieces
from spendlever.llm.queries import QUALITY_FLOOR, QUALITY_METADATA, quality_machine, table, vocabulary
from spendlever.llm.stages import Stages, free_name


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at 0.7 or more."""
    machine = quality_machine(spark, docs, sf_dir)
    score = free_name(docs, "quality_score")
    return quality.scored(docs, machine, metadata=QUALITY_METADATA, name=score).filter(
        f"`{score}` >= {QUALITY_FLOOR}D").select(*[f"`{c}`" for c in docs.columns])


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Rows that share the id that stays: one of each distinct text stays.
    """
    kept = near_dedup.near_duplicates(docs).filter("kept").groupBy("doc_id").agg(F.count("*").alias("times"))
    alike = lambda ids: docs["doc_id"].eqNullSafe(ids["doc_id"])
    once, often = (kept.filter(f"times {x} 1") for x in ("=", ">"))
    single = docs.join(once, alike(once), "left_semi")
    several = docs.join(often, alike(often), "left_semi")
    order, copy = free_name(docs, "copy_no"), F.expr("row_number() over (partition by doc_id, text order by lang, source, n_chars)")
    return single.unionByName(several.withColumn(order, copy).filter(f"`{order}` = 1").drop(order))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by the name of its kind, and their new lengths."""
    length = F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")).alias("n_chars")
    return pii.masked(docs).select(*[length if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their piece ids, the number of ids, and whether decoding gives the text back."""
    model = vocabulary("piece_bpe_32k.model")
    decoded = free_name(docs, "decoded")
    both = sentence_pieces.encode_and_decode(docs, model, text_name=decoded)
    kept = [f"`{c}`" for c in both.columns if c.lower() not in ("n_pieces", "round_trip", decoded)]
    return both.selectExpr(*kept, "cast(size(piece_ids) as bigint) as n_pieces", f"`{decoded}` = coalesce(text, '') as round_trip")


STAGES = [
    ("quality classifier", good_quality),
    ("near-duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("personal data", without_personal_data),
    ("sentencepiece", encoded),
]
#: SQL expresses neither the classifier nor the merges; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the tables between them lie in the shared folder."""
    stages = Stages(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stages.settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
