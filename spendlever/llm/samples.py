"""Bounded samples of labelled rows for fitting; everything else covers all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def labelled(labels: DataFrame, label_col: str, limit: int, keep: str = "true", id_col: str = "doc_id") -> DataFrame:
    """At most ``limit`` (doc_id, label) rows that pass ``keep``, the ones with the smallest hashed ids.

    A document labelled more than once counts as labelled by its largest label; rows without an
    id or a label are left out.
    """
    rows = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    return (
        rows.filter("doc_id is not null and label is not null").filter(keep)
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )


def texts(documents: DataFrame, sample: DataFrame, columns: list[str], id_col: str = "doc_id") -> DataFrame:
    """The sampled documents with their labels. The sample's size is bounded, so it is broadcast."""
    rows = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), *columns)
    return rows.join(F.broadcast(sample), "doc_id")
