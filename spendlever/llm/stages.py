"""Stage tables of a query in the cluster's shared folder, and components of a distributed graph."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from spendlever.functions.lineage import stage_folder


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without its own columns of these names, whatever their case."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has it already."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


#: Whether Spark deletes a plan's shuffle files when the plan has run.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stages:
    """Tables written once and read many times; ``drop`` frees those that no later plan reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.kept: dict[int, str] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def settle(self, df: DataFrame, name: str, free: bool = False) -> DataFrame:
        """Write ``df`` and return the table; with ``free`` the shuffle files go when it is written, not with the driver's next collection."""
        path, before = self.path(name), self.spark.conf.get(FREE)
        if free:
            self.spark.conf.set(FREE, "true")
        try:
            df.write.parquet(path)
        finally:
            if free:
                self.spark.conf.set(FREE, before)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.kept[id(table)] = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.kept.pop(id(table)))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _stars(stages: Stages, links: DataFrame, name: str) -> DataFrame:
    """One large-star and one small-star pass over links (a > b), settled.

    Least neighbours are partial aggregates, settled before the links meet them: the join of a node with very many
    links is then one of two plain tables, which is broadcast where the nodes are few, and whose large
    partitions Spark splits where they are not.
    """
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stages.settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), name)
    large = stages.settle(
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), name)
    small = stages.settle(large.groupBy("a").agg(F.min("b").alias("m")), name)
    moved = large.join(small, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    done = stages.settle(small.select("a", F.col("m").alias("b")).union(moved).distinct(), name)
    stages.drop(least, large, small)
    return done


def components(stages: Stages, links: DataFrame, name: str = "component") -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its smallest node.

    Large-star and small-star passes alternate until the links stop changing, which takes a
    number of rounds logarithmic in the graph's size. A node with very many links is no burden to one task.
    """
    now = stages.settle(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), name
    )
    mark = None
    while True:
        after = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if after[0] == 0 or after == mark:
            break
        mark, last = after, now
        now = _stars(stages, now, name)
        stages.drop(last)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
