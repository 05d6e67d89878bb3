"""Stage tables: cut a plan by writing it to the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or else the warehouse, which all executors reach as well."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir")


def stage_folder(spark: SparkSession) -> str:
    """Where this application keeps its stage tables."""
    return f"{shared_folder(spark)}/stages-{spark.sparkContext.applicationId}"


_scopes: list[str] = []


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Stage tables that are settled inside are deleted at the end, unless they were kept.

    A plan runs in one scope, so it leaves behind only what it returns.
    """
    path = f"{stage_folder(spark)}/scope-{uuid.uuid4().hex}"
    _scopes.append(path)
    try:
        yield
    finally:
        _scopes.remove(path)
        _delete(spark, path)


#: Least number of buckets of a stage table that is laid out by a key.
BUCKETS = 48


def buckets(spark: SparkSession) -> int:
    return max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def laid_out(df: DataFrame, by: str) -> DataFrame:
    """``df`` dealt out by ``by`` like a stage table that is bucketed by it."""
    return df.repartition(buckets(df.sparkSession), by)


def settle(df: DataFrame, keep: bool = False, by: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet stage table and return the table; ``keep`` lets it outlive the running plan.

    With ``by`` the table is bucketed by that column: grouping and joining by it need no shuffle.

    Readers see one fixed set of values however often the plan below is reused
    or retried, and the planner sees the table's real size, so a join against it
    is broadcast only when it is measured to be under the broadcast threshold.
    """
    spark = df.sparkSession
    folder = _scopes[-1] if _scopes and not keep else stage_folder(spark)
    path = f"{folder}/stage-{uuid.uuid4().hex}"
    if by is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    # Only a table of the catalog tells its buckets; its entry goes once it is resolved, the files stay.
    name = f"stage_{uuid.uuid4().hex}"
    laid_out(df, by).write.format("parquet").bucketBy(buckets(spark), by).option("path", path).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"drop table {name}")
    return table


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_stages(spark: SparkSession) -> None:
    """Delete every stage table of this application; results that still read one are lost."""
    _delete(spark, stage_folder(spark))
