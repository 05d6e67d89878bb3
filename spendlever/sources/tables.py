"""Readers and writers for catalog tables, files and external stores."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, types as T


def read_parquet(spark: SparkSession, folder: str, table: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{table}.parquet")


def read_catalog(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header row; without a schema every column is text."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_external(
    spark: SparkSession, fmt: str, options: Mapping[str, str], table: str | None = None
) -> DataFrame:
    """Any store with a Spark data source; credentials come from ``options``, never from code."""
    reader = spark.read.format(fmt).options(**options)
    if table is not None:
        reader = reader.option("dbtable", table)
    return reader.load()


def write_catalog(df: DataFrame, database: str, table: str, mode: str = "overwrite") -> None:
    """Replace (schema included) or extend a catalog table."""
    df.write.mode(mode).option("overwriteSchema", mode == "overwrite").saveAsTable(f"{database}.{table}")


def write_external(
    df: DataFrame, fmt: str, options: Mapping[str, str], table: str | None = None,
    mode: str = "overwrite",
) -> None:
    writer = df.write.format(fmt).options(**options).mode(mode)
    if table is not None:
        writer = writer.option("dbtable", table)
    writer.save()


def replace_catalog(df: DataFrame, database: str, table: str) -> None:
    """Overwrite a table that ``df`` itself reads: write a staging table, then swap names.

    The old table stays readable until the staging copy is complete, so a lost
    executor or a failed job leaves the published rows untouched.
    """
    spark = df.sparkSession
    staged, retired = f"{database}.{table}__staged", f"{database}.{table}__retired"
    df.write.mode("overwrite").saveAsTable(staged)
    spark.sql(f"DROP TABLE IF EXISTS {retired}")
    if spark.catalog.tableExists(f"{database}.{table}"):
        spark.sql(f"ALTER TABLE {database}.{table} RENAME TO {retired}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {database}.{table}")
    spark.sql(f"DROP TABLE IF EXISTS {retired}")


def replace_partitions(df: DataFrame, database: str, table: str, column: str, values: set) -> None:
    """Replace the named partitions of a catalog table by the rows of ``df``, and no other partition.

    ``df`` must not read the table lazily (settle it first). Partitions that get no rows are dropped.
    """
    spark, name, mode = df.sparkSession, f"{database}.{table}", "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    filled = {row[0] for row in df.select(column).distinct().collect()}  # one row per partition
    if not filled <= set(values):
        raise ValueError(f"rows outside the replaced partitions: {sorted(filled - set(values))}")
    spark.conf.set(mode, "dynamic")
    try:
        df.select(spark.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)
    for value in sorted(set(values) - filled):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column} = {value!r})")


def snapshot(df: DataFrame, database: str, table: str) -> DataFrame:
    """Keep a dated copy of an external view as a catalog table and return the copy."""
    write_catalog(df, database, table)
    return read_catalog(df.sparkSession, database, table)


class VersionedTable:
    """A published table whose partitions are replaced in versions behind a view.

    Rows lie in ``<table>__rows``, partitioned by version and by a column such as the year. The view
    ``<table>`` shows one version of each partition; which one is part of the view itself, so replacing the view
    switches any number of partitions at once. A lost job leaves partitions that no view shows.
    """

    def __init__(self, spark: SparkSession, database: str, table: str):
        self.spark, self.view, self.rows = spark, f"{database}.{table}", f"{database}.{table}__rows"

    def create(self, df: DataFrame, column: str) -> None:
        """Publish the first version."""
        df.selectExpr("*", "0 as version").write.partitionBy("version", column).saveAsTable(self.rows)
        values = [r[0] for r in df.select(column).distinct().collect()]  # one row per partition
        self._show(column, {v: 0 for v in values})

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.rows)
        return self.spark.table(self.view)

    def _versions(self) -> dict[int, int]:
        listed = self.spark.sql(f"SHOW TBLPROPERTIES {self.view} ('shown')").first()["value"]
        return {int(a): int(b) for a, b in (pair.split(":") for pair in listed.split(",") if pair)}

    def _show(self, column: str, versions: dict[int, int]) -> None:
        groups = {v: sorted(k for k, x in versions.items() if x == v) for v in sorted(set(versions.values()))}
        shown = " or ".join(f"(version = {v} and {column} in ({', '.join(map(str, ks))}))" for v, ks in groups.items()) or "false"
        listed = ",".join(f"{k}:{v}" for k, v in sorted(versions.items()))
        columns = ", ".join(f"`{c}`" for c in self.spark.table(self.rows).columns if c != "version")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view} TBLPROPERTIES ('shown' = '{listed}') AS SELECT {columns} FROM {self.rows} WHERE {shown}")

    def replace(self, df: DataFrame, column: str, values: set[int], accept: Callable[[DataFrame], bool], keep: int = 1) -> None:
        """Replace the partitions ``values`` by the rows of ``df`` once ``accept`` has approved what is read back.

        ``df`` is read several times, so settle it. Partitions that get no rows are no longer shown. The last
        ``keep`` versions that the new one replaces stay for readers that have begun.
        """
        filled = {r[0] for r in df.select(column).distinct().collect()}  # one row per partition
        if not filled <= set(values):
            raise ValueError(f"rows outside the replaced partitions: {sorted(filled - set(values))}")
        stored = {tuple(part.split("=")[1] for part in r[0].split("/")) for r in self.spark.sql(f"SHOW PARTITIONS {self.rows}").collect()}
        version = 1 + max((int(v) for v, _ in stored), default=-1)
        shape = self.spark.table(self.rows).columns
        df.selectExpr("*", f"{version} as version").select(*shape).write.mode("append").insertInto(self.rows)
        self.spark.catalog.refreshTable(self.rows)
        if not accept(self.spark.table(self.rows).filter(f"version = {version}").drop("version")):
            self._drop(column, {(str(version), str(v)) for v in filled})
            raise ValueError(f"{self.view}: version {version} does not match what was written")
        shown = {**{k: v for k, v in self._versions().items() if k not in values}, **{v: version for v in filled}}
        self._show(column, shown)
        live = {(str(v), str(k)) for k, v in shown.items()}
        self._drop(column, {(v, k) for v, k in stored if (v, k) not in live and int(v) < version - keep})

    def _drop(self, column: str, parts: set[tuple[str, str]]) -> None:
        for version, value in sorted(parts):
            self.spark.sql(f"ALTER TABLE {self.rows} DROP IF EXISTS PARTITION (version = {version}, {column} = {value})")
