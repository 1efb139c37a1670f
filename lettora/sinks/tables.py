"""Table writer."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lettora.operators.columns import quoted
from lettora.sources.shared import deleted


@dataclass(frozen=True)
class WriteMetrics:
    table: str
    row_count: int
    column_count: int
    checks: dict[str, int] = field(default_factory=dict)


def overwrite_table(
    df: DataFrame,
    name: str,
    merge_schema: bool = False,
    path: str | None = None,
    partition_by: list[str] | None = None,
    checks: dict[str, Column] | None = None,
) -> WriteMetrics:
    """Replace the table ``name``; with ``merge_schema`` its columns may change, and the new schema wins.

    Rows are counted while they are written, so the plan runs once. ``path`` makes it an external table. ``checks`` are
    aggregates over the rows written.

    In the session catalog the rows go to a staged table first, which takes the place of the old one when it is complete
    and holds as many rows as were written. If anything fails before, the old table stays as it is; if the swap itself
    fails, the old table is put back. So the plan may read the table it replaces. Other catalogs replace a table in one
    step of their own.
    """
    spark = df.sparkSession
    seen = Observation()
    extra = [check.alias(name) for name, check in (checks or {}).items()]
    writer = df.observe(seen, F.count(F.lit(1)).alias("row_count"), *extra).write.mode("overwrite")
    if merge_schema:
        writer = writer.option("mergeSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if _in_session_catalog(spark, name):
        mark = uuid.uuid4().hex[:12]
        staged, staged_path = _beside(name, f"staged_{mark}"), f"{path.rstrip('/')}__staged_{mark}" if path else None
        try:
            (writer.option("path", staged_path) if staged_path else writer).saveAsTable(staged)
            stored = spark.table(staged).count()
            if stored != seen.get["row_count"]:
                raise RuntimeError(f"{seen.get['row_count']} rows were written for {name}, but {stored} are stored")
            _swap(spark, staged, name, staged_path, path, mark)
        except BaseException:
            spark.sql(f"drop table if exists {staged}")
            if staged_path:
                deleted(spark, staged_path)
            raise
    else:
        (writer.option("path", path) if path else writer).saveAsTable(name)
    found = {name: seen.get[name] or 0 for name in checks or {}}
    return WriteMetrics(name, seen.get["row_count"], len(df.columns), found)


def _in_session_catalog(spark: SparkSession, name: str) -> bool:
    parts = name.split(".")
    return (parts[0].strip("`") if len(parts) > 2 else spark.catalog.currentCatalog()) == "spark_catalog"


def _beside(name: str, mark: str) -> str:
    return f"{name[:-1]}__{mark}`" if name.endswith("`") else f"{name}__{mark}"


def _swap(spark: SparkSession, staged: str, name: str, staged_path: str | None, path: str | None, mark: str) -> None:
    """Put ``staged`` in the place of ``name``, or leave both as they were."""
    retired = _beside(name, f"retired_{mark}")
    old_path = f"{path.rstrip('/')}__retired_{mark}" if path else None
    replaces = spark.catalog.tableExists(name)
    moved = False
    if replaces:
        _rename(spark, name, retired)
    try:
        if staged_path and path and old_path:
            moved = _move(spark, path, old_path)
            if not _move(spark, staged_path, path):
                raise RuntimeError(f"{staged_path} could not be moved to {path}")
            spark.sql(f"create table {name} like {staged} location '{path}'")
            if spark.catalog.listColumns(name) and any(column.isPartition for column in spark.catalog.listColumns(name)):
                spark.catalog.recoverPartitions(name)
            spark.sql(f"drop table {staged}")
        else:
            _rename(spark, staged, name)
    except BaseException:
        if moved and path and old_path:
            deleted(spark, path)
            _move(spark, old_path, path)
        spark.sql(f"drop table if exists {name}") if path else None
        if replaces:
            _rename(spark, retired, name)
        raise
    if replaces:
        spark.sql(f"drop table {retired}")
    if old_path and moved:
        deleted(spark, old_path)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"alter table {old} rename to {new}")
    if spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        _follow(spark, new)


def _follow(spark: SparkSession, name: str) -> None:
    """Tell the partitions of a renamed table where they are now; a metastore does so by itself."""
    about = {row.col_name: row.data_type for row in spark.sql(f"describe table extended {name}").collect()}
    if about.get("Type") != "MANAGED" or not any(column.isPartition for column in spark.catalog.listColumns(name)):
        return
    for row in spark.sql(f"show partitions {name}").collect():
        values = [part.split("=", 1) for part in row.partition.split("/")]
        spec = ", ".join(f"{quoted(unquote(column))} = {_literal(unquote(value))}" for column, value in values)
        spark.sql(f"alter table {name} partition ({spec}) set location {_literal(about['Location'] + '/' + row.partition)}")


def _literal(text: str) -> str:
    return "null" if text == "__HIVE_DEFAULT_PARTITION__" else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _move(spark: SparkSession, old: str, new: str) -> bool:
    files, at = _at(spark, old)
    return files.exists(at) and files.rename(at, _at(spark, new)[1])
