"""Catalog tables: create if missing, append, replace, and a table shared by two writes."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import shared_dir
from skyledger.sources.schemas import ddl


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def ensure_table(
    spark: SparkSession, name: str, columns: dict[str, str], partition_by: tuple[str, ...] = ()
) -> None:
    """Create a parquet table unless it exists."""
    clause = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(columns)}) USING parquet{clause}")


def ensure_bucketed(
    spark: SparkSession, name: str, columns: dict[str, str], keys: tuple[str, ...], buckets: int, path: str | None = None
) -> None:
    """Create a parquet table dealt into buckets by ``keys`` unless it exists.

    A join or aggregate on just these keys reads it without a shuffle. ``path`` is its folder, if it
    is not to lie in the warehouse.
    """
    by = f"CLUSTERED BY ({', '.join(keys)}) INTO {buckets} BUCKETS"
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(columns)}) USING parquet {by}{place}")


def append_bucketed(rows: DataFrame, name: str, keys: tuple[str, ...], buckets: int) -> None:
    """Insert into a bucketed table, one file for each bucket that has rows."""
    columns = rows.sparkSession.table(name).columns
    rows.select(*columns).repartition(buckets, *keys).write.insertInto(name)


def append(rows: DataFrame, name: str, rebalance_by: tuple[str, ...] | None = None) -> None:
    """Insert by column name.

    ``rebalance_by`` packs rows into few files per partition folder, and splits a folder that is
    too large for one task; empty, it packs the rows of all tasks.
    """
    if rebalance_by is not None:
        rows = rows.hint("rebalance", *rebalance_by)
    columns = rows.sparkSession.table(name).columns
    if "batch_id" in columns and "batch_id" not in rows.columns:  # of no batch
        rows = rows.withColumn("batch_id", F.lit(None).cast("string"))
    rows.select(*columns).write.insertInto(name)


def replace(
    rows: DataFrame,
    name: str,
    sort_by: tuple[str, ...] = (),
    partition_by: tuple[str, ...] = (),
    *,
    gate: Callable[[], None] | None = None,
) -> None:
    """Create or replace a table in one step, whatever happens on the way.

    ``name`` is a view of the newest version. A build goes to a version of its own, which nobody
    reads; then the view is switched, which the catalog does in one step; then versions older than
    the one before are dropped, as a running reader may still need that one. A crash before the
    switch leaves the old rows, one after it the new rows; what it left lying is dropped by the
    next run that comes through. ``sort_by`` orders rows within each file, so that readers can
    skip row groups; ``partition_by`` names folders. ``gate`` runs when
    the version is written; if it raises, the version is dropped and the view stays.
    """
    spark = rows.sparkSession
    version = f"{name}__v{time.time_ns()}"
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    writer = rows.write.format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(version)
    if gate is not None:
        try:
            gate()
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS {version}")
            raise
    previous = current_version(spark, name)
    _adopt(spark, name)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    keep = {version, previous}
    for old in versions(spark, name):
        if old not in keep:
            spark.sql(f"DROP TABLE IF EXISTS {old}")


def in_ranges(rows: DataFrame, partition_by: tuple[str, ...], sort_by: tuple[str, ...]) -> DataFrame:
    """``rows`` dealt out so that the files of a folder are disjoint ranges of ``sort_by``.

    Rows that tie are told apart by a hash of all columns, so a day with very many rows fills several
    files instead of one task; their ranges are disjoint in that hash.
    """
    keys = [F.col(c) for c in (*partition_by, *sort_by)]
    return rows.repartitionByRange(*keys, F.xxhash64(*rows.columns))


def versions(spark: SparkSession, name: str) -> list[str]:
    """Versions of a replaced table that exist, oldest first."""
    database, _, table = name.rpartition(".")
    found = [t.name for t in spark.catalog.listTables(database or None)]
    numbers = sorted(int(t.removeprefix(f"{table.lower()}__v")) for t in found if t.startswith(f"{table.lower()}__v"))
    return [f"{name}__v{n}" for n in numbers]


def current_version(spark: SparkSession, name: str) -> str | None:
    """The version that the view shows; None if there is no view yet."""
    if not spark.catalog.tableExists(name):
        return None
    shown = [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "View Text"]
    return shown[0].split(" FROM ")[-1].strip() if shown else None


def _adopt(spark: SparkSession, name: str) -> None:
    """A plain table of this name, as earlier releases made them, becomes the oldest version."""
    if spark.catalog.tableExists(name) and current_version(spark, name) is None:
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__v0")


@contextmanager
def written_once(rows: DataFrame) -> Iterator[DataFrame]:
    """``rows`` computed once into a table in the shared folder, dropped on exit.

    Two writes that read it see the same rows, and a lost executor does not repeat the parse.
    """
    spark = rows.sparkSession
    database = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_dir(spark).rstrip('/')}/{database}'")
    try:
        rows.write.format("parquet").saveAsTable(f"{database}.rows")
        yield spark.table(f"{database}.rows")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
