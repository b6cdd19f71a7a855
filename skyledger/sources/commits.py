"""Several appends as one batch, which is there as a whole or not at all.

The rows of a batch are written to pending tables first. Then a row in the table of batches says that
the batch is ready; that row is the commit. Only then are the pending rows appended to their tables,
and a last row says that this is done. A run that stops before the commit leaves nothing but pending
tables, which the next run drops; one that stops after it leaves a ready batch, which the next run
finishes. Every appended row carries the id of its batch, by which the next run sees what has been
appended already and readers leave out a batch that is not done. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.tables import append, ensure_table

BATCH_ID = "batch_id"
BATCH_COLUMNS = {"batch_id": "string", "state": "string", "targets": "string", "at": "timestamp"}
READY, DONE = "ready", "done"


def ensure_batched(
    spark: SparkSession, name: str, columns: dict[str, str], partition_by: tuple[str, ...] = ()
) -> None:
    """Create a table that batches append to; one without the id of the batch gets the column."""
    if not spark.catalog.tableExists(name):
        ensure_table(spark, name, {**columns, BATCH_ID: "string"}, partition_by)
    elif BATCH_ID not in spark.table(name).columns:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({BATCH_ID} string)")


def open_batches(spark: SparkSession, ledger: str) -> dict[str, list[str]]:
    """Committed batches that are not done, with their targets. All but the last are done."""
    if not spark.catalog.tableExists(ledger):
        return {}
    states = spark.table(ledger).groupBy("batch_id").agg(
        F.collect_set("state").alias("states"), F.max("targets").alias("targets")
    )
    waiting = states.filter(~F.array_contains("states", DONE)).collect()
    return {r["batch_id"]: r["targets"].split(",") for r in waiting}


def committed(spark: SparkSession, name: str, ledger: str) -> DataFrame:
    """The rows of a table without those of a batch that is still being appended."""
    rows = spark.table(name)
    waiting = list(open_batches(spark, ledger))
    if not waiting or BATCH_ID not in rows.columns:
        return rows
    return rows.filter(F.col(BATCH_ID).isNull() | ~F.col(BATCH_ID).isin(*waiting))


def recover(spark: SparkSession, ledger: str) -> None:
    """Finish a batch that was committed, drop what an uncommitted one left."""
    waiting = open_batches(spark, ledger)
    for batch_id, targets in waiting.items():
        _apply(spark, ledger, batch_id, targets)
    database = ledger.rpartition(".")[0]
    for table in spark.catalog.listTables(database):
        if table.name.startswith("pending_"):
            spark.sql(f"DROP TABLE IF EXISTS {database}.{table.name}")


def _pending(ledger: str, batch_id: str, number: int) -> str:
    return f"{ledger.rpartition('.')[0]}.pending_{batch_id}_{number}"


def _apply(spark: SparkSession, ledger: str, batch_id: str, targets: list[str]) -> None:
    for number, entry in enumerate(targets):
        target, _, folders = entry.partition(":")
        pending = _pending(ledger, batch_id, number)
        if not spark.catalog.tableExists(pending):
            continue  # dropped after it was appended
        spark.catalog.refreshTable(target)
        if spark.table(target).filter(F.col(BATCH_ID) == batch_id).isEmpty():
            append(spark.table(pending), target, rebalance_by=tuple(filter(None, folders.split("+"))))
    _mark(spark, ledger, batch_id, DONE, targets)
    for number in range(len(targets)):
        spark.sql(f"DROP TABLE IF EXISTS {_pending(ledger, batch_id, number)}")


def _mark(spark: SparkSession, ledger: str, batch_id: str, state: str, targets: list[str]) -> None:
    row = spark.range(1).select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(state).alias("state"),
        F.lit(",".join(targets)).alias("targets"),
        F.current_timestamp().alias("at"),
    )
    append(row, ledger)


class Batch:
    """What one run appends. Leaving its ``with`` block commits; an exception there discards it."""

    def __init__(self, spark: SparkSession, ledger: str) -> None:
        ensure_table(spark, ledger, BATCH_COLUMNS)
        recover(spark, ledger)
        self.spark, self.ledger = spark, ledger
        self.batch_id = uuid.uuid4().hex
        self.targets: list[str] = []

    def add(self, rows: DataFrame, target: str, rebalance_by: tuple[str, ...] = ()) -> DataFrame:
        """Compute ``rows`` once, to be appended to ``target``; returns them from the pending table.

        A target is added once. ``rebalance_by`` names its folder columns.
        """
        pending = _pending(self.ledger, self.batch_id, len(self.targets))
        columns = [c for c in self.spark.table(target).columns if c != BATCH_ID]
        marked = rows.select(*columns, F.lit(self.batch_id).alias(BATCH_ID))
        marked.write.format("parquet").saveAsTable(pending)
        self.targets.append(f"{target}:{'+'.join(rebalance_by)}")
        return self.spark.table(pending).select(*columns)

    def visible(self, name: str) -> DataFrame:
        """The committed rows of a table and those that this batch adds to it."""
        rows = committed(self.spark, name, self.ledger).drop(BATCH_ID)
        for number, entry in enumerate(self.targets):
            if entry.partition(":")[0] == name:
                rows = rows.unionByName(self.spark.table(_pending(self.ledger, self.batch_id, number)).drop(BATCH_ID))
        return rows

    def commit(self) -> None:
        if self.targets:
            _mark(self.spark, self.ledger, self.batch_id, READY, self.targets)
            _apply(self.spark, self.ledger, self.batch_id, self.targets)

    def discard(self) -> None:
        for number in range(len(self.targets)):
            self.spark.sql(f"DROP TABLE IF EXISTS {_pending(self.ledger, self.batch_id, number)}")

    def __enter__(self) -> Batch:
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        if kind is None:
            self.commit()
        else:
            self.discard()
