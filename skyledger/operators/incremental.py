"""Incremental insert: the first row written for a key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.quality import SILVER_RULES, Rule, accept

SILVER_KEYS = ("city_id", "date")
REJECT_KEYS = ("city_id", "date", "quality_issue", "extraction_timestamp_utc")


def unseen(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing``.

    Rows that share a key within the batch all pass: only the target is consulted, by its keys
    alone. Spark broadcasts them or splits a hot key of the batch at run time. A NULL key is equal
    to none. Give a target that is filtered to the batch's range (``within``) where it has folders.
    """
    return batch.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def within(existing: DataFrame, batch: DataFrame, folder: str, column: str) -> DataFrame:
    """The rows of ``existing`` in the range of ``column`` in a written ``batch``.

    The range is read from the batch, and so is that of ``folder``, by which the target is
    partitioned: files of other folders are not opened, however long the history is.
    """
    ends = batch.agg(*(f(c).alias(f"{n}_{c}") for c in (folder, column) for n, f in (("lo", F.min), ("hi", F.max))))
    row = ends.first()
    if row[f"lo_{column}"] is None or row[f"lo_{folder}"] is None:
        return existing.filter(F.lit(False))
    for c in (folder, column):
        existing = existing.filter(F.col(c).between(F.lit(row[f"lo_{c}"]), F.lit(row[f"hi_{c}"])))
    return existing


#: Folders of a log. A batch reads those that its keys fall into.
BUCKETS = 32


def in_buckets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the log folder of their keys, ``bucket``; NULLs have a folder as well."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))


def of_buckets(log: DataFrame, rows: DataFrame) -> DataFrame:
    """The folders of ``log`` in which keys of the written ``rows`` can stand; others are not opened.

    Rows of a log without folders, or without one of theirs, are all read.
    """
    if "bucket" not in log.columns:
        return log
    touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())  # at most BUCKETS
    return log.filter(F.col("bucket").isin(*touched) | F.col("bucket").isNull())


def incremental_insert(
    batch: DataFrame,
    existing: DataFrame,
    keys: Sequence[str] = SILVER_KEYS,
    rules: Sequence[Rule] = SILVER_RULES,
) -> DataFrame:
    """Accepted rows of the batch that the target does not hold yet."""
    return unseen(accept(batch, rules), existing, keys)


def new_rejects(
    rejects: DataFrame, log: DataFrame, keys: Sequence[str] = REJECT_KEYS
) -> DataFrame:
    """Rejects that the log does not hold yet, so that a replayed batch adds nothing.

    A reject often lacks its city or date. Comparing the keys as one struct makes NULL equal NULL.
    """
    as_key = F.struct(*keys).alias("reject_key")
    return unseen(
        rejects.withColumn("reject_key", as_key), log.select(as_key), ["reject_key"]
    ).drop("reject_key")
