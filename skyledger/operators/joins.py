"""Joins of a large table with a table of unique keys, without a size guess.

The key table is broadcast only when its row count is known to be small. Otherwise the join
shuffles, after the keys that own very many rows have been taken out: there are at most
``rows / hot_rows`` of those, so they can be broadcast whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import keep

BROADCAST_ROWS = 500_000
HOT_ROWS = 5_000_000


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    lookup_rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``rows`` with ``lookup``, which holds each ``on`` key at most once.

    ``how`` is inner, left, left_semi or left_anti. Pass ``lookup_rows`` when the size is proven
    already; otherwise the lookup is counted, so give a table or a kept result, not a long plan.
    """
    on = list(on)
    size = lookup.count() if lookup_rows is None else lookup_rows
    if size <= broadcast_rows:
        return rows.join(F.broadcast(lookup), on, how)
    return _split_join(rows, lookup, on, how, broadcast_rows, hot_rows)


def _split_join(
    rows: DataFrame, lookup: DataFrame, on: list[str], how: str, broadcast_rows: int, hot_rows: int
) -> DataFrame:
    """Shuffle join in which no key brings more than ``hot_rows`` rows to one task."""
    parts = []
    has_null = reduce(or_, [F.col(key).isNull() for key in on])
    if how in ("left_anti", "left"):
        # A NULL key matches nothing. Such rows skip the join, where they would share one task.
        columns = [*on, *[name for name in rows.columns if name not in on]]
        extra = [field for field in lookup.schema.fields if field.name not in on and how == "left"]
        empty = [F.lit(None).cast(field.dataType).alias(field.name) for field in extra]
        parts.append(rows.filter(has_null).select(*columns, *empty))
    rows = rows.filter(~has_null)

    hot = keep(rows.groupBy(*on).count().filter(F.col("count") > hot_rows).select(*on))
    hot_keys = hot.count()
    # Very many hot keys spread over the tasks by themselves; what is left Spark splits at run time.
    if hot_keys == 0 or hot_keys > broadcast_rows:
        parts.append(rows.join(lookup, on, how))
    else:
        hot = F.broadcast(hot)
        hot_lookup = lookup.join(hot, on, "left_semi")
        parts.append(rows.join(hot, on, "left_semi").join(F.broadcast(hot_lookup), on, how))
        parts.append(rows.join(hot, on, "left_anti").join(lookup, on, how))
    return reduce(DataFrame.unionByName, parts)
