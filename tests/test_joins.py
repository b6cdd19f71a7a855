from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger.operators.joins import lookup_join
from support import plan_of


@pytest.fixture(scope="module")
def rows(spark):
    # Key 0 holds a third of all rows and NULL a sixth.
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 50)
    return spark.range(3000).select(F.col("id").alias("row"), key.cast("bigint").alias("k"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [10, 500, 100_000])
def test_split_join_equals_plain_join(rows, lookup, how, hot_rows):
    want = rows.join(lookup, ["k"], how)
    got = lookup_join(rows, lookup, ["k"], how, broadcast_rows=39, hot_rows=hot_rows) if hot_rows > 10 else lookup_join(
        rows, lookup, ["k"], how, lookup_rows=1000, broadcast_rows=60, hot_rows=hot_rows
    )
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_small_lookup_is_broadcast_without_shuffle(rows, lookup):
    plan = plan_of(lookup_join(rows, lookup, ["k"]))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_large_lookup_is_not_hinted(spark, rows, lookup):
    joined = lookup_join(rows, lookup, ["k"], broadcast_rows=10)
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_too_many_hot_keys_fall_back_to_the_plain_join(rows, lookup, how):
    got = lookup_join(rows, lookup, ["k"], how, broadcast_rows=5, hot_rows=1)
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(lookup, ["k"], how).collect()))
