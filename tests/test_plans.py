"""The plans that large inputs depend on."""

from __future__ import annotations

import re

import pytest

from pyspark.sql import functions as F

from skyledger.functions.jsontext import evaluated
from skyledger.operators.climate import climate_monthly
from skyledger.operators.daily import parse_daily, typed_daily
from skyledger.operators.envelope import _first_by_path
from skyledger.operators.events import extreme_events
from skyledger.operators.quality import accept, quarantine
from skyledger.operators.risk import daily_risk
from skyledger.operators.incremental import unseen
from skyledger.plans import fixture, workload
from skyledger.sources.dimensions import CITIES, cities_dim
from skyledger.sources.tables import append_bucketed, ensure_bucketed
from support import plan_of


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans") / "clean")
    accept(fixture.typed_observations(spark, "/root/testdata/sf0.001")).write.parquet(folder)
    return spark.read.parquet(folder)


def tree(plan: str) -> str:
    """The operator tree, without the details below it."""
    return plan.split("\n\n\n")[0]


def scans(plan: str) -> int:
    return tree(plan).count("Scan parquet")


def shuffles(plan: str) -> int:
    return len(re.findall(r"[- ]Exchange", tree(plan)))


def test_accept_is_pushed_to_the_scan(clean):
    plan = plan_of(accept(clean).select("city_id", "precipitation_sum"))
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(precipitation_sum,0.0)" in pushed
    assert "station_id" not in plan and "season" not in plan
    assert shuffles(plan) == 0


def test_quarantine_is_one_scan_without_shuffle(clean):
    plan = plan_of(quarantine(clean))
    assert scans(plan) == 1 and shuffles(plan) == 0


def test_all_detectors_share_one_scan_without_shuffle(clean):
    plan = plan_of(extreme_events(clean))
    assert scans(plan) == 1 and shuffles(plan) == 0
    assert "Or(" in plan[plan.index("PushedFilters") :]


def test_risk_moves_only_partial_aggregates(spark, clean):
    plan = plan_of(daily_risk(clean, cities_dim(spark), dim_rows=len(CITIES)))
    assert shuffles(plan) == 1
    assert "partial_avg" in plan and "partial_stddev_pop" in plan
    assert tree(plan).count("BroadcastHashJoin") == 3
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_climate_aggregates_before_the_calendar(spark, clean):
    plan = plan_of(climate_monthly(clean, cities_dim(spark)))
    assert "partial_avg" in plan
    assert scans(plan) == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_payloads_are_parsed_once_and_never_shuffled(spark):
    raw = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr(
        "text AS payload", "current_timestamp() AS extraction_timestamp_utc"
    )
    plan = plan_of(typed_daily(parse_daily(raw)))
    assert plan.count("from_json") == 1 and shuffles(plan) == 0


def parses(df) -> int:
    """Parse expressions of any kind in the optimised plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(r"(?i)from_json|parse_?json|get_json_object", plan))


@pytest.mark.parametrize("key", ["raw_stage", "parse_daily", "typed_daily", "raw_dedup", "envelope_rejects"])
def test_few_parses_however_the_result_is_filtered(spark, key):
    """A document's parse and the rare second look: at a count that is no integer, at types."""
    made = workload.QUERIES[key](spark, "/root/testdata/sf0.001")
    fixture_parses = 2 if key == "envelope_rejects" else 0
    assert parses(made) <= 2 + fixture_parses
    assert parses(made.filter(f"{made.columns[0]} IS NOT NULL")) <= 2 + fixture_parses


def test_a_filter_does_not_reach_an_evaluated_column(spark):
    rows = evaluated(spark.range(3), parsed=F.from_json(F.col("id").cast("string"), "a int"))
    rows = rows.select("id", F.col("parsed.a").alias("a"), F.col("parsed").isNull().alias("b"))
    assert parses(rows.filter("a IS NULL AND NOT b").filter("a IS NOT NULL OR b")) == 1


def test_copies_are_ranked_before_the_shuffle(spark):
    documents = spark.range(10).selectExpr(
        "'a' AS city_id", "'b' AS source_type", "current_date() AS extraction_date", "string(id) AS gcs_uri",
        "'s' AS payload_sha256",
    )
    plan = tree(plan_of(_first_by_path(documents.union(documents))))
    assert re.search(r"WindowGroupLimit[\s\S]*Exchange[\s\S]*WindowGroupLimit", plan)


def test_a_bucketed_history_is_not_shuffled(spark):
    """Two appends, so that buckets have several files; the batch alone has an exchange."""
    keys = ("city_id", "date")
    rows = spark.range(900).selectExpr("concat('c', id % 9) AS city_id", "date_add(date'2020-01-01', CAST(id / 9 AS INT)) AS date")
    name = "bucketed_history"
    ensure_bucketed(spark, name, {"city_id": "string", "date": "date"}, keys, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for part in (0, 1):
            append_bucketed(rows.filter(f"day(date) % 3 = {part}"), name, keys, 4)
        new = unseen(rows, spark.table(name), keys)
        plan = tree(plan_of(new))
        assert new.count() == rows.filter("day(date) % 3 = 2").count()
        history = plan[plan.index("Scan parquet") - 400 :] if "Scan parquet" in plan else plan
        assert shuffles(plan_of(new)) == 1 and "Exchange" not in history[history.index("HashAggregate") :]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {name}")
