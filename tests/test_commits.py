"""A run that stops anywhere leaves its batch whole or not at all, at the latest after the rerun."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger.operators.climate import observed_months
from skyledger.operators.incremental import in_buckets, of_buckets
from skyledger.operators.invariants import GateClosed
from skyledger.operators.moments import baseline_from_state, merge_states, months_from_state, weather_state
from skyledger.operators.risk import risk_base, temp_baseline
from skyledger.plans import medallion
from skyledger.plans.medallion import current_state, refresh_gold, run_all
from skyledger.sources import commits
from skyledger.sources.commits import committed, open_batches
from skyledger.sources.tables import in_ranges, replace, versions
from support import RUN_AT, day, days, plan_of
from test_bronze import land
from test_medallion import counts, layers, payload  # noqa: F401

TABLES = ("raw", "clean", "rejects", "landing_rejects", "duplicates", "state")


def seen(spark, names) -> dict[str, int]:
    """What readers see of each table of a batch."""
    found = {}
    for table in TABLES:
        name = getattr(names, table)
        if spark.catalog.tableExists(name):
            spark.catalog.refreshTable(name)
            found[table] = committed(spark, name, names.batches).count()
    return found


def pending(spark, names) -> list[str]:
    return [t.name for t in spark.catalog.listTables(names.silver) if t.name.startswith("pending_")]


@pytest.mark.parametrize("stop", [0, 1, 3, 5, 6])
def test_a_stop_between_any_two_appends(spark, layers, tmp_path, monkeypatch, stop):  # noqa: F811
    """Appends in order: the commit, raw, duplicates, landing rejects, clean, state, rejects, done."""
    land(tmp_path, "a/h.json", payload("La Paz", ["2024-01-01", "2024-01-02", "bad"]))
    land(tmp_path, "b/h.json", payload("La Paz", ["2024-01-03"]))
    land(tmp_path, "c.json", "[]")
    real, calls = commits.append, []

    def failing(rows, name, rebalance_by=None):
        if len(calls) == stop:
            raise KeyboardInterrupt
        calls.append(name)
        real(rows, name, rebalance_by)

    with monkeypatch.context() as patch:
        patch.setattr(commits, "append", failing)
        with pytest.raises(KeyboardInterrupt):
            run_all(spark, str(tmp_path), "s", layers, run_at=RUN_AT)
    # The commit is the first append: readers see nothing of a batch that is not done.
    assert set(seen(spark, layers).values()) == {0}
    assert len(open_batches(spark, layers.batches)) == (0 if stop == 0 else 1)
    run_all(spark, str(tmp_path), "s", layers, run_at=RUN_AT)
    again = 1 if stop == 0 else 2  # rejects of the finished batch and those of the rerun
    want = {"raw": 1, "clean": 2, "rejects": again, "landing_rejects": 1, "duplicates": 1}
    found = seen(spark, layers)
    assert {k: found[k] for k in want} == want
    assert not open_batches(spark, layers.batches) and not pending(spark, layers)
    assert {r.n for r in spark.table(layers.clean).groupBy("city_id", "date").count().selectExpr("count AS n").collect()} == {1}
    refresh_gold(spark, layers)
    assert counts(spark, layers)["risk"] == 2


def test_an_error_discards_the_batch(spark, layers, tmp_path, monkeypatch):  # noqa: F811
    land(tmp_path, "a.json", payload("La Paz", ["2024-01-01"]))
    with monkeypatch.context() as patch:
        patch.setattr(medallion, "quarantine", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_all(spark, str(tmp_path), "s", layers)
    assert set(seen(spark, layers).values()) == {0} and not pending(spark, layers)


def observed(spark):
    rows = [
        day(date=None if i % 17 == 0 else __import__("datetime").date(2020 + i % 4, 1 + i % 12, 1 + i % 28), city_id=f"c{i % 3}",
            temperature_2m_max=1e6 + i % 7, temperature_2m_min=1e6 - i % 5, temperature_2m_mean=None if i % 4 else 1e6 + i / 9,
            windspeed_10m_max=None if i % 6 == 0 else float(i % 11))
        for i in range(300)
    ]
    return days(spark, rows).filter("date IS NOT NULL")


def rounded(df, *keys):
    return sorted(
        tuple(str(r[k]) for k in keys) + tuple(None if v is None else round(v, 6) for k, v in r.asDict().items() if k not in keys)
        for r in df.collect()
    )


def test_state_of_parts_is_that_of_all_rows(spark):
    """Also far from zero, where sums of squares lose what deviations need."""
    rows = observed(spark).cache()
    parts = [weather_state(rows.filter(f"pmod(hash(date), 3) = {k}")) for k in range(3)]
    state = merge_states([merge_states(parts[:2]), parts[2], weather_state(rows.limit(0))])
    whole = temp_baseline(risk_base(rows))
    assert rounded(baseline_from_state(state), "city_id") == rounded(whole, "city_id")
    columns = ["city_id", "month_number", "days", "max_c", "min_c", "rain_mm", "wind_kmh", "mid_std"]
    full = observed_months(rows).select(*columns)
    assert rounded(months_from_state(state).select(*columns), "city_id", "month_number") == rounded(full, "city_id", "month_number")


def test_gold_reads_the_state_only_if_it_covers_all_rows(spark, layers, tmp_path):  # noqa: F811
    land(tmp_path, "a.json", payload("La Paz", ["2024-01-01", "2024-01-02"]))
    run_all(spark, str(tmp_path), "s", layers)
    land(tmp_path, "b.json", payload("La Paz", ["2024-02-01"], day="2024-06-01", temperature_2m_max=[31.0]))
    run_all(spark, str(tmp_path), "s", layers)
    assert current_state(spark, layers) is not None
    before = {t: sorted(spark.table(getattr(layers, t)).drop("generated_at").collect()) for t in ("risk", "climate")}
    spark.sql(f"TRUNCATE TABLE {layers.state}")
    assert current_state(spark, layers) is None
    refresh_gold(spark, layers)
    assert before == {t: sorted(spark.table(getattr(layers, t)).drop("generated_at").collect()) for t in ("risk", "climate")}


def test_a_closed_gate_keeps_the_old_table(spark, layers, tmp_path, monkeypatch):  # noqa: F811
    land(tmp_path, "a.json", payload("La Paz", ["2024-01-01"]))
    run_all(spark, str(tmp_path), "s", layers)
    land(tmp_path, "b.json", payload("La Paz", ["2024-01-02"], day="2024-06-01"))
    real = medallion.daily_risk
    with monkeypatch.context() as patch:
        spoil = lambda *a, **b: real(*a, **b).withColumn("composite_risk_score", F.lit(101.0))
        patch.setattr(medallion, "daily_risk", spoil)
        with pytest.raises(GateClosed, match="COMPOSITE_RISK_SCORE_RANGE"):
            run_all(spark, str(tmp_path), "s", layers)
    assert counts(spark, layers)["risk"] == 1 and counts(spark, layers)["clean"] == 2
    assert len(versions(spark, layers.risk)) == 1
    refresh_gold(spark, layers)
    assert counts(spark, layers)["risk"] == 2


def test_a_log_opens_only_the_folders_of_the_batch(spark, layers):  # noqa: F811
    medallion.create_silver(spark, layers)
    log = spark.range(200).selectExpr("concat('p', id) AS path", "'f' AS source_file_name", "string(id) AS payload_sha256",
                                      "'e' AS error", "current_timestamp() AS rejected_at_utc")
    keys = ("path", "payload_sha256")
    for _ in range(2):
        with commits.Batch(spark, layers.batches) as batch:
            medallion.log_new(log, layers.landing_rejects, keys, batch)
    assert spark.table(layers.landing_rejects).count() == 200
    few = in_buckets(log.limit(1), keys).cache()
    read = of_buckets(spark.table(layers.landing_rejects), few)
    assert len(read.inputFiles()) < len(spark.table(layers.landing_rejects).inputFiles()) / 4
    assert "PartitionFilters: [" in plan_of(read) and "bucket" in plan_of(read).split("PartitionFilters: [")[1].split("\n")[0]


def test_event_files_are_disjoint_ranges_of_the_report_order(spark, layers):  # noqa: F811
    """Also where one day has most of the rows."""
    spark.sql(f"CREATE DATABASE {layers.gold}")
    rows = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN date'2024-03-03' ELSE date_add(date'2024-01-01', CAST(id % 300 AS INT)) END AS date",
        "concat('c', id % 5) AS city_name", "'T' AS event_type", "2024 AS year", "id")
    order = ("date", "city_name", "event_type")
    name = f"{layers.gold}.e"
    small_files = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small_files, "false")
    try:
        replace(in_ranges(rows, ("year",), order), name, sort_by=order, partition_by=("year",))
    finally:
        spark.conf.unset(small_files)
    tie = F.xxhash64("date", "city_name", "event_type", "year", "id")
    table = spark.table(name).select(F.input_file_name().alias("f"), F.struct(*order, tie.alias("tie")).alias("k"))
    files = sorted((r.lo, r.hi) for r in table.groupBy("f").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect())
    assert len(files) > 2 and sum(lo.date == hi.date for lo, hi in files) >= 1
    assert all(a[1] < b[0] for a, b in zip(files, files[1:]))
