from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skyledger.operators.climate import climate_monthly, month_calendar
from skyledger.operators.events import DETECTORS, FROST, HEAT_WAVE, HEAVY_RAIN, HIGH_WIND, STORM, extreme_events, in_report_order
from skyledger.operators.risk import daily_risk, risk_base, risk_level, temp_baseline
from skyledger.plans import fixture
from skyledger.operators.quality import accept
from skyledger.sources.dimensions import CITIES, cities_dim
from support import day, days, evaluate

SF = "/root/testdata/sf0.001"


def on(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_constant_series_uses_the_steps(spark):
    extremes = [(37.0, 20.0), (36.9, 20.0), (20.0, 2.0), (20.0, 2.1), (34.0, 20.0), (20.0, 5.0), (30.0, 20.0),
                (20.0, 8.0), (29.9, 8.1), (33.9, 5.1)]
    rows = [day(date=on(i), temperature_2m_max=a, temperature_2m_min=b) for i, (a, b) in enumerate(extremes)]
    risk = daily_risk(days(spark, rows), cities_dim(spark)).orderBy("date").collect()
    assert [r.temp_risk_score for r in risk] == [100.0, 75.0, 100.0, 75.0, 75.0, 75.0, 50.0, 50.0, 10.0, 50.0]


def test_deviation_score(spark):
    rows = [day(date=on(i), temperature_2m_mean=m) for i, m in enumerate([10.0, 20.0, 30.0])]
    risk = daily_risk(days(spark, rows), cities_dim(spark)).orderBy("date").collect()
    edge = math.floor(10 / math.sqrt(200 / 3) * 25 * 100 + 0.5) / 100
    assert [r.temp_risk_score for r in risk] == [edge, 0.0, edge]


def test_loads_are_clamped_and_weighted(spark):
    rows = [day(precipitation_sum=60.0, windspeed_10m_max=30.0)]
    row = daily_risk(days(spark, rows), cities_dim(spark)).first()
    assert (row.precip_risk_score, row.wind_risk_score) == (100.0, 50.0)
    assert row.composite_risk_score == 10.0 * 0.4 + 35.0 + 12.5
    assert row.risk_level == "HIGH"


def test_missing_wind_is_critical(spark):
    row = daily_risk(days(spark, [day(windspeed_10m_max=None)]), cities_dim(spark)).first()
    assert (row.wind_risk_score, row.composite_risk_score, row.risk_level) == (None, None, "CRITICAL")


def test_missing_mean_uses_mid_range(spark):
    rows = [day(temperature_2m_mean=None, temperature_2m_max=21.0, temperature_2m_min=10.0)]
    assert risk_base(days(spark, rows)).first().temperature_reference_c == 15.5


def test_nan_mean_reaches_the_whole_city(spark):
    rows = [day(temperature_2m_mean=float("nan")), day(date=on(1)), day(date=on(2), temperature_2m_mean=3.0)]
    risk = daily_risk(days(spark, rows), cities_dim(spark)).collect()
    assert all(math.isnan(r.temp_risk_score) and r.risk_level == "CRITICAL" for r in risk)


def test_unknown_city_is_dropped_and_name_comes_from_the_dimension(spark):
    rows = [day(city_id="villa_montes"), day(city_id="oruro", city_name="ORURO")]
    risk = daily_risk(days(spark, rows), cities_dim(spark)).collect()
    assert [(r.city_id, r.city_name) for r in risk] == [("oruro", "Oruro")]


def test_level_bounds(spark):
    scores = [0.0, 25.0, 25.01, 50.0, 50.01, 75.0, 75.01, None]
    levels = ["LOW", "LOW", "MODERATE", "MODERATE", "HIGH", "HIGH", "CRITICAL", "CRITICAL"]
    assert evaluate(spark, scores, "double", risk_level) == levels


def test_two_phase_baseline_equals_the_window(spark):
    base = risk_base(accept(fixture.typed_observations(spark, SF)), cities_dim(spark), dim_rows=len(CITIES))
    window = Window.partitionBy("city_id")
    reference = F.col("temperature_reference_c")
    by_window = base.select(
        "city_id", F.avg(reference).over(window).alias("a"), F.stddev_pop(reference).over(window).alias("s")
    ).distinct()
    joined = temp_baseline(base).join(by_window, "city_id").collect()
    assert len(joined) == 6
    assert all(abs(r.a - r.baseline_avg) < 1e-9 and abs(r.s - r.baseline_std) < 1e-9 for r in joined)


def test_risk_by_many_entities_is_the_same_by_shuffle(spark):
    clean = accept(fixture.typed_observations(spark, SF))
    plain = daily_risk(clean, entity="station_id")
    split = daily_risk(clean, entity="station_id", broadcast_rows=30, hot_rows=40)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_scores_stay_in_range(spark):
    risk = daily_risk(accept(fixture.typed_observations(spark, SF)), cities_dim(spark))
    scores = ["temp_risk_score", "precip_risk_score", "wind_risk_score", "composite_risk_score"]
    for name in scores:
        assert risk.filter(~F.col(name).between(0, 100)).isEmpty()


def test_calendar_has_twelve_months_per_city(spark):
    months = month_calendar(cities_dim(spark))
    assert months.count() == 72
    assert months.select("city_id", "month_number").distinct().count() == 72


def test_climate_is_complete_and_pools_years(spark):
    rows = [day(date=dt.date(2020 + i % 3, 1, 1 + i), temperature_2m_max=20.0 + i) for i in range(15)]
    rows += [day(date=dt.date(2024, 2, 1)), day(date=dt.date(2024, 2, 2), windspeed_10m_max=None)]
    rows += [day(city_id="villa_montes")]
    months = climate_monthly(days(spark, rows), cities_dim(spark)).filter("city_id = 'la_paz'")
    got = {r.month_number: r for r in months.collect()}
    assert len(got) == 12
    assert (got[1].observed_days, got[1].data_completeness_status) == (15, "OBSERVED")
    assert got[1].avg_temp_max == 27.0
    assert (got[2].observed_days, got[2].data_completeness_status) == (1, "PARTIAL_MONTH")
    assert got[2].climate_variability_index == 0.0
    assert (got[3].observed_days, got[3].data_completeness_status) == (0, "NO_OBSERVATIONS")
    assert (got[3].avg_temp_max, got[3].month_name, got[3].season) == (None, "Marzo", "Otono")


@pytest.mark.parametrize(
    ("detector", "column", "cases"),
    [
        (HEAT_WAVE, "temperature_2m_max", {37.0: None, 37.1: "MODERATE", 40.0: "SEVERE", 42.0: "EXTREME"}),
        (FROST, "temperature_2m_min", {2.0: None, 1.9: "MODERATE", 0.0: "SEVERE", -5.0: "EXTREME"}),
        (HEAVY_RAIN, "precipitation_sum", {50.0: None, 50.1: "MODERATE", 75.0: "SEVERE", 100.0: "EXTREME"}),
        (HIGH_WIND, "windspeed_10m_max", {60.0: None, 60.1: "MODERATE", 75.0: "SEVERE", 90.0: "EXTREME"}),
        (STORM, "weathercode", {94: None, 95: "MODERATE", 96: "SEVERE", 99: "EXTREME"}),
    ],
)
def test_thresholds(spark, detector, column, cases):
    rows = [day(date=on(i), **{column: value}) for i, value in enumerate(cases)]
    events = {r.date: r for r in extreme_events(days(spark, rows), [detector]).collect()}
    for i, (value, severity) in enumerate(cases.items()):
        assert (events[on(i)].event_severity if on(i) in events else None) == severity
        if severity:
            assert events[on(i)].observed_value == float(value)


def test_one_day_raises_up_to_five_events(spark):
    row = day(temperature_2m_max=45.0, temperature_2m_min=-6.0, precipitation_sum=120.0, windspeed_10m_max=95.0,
              weathercode=99, city_id="villa_montes", city_name="Villa Montes")
    events = extreme_events(days(spark, [row])).collect()
    assert {e.event_type for e in events} == {d.event_type for d in DETECTORS}
    assert {e.event_severity for e in events} == {"EXTREME"}
    assert {e.exceedance_pct for e in events} == {21.62, 400.0, 140.0, 58.33, 4.21}


def test_events_need_a_weather_code(spark):
    assert extreme_events(days(spark, [day(temperature_2m_max=45.0, weathercode=None)])).isEmpty()


def test_report_order(spark):
    events = in_report_order(extreme_events(accept(fixture.typed_observations(spark, SF)))).collect()
    keys = [(r.date, r.city_name, r.event_type) for r in events]
    assert keys == sorted(keys)
