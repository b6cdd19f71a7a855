from __future__ import annotations

import datetime as dt
import json
import math

from skyledger.operators.daily import parse_daily, typed_daily
from support import RUN_AT


def parse(spark, *documents):
    texts = [d if isinstance(d, str) or d is None else json.dumps(d) for d in documents]
    raw = spark.createDataFrame([(t, RUN_AT) for t in texts], "payload string, extraction_timestamp_utc timestamp")
    return parse_daily(raw)


def document(name="La Paz", **daily):
    return {"meta": {"city_name": name, "city_id": "ignored"}, "data": {"daily": daily}}


def test_positions_pair_up_and_short_arrays_give_null(spark):
    rows = parse(
        spark,
        document(
            time=["2024-01-01", "2024-01-02", "2024-01-03"],
            temperature_2m_max=[20.5, None, "21"],
            temperature_2m_min=[10],
            weathercode=[95, "95.0", 3],
            precipitation_sum=["abc", 0, "1.5d"],
        ),
    ).orderBy("date").collect()
    assert [r.date.day for r in rows] == [1, 2, 3]
    assert [r.temperature_2m_max for r in rows] == [20.5, None, 21.0]
    assert [r.temperature_2m_min for r in rows] == [10.0, None, None]
    assert [r.weathercode for r in rows] == [95, None, 3]
    assert [r.precipitation_sum for r in rows] == [None, 0.0, None]
    assert {r.temperature_2m_mean for r in rows} == {None}
    assert {(r.city_id, r.city_name, r.payload_source) for r in rows} == {("la_paz", "La Paz", "$.data.daily")}


def test_longer_variable_adds_no_rows(spark):
    assert parse(spark, document(time=["2024-01-01"], temperature_2m_max=[1, 2, 3])).count() == 1


def test_no_time_array_gives_no_rows(spark):
    absent = {"meta": {"city_name": "La Paz"}, "data": {}}
    documents = [document(), document(time=[]), document(time=None), document(time="2024-01-01"), absent, "nonsense"]
    assert parse(spark, *documents, None).count() == 0


def test_bad_dates_keep_their_row(spark):
    rows = parse(spark, document(time=["2024", "2024-02-30", None, {"a": 1}, "2024-01-01T10:00", "2024-1-5"])).collect()
    assert sorted(r.date is None for r in rows) == [False] + [True] * 5
    assert [r.date for r in rows if r.date] == [dt.date(2024, 1, 5)]


def test_object_in_a_variable_voids_that_variable_only(spark):
    rows = parse(
        spark,
        document(time=["2024-01-01", "2024-01-02"], temperature_2m_max=[1.0, {"v": 2}], temperature_2m_min=[0.5, 0.6]),
    ).collect()
    assert [r.temperature_2m_max for r in rows] == [None, None]
    assert sorted(r.temperature_2m_min for r in rows) == [0.5, 0.6]


def test_variable_that_is_no_array_is_null(spark):
    row = parse(spark, document(time=["2024-01-01"], temperature_2m_max=5, temperature_2m_min=[4])).first()
    assert (row.temperature_2m_max, row.temperature_2m_min) == (None, 4.0)


def test_nan_text(spark):
    row = parse(spark, document(time=["2024-01-01"], temperature_2m_max=["NaN"])).first()
    assert math.isnan(row.temperature_2m_max)


def test_missing_name_gives_null_key(spark):
    rows = parse(spark, document(name=None, time=["2024-01-01"]), document(name={"a": 1}, time=["2024-01-01"]))
    assert [(r.city_id, r.city_name) for r in rows.collect()] == [(None, None)] * 2


def test_typed_daily_adds_calendar_columns(spark):
    rows = typed_daily(parse(spark, document(time=["2024-07-09", None]))).collect()
    got = {(r.year, r.month, r.season) for r in rows}
    assert got == {(2024, 7, "Winter"), (None, None, "Unknown")}
    assert dict(typed_daily(parse(spark, document())).dtypes)["year"] == "bigint"
