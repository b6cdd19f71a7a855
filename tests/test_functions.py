from __future__ import annotations

import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.functions.casts import safe_date, safe_double, safe_long, safe_timestamp
from skyledger.functions.jsontext import STRICT, compact, json_scalar, once, scalar_array, sealed, unsealed, without_bom
from skyledger.functions.labels import city_key, month_name_es, season_en, season_es
from skyledger.functions.numeric import clamp, is_above, is_at_least, percent_of, round2
from support import evaluate

NAN, INF = float("nan"), float("inf")


def test_round2_half_away_from_zero(spark):
    values = [0.125, -0.125, 2.5, -0.004, 0.004, 0.005, 1e15 + 0.3, None, INF, -INF]
    expected = [0.13, -0.13, 2.5, 0.0, 0.0, 0.01, 1e15 + 0.3, None, INF, -INF]
    result = evaluate(spark, values, "double", round2)
    assert result == expected
    assert math.copysign(1.0, result[3]) == 1.0
    assert math.isnan(evaluate(spark, [NAN], "double", round2)[0])


def test_round2_matches_double_arithmetic(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.floats(-1e6, 1e6), min_size=200, max_size=400))
    def check(values):
        for value, got in zip(values, evaluate(spark, values, "double", round2)):
            want = math.copysign(math.floor(abs(value) * 100 + 0.5) / 100, value) + 0.0
            assert got == want

    check()


def test_clamp_keeps_null_and_nan(spark):
    assert evaluate(spark, [-1.0, 0.0, 50.0, 100.0, 100.1, None, INF], "double", clamp) == [
        0.0, 0.0, 50.0, 100.0, 100.0, None, 100.0
    ]
    assert math.isnan(evaluate(spark, [NAN], "double", clamp)[0])


def test_nan_satisfies_no_comparison(spark):
    for compare in (is_above, is_at_least):
        assert evaluate(spark, [NAN, 2.0, None], "double", lambda x: compare(x, 1.0)) == [False, True, None]


def test_percent_of_zero_is_null(spark):
    assert evaluate(spark, [0.0, 50.0], "double", lambda x: percent_of(F.lit(5.0), x)) == [None, 10.0]


def test_safe_double(spark):
    texts = ["1.5", " -2 ", "1e3", ".5", "5.", "1.5d", "abc", "", None, "inf", "-Infinity", "0x1A"]
    expected = [1.5, -2.0, 1000.0, 0.5, 5.0, None, None, None, None, INF, -INF, None]
    assert evaluate(spark, texts, "string", safe_double) == expected
    assert all(math.isnan(v) for v in evaluate(spark, ["NaN", "-nan"], "string", safe_double))


def test_safe_long(spark):
    texts = ["95", "95.0", "+7", " 3 ", "x", "", None, "99999999999999999999"]
    assert evaluate(spark, texts, "string", safe_long) == [95, None, 7, 3, None, None, None, None]


def test_safe_date(spark):
    texts = ["2024-01-05", "2024-1-5", "2024", "2024-01", "2024-02-30", "2024-01-01T10:00", "x", None, "0000-01-01"]
    day = dt.date(2024, 1, 5)
    assert evaluate(spark, texts, "string", safe_date) == [day, day] + [None] * 7


def test_safe_timestamp(spark):
    texts = ["2024-01-01T06:00:00+00:00", "2024-01-01T06:00:00.250000+00:00", "soon", None]
    result = evaluate(spark, texts, "string", lambda x: F.date_format(safe_timestamp(x), "yyyy-MM-dd HH:mm:ss.SSS"))
    assert result == ["2024-01-01 06:00:00.000", "2024-01-01 06:00:00.250", None, None]


def test_json_scalar_takes_scalars_only(spark):
    text = '{"a": 1, "b": "t", "c": null, "d": {"e": 2.50}, "f": [1], "g": true}'
    got = {p: evaluate(spark, [text], "string", lambda x: json_scalar(x, p))[0] for p in
           ("$.a", "$.b", "$.c", "$.d", "$.d.e", "$.f", "$.g", "$.zzz")}
    assert got == {"$.a": "1", "$.b": "t", "$.c": None, "$.d": None, "$.d.e": "2.5", "$.f": None,
                   "$.g": "true", "$.zzz": None}


def test_scalar_array_is_null_if_it_holds_an_object(spark):
    texts = ['["1", null, "x"]', '["1", {"a": 1}]', '[[1], "2"]', "[]", '"x"', '["[draft] x", "{z}"]']
    documents = [f'{{"k": {t}}}' for t in texts]
    read = lambda x: scalar_array(F.from_json(x, "k array<string>")["k"], F.try_parse_json(x), "$.k")
    assert evaluate(spark, documents, "string", read) == [["1", None, "x"], None, None, [], None, ["[draft] x", "{z}"]]
    single = ['{"k": "[draft] x"}', '{"k": ["a"]}', '{"k": "{z}"}', '{"k": {"a": 1}}', '{"k": 5}']
    got = evaluate(spark, single, "string", lambda x: json_scalar(x, "$.k"))
    assert got == ["[draft] x", None, "{z}", None, "5"]



def test_compact_keeps_strings_and_key_order(spark):
    text = '{ "b" : "two  words \\" : , " ,\n\t"a" : [ 1 , 2.50 , null ] , "é" : "ü  x" }'
    assert evaluate(spark, [text], "string", compact) == [
        '{"b":"two  words \\" : , ","a":[1,2.50,null],"é":"ü  x"}'
    ]


def test_without_bom(spark):
    assert evaluate(spark, ["﻿{}", "{}", None], "string", without_bom) == ["{}", "{}", None]


def test_city_key(spark):
    names = ["Santa Cruz de la Sierra", "LA PAZ", "ORURO", "Villa Montes", "Potosí Alto", None]
    keys = ["santa_cruz", "la_paz", "oruro", "villa_montes", "potosí_alto", None]
    assert evaluate(spark, names, "string", city_key) == keys


def test_seasons_and_months(spark):
    months = [1, 2, 3, 5, 6, 8, 9, 11, 12, None]
    english = ["Summer", "Summer", "Autumn", "Autumn", "Winter", "Winter", "Spring", "Spring", "Summer", "Unknown"]
    assert evaluate(spark, months, "int", season_en) == english
    spanish = {"Summer": "Verano", "Autumn": "Otono", "Winter": "Invierno", "Spring": "Primavera", "Unknown": None}
    assert evaluate(spark, months, "int", season_es) == [spanish[name] for name in english]
    assert evaluate(spark, [1, 9, 12, 13, None], "int", month_name_es) == [
        "Enero", "Septiembre", "Diciembre", None, None
    ]


def test_sealed_documents_are_whole_or_null(spark):
    texts = ['{"a":1}', ' {"a":1}\n', '{"a":1} x', '{"a":1}{"a":2}', '{"a":1},{"a":2}', '{"a":1}]', '{"a":1},{"seal":"s"}]',
             "{'a':1}", "", "5", "[1]", '[{"a":1}]', "null", None, '{"seal":"x","a":1}']
    read = lambda x: once(F.from_json(sealed(x), "array<struct<a: string, seal: string>>", STRICT), lambda r: unsealed(r, x)["a"])
    assert evaluate(spark, texts, "string", read) == ["1", "1", *[None] * 12, "1"]
