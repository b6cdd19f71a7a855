from __future__ import annotations

import datetime as dt
import hashlib
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skyledger.operators.envelope import (
    build_envelopes,
    dedup_staging,
    dropped_documents,
    envelope_fields,
    record_count,
    require_valid,
    response_error,
    staging_rows,
)
from skyledger.functions.casts import safe_timestamp
from skyledger.sources.bronze import (
    bronze_path,
    landing_path,
    load_cities,
    read_bronze,
    read_landing,
    require_directory,
    write_bronze,
    write_landing,
)
from skyledger.sources.dimensions import CITIES
from skyledger.sources.schemas import RAW_WEATHER_COLUMNS
from support import RUN_AT, evaluate


def envelope(**meta) -> dict:
    base = {
        "city_id": "la_paz",
        "city_name": "La Paz",
        "source_type": "historical",
        "extraction_date": "2024-05-01",
        "extraction_timestamp_utc": "2024-05-01T06:00:00.123456+00:00",
        "record_count": 1,
    }
    daily = {"time": ["2024-01-01"], "temperature_2m_max": [20.5]}
    return {"meta": {**base, **meta}, "data": {"latitude": 1.5, "longitude": 2, "daily": daily}}


def land(root, path: str, document, bom: bool = False, **dump) -> bytes:
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, ensure_ascii=False, **dump)
    content = (b"\xef\xbb\xbf" if bom else b"") + text.encode()
    target.write_bytes(content)
    return content


def errors(spark, *documents) -> list:
    texts = [d if isinstance(d, str) else json.dumps(d) for d in documents]
    files = spark.createDataFrame([(i, f"f{i}", t) for i, t in enumerate(texts)], "i int, path string, document string")
    return [r.error for r in envelope_fields(files).orderBy("i").collect()]


def without(document: dict, key: str) -> dict:
    return {**document, "meta": {k: v for k, v in document["meta"].items() if k != key}}


def test_discovery_is_recursive_and_only_json(spark, tmp_path):
    land(tmp_path, "a.json", envelope())
    land(tmp_path, "x/y/z/b.json", envelope())
    land(tmp_path, "x/note.txt", "no")
    names = [r.source_file_name for r in read_landing(spark, str(tmp_path)).orderBy("path").collect()]
    assert names == ["a.json", "b.json"]


def test_missing_root_and_file_root_fail(spark, tmp_path):
    land(tmp_path, "a.json", envelope())
    with pytest.raises(FileNotFoundError):
        read_landing(spark, str(tmp_path / "nowhere"))
    with pytest.raises(NotADirectoryError):
        require_directory(spark, str(tmp_path / "a.json"))


def test_bom_is_hashed_but_not_parsed(spark, tmp_path):
    content = land(tmp_path, "a.json", envelope(city_name="Potosí"), bom=True, indent=2)
    row = staging_rows(require_valid(envelope_fields(read_landing(spark, str(tmp_path)))), "gs://bucket").first()
    assert row.payload_sha256 == hashlib.sha256(content).hexdigest()
    assert row.city_name == "Potosí"
    assert row.payload == json.dumps(envelope(city_name="Potosí"), ensure_ascii=False, separators=(",", ":"))


def test_staging_row_matches_the_table(spark, tmp_path):
    land(tmp_path, "historical_20240501.json", envelope(record_count="12"))
    files = read_landing(spark, str(tmp_path))
    rows = staging_rows(require_valid(envelope_fields(files)), "gs://bucket/", "/raw/", F.lit(RUN_AT))
    assert dict(rows.dtypes) == RAW_WEATHER_COLUMNS
    row = rows.first()
    assert row.gcs_uri == "gs://bucket/raw/historical/la_paz/2024/05/01/historical_20240501.json"
    assert (row.extraction_date, row.record_count) == (dt.date(2024, 5, 1), 12)
    assert row.extraction_timestamp_utc == dt.datetime(2024, 5, 1, 6, 0, 0, 123456)
    assert row.uploaded_at_utc == RUN_AT


def test_null_name_is_staged_as_text_and_kept_null_in_the_payload(spark, tmp_path):
    land(tmp_path, "a.json", envelope(city_name=None, city_id=None))
    row = staging_rows(require_valid(envelope_fields(read_landing(spark, str(tmp_path)))), "s").first()
    assert (row.city_id, row.city_name) == ("None", "None")
    assert json.loads(row.payload)["meta"]["city_name"] is None


def test_envelope_errors(spark):
    good = envelope()
    assert errors(
        spark, good, [1], "not json", "", {**good, "meta": "x"}, {"data": {}}, {"meta": good["meta"]}, {**good, "data": [1]}
    ) == [
        None,
        "document is not an object",
        "document is not an object",
        "document is not an object",
        "no object under meta",
        "no object under meta",
        "no object under data",
        "no object under data",
    ]
    assert errors(spark, without(good, "city_id"), without(without(good, "source_type"), "city_name")) == [
        "absent from meta: city_id",
        "absent from meta: city_name, source_type",
    ]
    assert errors(
        spark, envelope(record_count="many"), envelope(extraction_date="2024-02-30"), envelope(extraction_timestamp_utc="x")
    ) == ["record_count is not an integer", "extraction_date is not a date", "extraction_timestamp_utc is not a timestamp"]


def test_invalid_utf8_is_an_error(spark, tmp_path):
    (tmp_path / "bad.json").write_bytes(b'{"meta": "\xff"}')
    assert envelope_fields(read_landing(spark, str(tmp_path))).first().error == "document is not an object"


def test_strict_mode_names_the_file(spark, tmp_path):
    land(tmp_path, "good.json", envelope())
    land(tmp_path, "broken.json", "[]")
    checked = envelope_fields(read_landing(spark, str(tmp_path)))
    assert sorted(str(r.error) for r in checked.collect()) == ["None", "document is not an object"]
    with pytest.raises(PySparkException, match="broken.json: document is not an object"):
        staging_rows(require_valid(checked), "s").collect()


def test_response_errors_and_counts(spark):
    good = envelope()["data"]
    cases = [
        (good, None, 1),
        ([1], "response is not an object", 0),
        ({"latitude": 1}, "missing root fields: daily, longitude", 0),
        ({**good, "daily": [1]}, "daily is not an object", 0),
        ({**good, "daily": None}, "daily is not an object", 0),
        ({**good, "daily": {}}, "daily.time is not a non-empty array", 0),
        ({**good, "daily": {"time": []}}, "daily.time is not a non-empty array", 0),
        ({**good, "daily": {"time": "2024-01-01"}}, "daily.time is not a non-empty array", 0),
        ({**good, "latitude": None, "daily": {"time": [None, "x"]}}, None, 2),
    ]
    texts = [json.dumps(case) for case, _, _ in cases]
    assert evaluate(spark, texts, "string", response_error) == [error for _, error, _ in cases]
    assert evaluate(spark, texts, "string", record_count) == [count for _, _, count in cases]


def test_envelope_carries_the_response_as_it_came(spark):
    response = '{"latitude":1.50,"longitude":2,"daily":{"time":["2024-01-01"],"new_variable":[1]}}'
    responses = spark.createDataFrame(
        [("la_paz", "La Paz", -16.5, -68.15, None, "forecast", "http://x", dt.date(2024, 5, 1), "2024-05-01T00:00:00", response)],
        "city_id string, city_name string, latitude double, longitude double, elevation_m bigint, source_type string, "
        "source_url string, extraction_date date, extraction_timestamp_utc string, response string",
    )
    built = build_envelopes(responses, project="p", source_system="s", timezone="z").first().document
    unusable = responses.unionByName(responses).withColumn("response", F.when(F.rand() < 2, "not json"))
    for row in build_envelopes(unusable, project="p", source_system="s", timezone="z").collect():
        assert (row.document, row.response_error) == (None, "response is not an object")
    assert built.endswith(f',"data":{response}}}')
    meta = json.loads(built)["meta"]
    assert list(meta) == [
        "project", "source_system", "source_type", "extraction_date", "extraction_timestamp_utc", "city_id",
        "city_name", "latitude", "longitude", "elevation_m", "timezone", "source_url", "record_count",
    ]
    assert (meta["elevation_m"], meta["record_count"], meta["extraction_date"]) == (None, 1, "2024-05-01")


def test_paths(spark):
    row = (
        spark.createDataFrame([("h", "la_paz", "2024-05-01", "f.json")], "s string, c string, d string, f string")
        .select(
            bronze_path(F.col("s"), F.col("c"), F.col("d"), F.col("f")).alias("plain"),
            bronze_path(F.col("s"), F.col("c"), F.col("d"), F.col("f"), "/a/b/").alias("prefixed"),
            landing_path(F.col("c"), F.col("d").cast("date"), F.col("s")).alias("landing"),
        )
        .first()
    )
    assert row.plain == "h/la_paz/2024/05/01/f.json"
    assert row.prefixed == "a/b/h/la_paz/2024/05/01/f.json"
    assert row.landing == "la_paz/2024/05/01/h_20240501.json"


STAGED = "city_id string, source_type string, extraction_date date, gcs_uri string, payload_sha256 string, payload string"


def test_dedup_keeps_the_first_path_and_skips_known_ids(spark):
    first, second = dt.date(2024, 5, 1), dt.date(2024, 5, 2)
    batch = spark.createDataFrame(
        [
            ("a", "h", first, "u2", "s", "p2"),
            ("a", "h", first, "u1", "s", "p1"),
            ("a", "h", first, "u1", "s", "p1"),
            ("a", "f", first, "u3", "s", "p3"),
            ("a", "h", second, "u4", "s", "p4"),
        ],
        STAGED,
    )
    existing = batch.filter("gcs_uri = 'u4'")
    kept = dedup_staging(batch, existing).collect()
    assert sorted(r.payload for r in kept) == ["p1", "p3"]
    assert dedup_staging(batch).count() == 3
    assert dedup_staging(batch, batch).isEmpty()
    dropped = [(r.gcs_uri, r.kept_uri) for r in dropped_documents(batch).collect()]
    assert dropped == [("u2", "u1")]


def test_documents_are_read_whole_and_strictly(spark):
    text = json.dumps(envelope())
    assert errors(
        spark, text + " oops", text + text, text.replace('"meta"', "'meta'"), text + "]", text + "}", text + ', {"x": 1}',
        "[" + text + "]", f" \n{text}\t", '{"meta": {}, "data": {}} , "e": {"a": 1}',
    ) == [*["document is not an object"] * 7, None, "document is not an object"]
    # The last of a repeated key counts; 12.0 is a number of rows, "12.0" is not.
    twice = text.replace('"meta": {', '"meta": {"record_count": "x", ')
    assert errors(spark, twice, envelope(record_count=12.0), envelope(record_count="12.0"), envelope(record_count=True)) == [
        None, None, "record_count is not an integer", "record_count is not an integer",
    ]
    assert errors(spark, envelope(extraction_timestamp_utc="2024-05")) == ["extraction_timestamp_utc is not a timestamp"]


def test_a_dry_run_cannot_lose_its_check(spark, tmp_path):
    land(tmp_path, "good.json", envelope())
    land(tmp_path, "broken.json", "[]")
    rows = staging_rows(require_valid(envelope_fields(read_landing(spark, str(tmp_path)))), "s")
    for action in (rows.count, rows.select("source_file_name").collect):
        with pytest.raises(PySparkException, match="broken.json"):
            action()


def test_stamps_without_offset_are_utc(spark):
    texts = ["2024-05-01T06:00:00", "2024-05-01 06:00", "2024-05-01T06:00:00Z", "2024-05-01T02:00:00-04:00", "2024-05-01", "2024-05"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/La_Paz")
    try:
        got = evaluate(spark, texts, "string", lambda x: F.unix_timestamp(safe_timestamp(x)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    six = 1714543200
    assert got == [six, six, six, six, six - 6 * 3600, None]


def test_layouts_are_foldered(spark, tmp_path):
    staged = spark.createDataFrame([("a", "h", dt.date(2024, 5, 1), "u", "s", "p")], STAGED)
    write_bronze(staged.withColumn("content", F.encode("payload", "utf-8")), str(tmp_path / "bronze"))
    assert (tmp_path / "bronze/source_type=h/city_id=a/extraction_year=2024/extraction_month=05/extraction_day=01").is_dir()
    assert [bytes(r.content) for r in read_bronze(spark, str(tmp_path / "bronze")).collect()] == [b"p"]
    text = json.dumps(envelope(), indent=1)
    write_landing(staged.withColumn("document", F.lit(text)), str(tmp_path / "landing"))
    assert (tmp_path / "landing/city_id=a/extraction_year=2024/extraction_month=05/extraction_day=01").is_dir()
    back = envelope_fields(read_landing(spark, str(tmp_path / "landing"))).first()
    assert json.loads(back.document) == envelope() and back.error is None


def config(tmp_path, cities) -> str:
    (tmp_path / "cities.json").write_bytes(b"\xef\xbb\xbf" + json.dumps({"cities": cities}, indent=2).encode())
    return str(tmp_path / "cities.json")


def test_city_config(spark, tmp_path):
    cities = [
        {"id": c.city_id, "name": c.city_name, "lat": c.latitude, "lon": str(c.longitude), "elevation_m": c.elevation_m}
        for c in CITIES
    ]
    rows = load_cities(spark, config(tmp_path, cities)).collect()
    assert [(r.city_id, r.latitude, r.longitude) for r in rows] == [(c.city_id, c.latitude, c.longitude) for c in CITIES]


@pytest.mark.parametrize(
    ("cities", "message"),
    [
        ([], "not a list with entries"),
        ("x", "not a list with entries"),
        ([{"id": "a", "name": "A", "lat": 1, "lon": 2}, 5], "entry 2 is no object"),
        ([{"id": "a", "lat": 1}], "entry 1 lacks lon, name"),
        ([{"id": "a", "name": "A", "lat": "north", "lon": 2}], "entry 1 lies at no place"),
    ],
)
def test_bad_city_config(spark, tmp_path, cities, message):
    with pytest.raises(ValueError, match=message):
        load_cities(spark, config(tmp_path, cities))
