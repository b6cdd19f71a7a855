from __future__ import annotations

import hashlib
import json
import uuid

import pytest
from pyspark.errors import PySparkException

from skyledger.plans.medallion import Layers, create_silver, refresh_gold, refresh_silver, run_all, stage_landing
from skyledger.operators.incremental import unseen, within
from skyledger.sources.bronze import read_bronze, write_landing
from skyledger.sources.tables import append, replace, versions, written_once
from skyledger.streaming.landing import landing_stream
from support import RUN_AT, plan_of
from test_bronze import envelope, land


@pytest.fixture
def layers(spark):
    tag = uuid.uuid4().hex[:8]
    names = Layers(f"silver_{tag}", f"gold_{tag}")
    yield names
    for database in (names.silver, names.gold):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def payload(city: str, dates: list[str], source: str = "historical", day: str = "2024-05-01", **daily) -> dict:
    document = envelope(city_name=city, city_id=city.lower(), source_type=source, extraction_date=day)
    n = len(dates)
    document["data"]["daily"] = {
        "time": dates,
        "temperature_2m_max": [30.0] * n,
        "temperature_2m_min": [20.0] * n,
        "precipitation_sum": [0.0] * n,
        "windspeed_10m_max": [10.0] * n,
        "weathercode": [95] * n,
        **daily,
    }
    return document


def counts(spark, layers) -> dict[str, int]:
    """Rows per existing table. A stream writes in a session of its own, so listings are refreshed."""
    found = {}
    for layer in ("raw", "clean", "rejects", "risk", "climate", "events"):
        name = getattr(layers, layer)
        if spark.catalog.tableExists(name):
            spark.catalog.refreshTable(name)
            found[layer] = spark.table(name).count()
    return found


def test_files_to_gold_and_rerun(spark, layers, tmp_path):
    land(tmp_path, "a/h.json", payload("La Paz", ["2024-01-01", "2024-01-02", "bad"]), bom=True)
    land(tmp_path, "b/h.json", payload("Villa Montes", ["2024-01-01"], precipitation_sum=[-1.0]))
    run_all(spark, str(tmp_path), "gs://bucket", layers, run_at=RUN_AT)
    assert counts(spark, layers) == {"raw": 2, "clean": 2, "rejects": 2, "risk": 2, "climate": 72, "events": 2}
    assert spark.table(layers.cities).count() == 6 and spark.table(layers.codes).count() == 21
    assert {r.loaded_at_utc for r in spark.table(layers.clean).collect()} == {RUN_AT}

    # Staged ids are known, accepted keys are known, rejects are logged again.
    run_all(spark, str(tmp_path), "gs://bucket", layers, run_at=RUN_AT)
    assert counts(spark, layers) == {"raw": 2, "clean": 2, "rejects": 4, "risk": 2, "climate": 72, "events": 2}
    refresh_silver(spark, layers, log_once=True)
    assert spark.table(layers.rejects).count() == 4


def test_a_configured_city_reaches_gold(spark, layers, tmp_path):
    """A city that is not built in, and one whose key is not its id."""
    config = tmp_path / "cities.json"
    cities = [{"id": "rio", "name": "Rio Negro", "lat": -1, "lon": 2.5, "elevation_m": 7.4},
              {"id": "scz", "name": "Santa Cruz de la Sierra", "lat": -17, "lon": -63}]
    config.write_text(json.dumps({"cities": cities}))
    land(tmp_path / "in", "a.json", payload("Rio Negro", ["2024-01-01"]))
    land(tmp_path / "in", "b.json", payload("Santa Cruz de la Sierra", ["2024-01-02"]))
    land(tmp_path / "in", "c.json", payload("La Paz", ["2024-01-03"]))
    run_all(spark, str(tmp_path / "in"), "s", layers, cities=str(config))
    found = {r.city_id: (r.elevation_m, r.department) for r in spark.table(layers.cities).collect()}
    assert found == {"rio_negro": (7, None), "santa_cruz": (None, "Santa Cruz")}
    assert sorted(r.city_id for r in spark.table(layers.risk).collect()) == ["rio_negro", "santa_cruz"]
    assert spark.table(layers.climate).count() == 24


def test_first_write_wins(spark, layers, tmp_path):
    land(tmp_path, "f.json", payload("La Paz", ["2024-01-01"], "forecast", temperature_2m_max=[25.0]))
    stage_landing(spark, str(tmp_path), "s", layers)
    refresh_silver(spark, layers)
    land(tmp_path, "h.json", payload("La Paz", ["2024-01-01", "2024-01-02"], "historical"))
    stage_landing(spark, str(tmp_path), "s", layers)
    refresh_silver(spark, layers)
    rows = spark.table(layers.clean).orderBy("date").collect()
    assert [(str(r.date), r.temperature_2m_max) for r in rows] == [("2024-01-01", 25.0), ("2024-01-02", 30.0)]


def test_same_day_twice_in_one_run_is_kept_twice(spark, layers, tmp_path):
    land(tmp_path, "f.json", payload("La Paz", ["2024-01-01"], "forecast"))
    land(tmp_path, "h.json", payload("La Paz", ["2024-01-01"], "historical"))
    stage_landing(spark, str(tmp_path), "s", layers)
    refresh_silver(spark, layers)
    assert spark.table(layers.clean).count() == 2


def test_invalid_file_fails_before_any_write(spark, layers, tmp_path):
    land(tmp_path, "good.json", payload("La Paz", ["2024-01-01"]))
    land(tmp_path, "bad.json", json.dumps({"meta": {}}))
    with pytest.raises(PySparkException, match="bad.json"):
        stage_landing(spark, str(tmp_path), "s", layers, strict=True)
    create_silver(spark, layers)
    assert spark.table(layers.raw).isEmpty()


def test_invalid_files_are_logged_once_and_the_others_staged(spark, layers, tmp_path):
    land(tmp_path, "good.json", payload("La Paz", ["2024-01-01"]))
    land(tmp_path, "bad.json", json.dumps({"meta": {}}))
    for _ in range(2):
        stage_landing(spark, str(tmp_path), "s", layers)
    assert spark.table(layers.raw).count() == 1
    assert [(r.source_file_name, r.error) for r in spark.table(layers.landing_rejects).collect()] == [
        ("bad.json", "no object under data")
    ]


def test_dropped_documents_are_logged_and_stored(spark, layers, tmp_path):
    land(tmp_path / "in", "a.json", payload("La Paz", ["2024-01-01"]))
    land(tmp_path / "in", "b.json", payload("La Paz", ["2024-01-02"]))
    for _ in range(2):
        stage_landing(spark, str(tmp_path / "in"), "s", layers, bronze_root=str(tmp_path / "bronze"))
    assert spark.table(layers.raw).count() == 1
    (row,) = spark.table(layers.duplicates).collect()
    assert row.gcs_uri.endswith("b.json") and row.kept_uri.endswith("a.json") and row.kept_sha256 != row.payload_sha256
    stored = read_bronze(spark, str(tmp_path / "bronze")).collect()
    assert sorted(r.gcs_uri.rsplit("/", 1)[-1] for r in stored) == ["a.json", "b.json"]
    assert all(hashlib.sha256(r.content).hexdigest() == r.payload_sha256 for r in stored)


def test_only_folders_of_the_batch_are_read(spark, layers):
    create_silver(spark, layers)
    days = spark.range(4).selectExpr("'a' AS city_id", "make_date(2020 + id, 1, 1) AS date", "2020 + id AS year")
    table = spark.table(layers.clean)
    append(days.selectExpr(*[c if c in days.columns else f"CAST(NULL AS {t}) AS {c}" for c, t in table.dtypes]), layers.clean)
    batch = days.filter("year = 2022")
    target = within(spark.table(layers.clean), batch, "year", "date")
    plan = plan_of(unseen(batch, target, ("city_id", "date")))
    assert "2022" in plan[plan.index("PartitionFilters") :].split("\n")[0]
    assert len(target.inputFiles()) == 1 and unseen(days, target, ("city_id", "date")).count() == 3


def test_empty_input_and_dry_run(spark, layers, tmp_path):
    with pytest.raises(FileNotFoundError, match="nothing landed"):
        stage_landing(spark, str(tmp_path), "s", layers)
    assert stage_landing(spark, str(tmp_path), "s", layers, allow_empty=True).isEmpty()
    land(tmp_path, "a.json", payload("La Paz", ["2024-01-01"]))
    assert stage_landing(spark, str(tmp_path), "s", layers, dry_run=True).count() == 1
    assert spark.table(layers.raw).isEmpty()


def test_bronze_copy(spark, layers, tmp_path):
    land(tmp_path / "in", "a.json", payload("La Paz", ["2024-01-01"]))
    stage_landing(spark, str(tmp_path / "in"), "s", layers, bronze_root=str(tmp_path / "bronze"))
    assert read_bronze(spark, str(tmp_path / "bronze")).count() == 1


def test_failed_replace_keeps_the_old_table(spark, layers):
    spark.sql(f"CREATE DATABASE {layers.gold}")
    replace(spark.range(3), f"{layers.gold}.t")
    with pytest.raises(PySparkException):
        replace(spark.range(5).selectExpr("raise_error('stop') AS id"), f"{layers.gold}.t")
    assert spark.table(f"{layers.gold}.t").count() == 3
    replace(spark.range(4), f"{layers.gold}.t")
    assert spark.table(f"{layers.gold}.t").count() == 4


@pytest.mark.parametrize("step", ["CREATE OR REPLACE VIEW", "DROP TABLE", "ALTER TABLE"])
def test_a_crash_at_any_step_loses_nothing(spark, layers, monkeypatch, step):
    spark.sql(f"CREATE DATABASE {layers.gold}")
    name = f"{layers.gold}.t"
    spark.range(3).write.saveAsTable(name)  # a plain table, as earlier releases made it
    if step != "ALTER TABLE":
        replace(spark.range(4), name)
        replace(spark.range(4), name)
    run = type(spark).sql

    def crash(session, query, *args, **kwargs):
        if query.startswith(step):
            raise KeyboardInterrupt
        return run(session, query, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", crash)
        with pytest.raises(KeyboardInterrupt):
            replace(spark.range(5), name)
    left = {"CREATE OR REPLACE VIEW": 4, "DROP TABLE": 5, "ALTER TABLE": 3}[step]
    assert spark.table(name).count() == left
    with pytest.raises(PySparkException):
        replace(spark.range(5).selectExpr("raise_error('stop') AS id"), name)
    assert spark.table(name).count() == left
    replace(spark.range(6), name)
    assert spark.table(name).count() == 6 and len(versions(spark, name)) <= 3


def test_written_once_reads_one_snapshot_and_cleans_up(spark):
    with written_once(spark.range(5).selectExpr("id", "rand() AS r")) as rows:
        assert rows.exceptAll(rows).isEmpty() and rows.count() == 5
        name = rows.inputFiles()[0].split("/rows/")[0].rsplit("/", 1)[-1]
        assert spark.catalog.databaseExists(name)
    assert not spark.catalog.databaseExists(name)


def test_append_is_by_name(spark, layers):
    create_silver(spark, layers)
    table = spark.table(layers.rejects)
    row = spark.sql("SELECT 'x' AS quality_issue, 'a' AS city_id").selectExpr(
        *[c if c in ("quality_issue", "city_id") else f"CAST(NULL AS {t}) AS {c}" for c, t in reversed(table.dtypes)]
    )
    append(row, layers.rejects)
    got = spark.table(layers.rejects).first()
    assert (got.quality_issue, got.city_id, got.city_name) == ("x", "a", None)


def test_stream_reads_new_files_once(spark, layers, tmp_path):
    root, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    land(root, "a.json", payload("La Paz", ["2024-01-01", None]))
    land(root, "b.json", payload("Sucre", ["2024-01-01"]))
    landing_stream(spark, str(root), "s", checkpoint, layers, max_files=1).awaitTermination()
    assert counts(spark, layers) == {"raw": 2, "clean": 2, "rejects": 1}
    land(root, "c.json", payload("Sucre", ["2024-01-01", "2024-01-02"], day="2024-05-02"))
    query = landing_stream(spark, str(root), "s", checkpoint, layers)
    query.awaitTermination()
    assert counts(spark, layers) == {"raw": 3, "clean": 3, "rejects": 1}
    # A bad file is logged, and the stream goes on.
    land(root, "bad.json", "[]")
    landing_stream(spark, str(root), "s", checkpoint, layers).awaitTermination()
    spark.catalog.refreshTable(layers.landing_rejects)
    assert spark.table(layers.landing_rejects).count() == 1
    # A fresh checkpoint replays every file; the targets do not change.
    landing_stream(spark, str(root), "s", str(tmp_path / "again"), layers).awaitTermination()
    assert counts(spark, layers) == {"raw": 3, "clean": 3, "rejects": 1}
    refresh_silver(spark, layers, log_once=True)
    refresh_gold(spark, layers)
    assert spark.table(layers.clean).count() == 3 and spark.table(layers.climate).count() == 72


def test_stream_reads_what_write_landing_writes(spark, layers, tmp_path):
    def land_lines(*documents: dict) -> None:
        rows = [(json.dumps(d), d["meta"].get("city_id", "x"), "2024-05-01") for d in documents]
        envelopes = spark.createDataFrame(rows, "document string, city_id string, day string")
        write_landing(envelopes.selectExpr("document", "city_id", "date(day) AS extraction_date"), root)

    root, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    land_lines(payload("La Paz", ["2024-01-01", None]), payload("Sucre", ["2024-01-01"]), {"meta": {}})
    land(tmp_path / "in", "c.json", payload("Oruro", ["2024-01-01"]))
    landing_stream(spark, root, "s", checkpoint, layers, max_files=1).awaitTermination()
    assert counts(spark, layers) == {"raw": 3, "clean": 3, "rejects": 1}
    spark.catalog.refreshTable(layers.landing_rejects)
    assert [r.error for r in spark.table(layers.landing_rejects).collect()] == ["no object under data"]
    # Later runs read new files only; the batch finds nothing that the stream has missed.
    land_lines(payload("Tarija", ["2024-01-01"]))
    landing_stream(spark, root, "s", checkpoint, layers).awaitTermination()
    assert counts(spark, layers) == {"raw": 4, "clean": 4, "rejects": 1}
    stage_landing(spark, root, "s", layers)
    assert spark.table(layers.raw).count() == 4 and spark.table(layers.landing_rejects).count() == 1
