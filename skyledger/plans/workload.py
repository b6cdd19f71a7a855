"""The checked workload: one query per operator, each over whole given tables.

Dates and timestamps are shown as ISO text, which any two engines print alike. Run timestamps are
left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.jsontext import json_scalar, member
from skyledger.functions.labels import city_key
from skyledger.functions.numeric import clamp, round2
from skyledger.operators.cities import configured_cities
from skyledger.operators.climate import climate_monthly, month_calendar
from skyledger.operators.daily import parse_daily, typed_daily
from skyledger.operators.envelope import (
    dedup_staging,
    envelope_fields,
    record_count,
    rejected,
    require_valid,
    response_error,
    staging_rows,
)
from skyledger.operators.events import FROST, HEAT_WAVE, HEAVY_RAIN, HIGH_WIND, STORM, Detector, extreme_events, in_report_order
from skyledger.operators.incremental import SILVER_KEYS, incremental_insert
from skyledger.operators.invariants import (
    REPORT_SCHEMA,
    Watched,
    climate_rules,
    event_rules,
    invariants,
    risk_rules,
    silver_rules,
)
from skyledger.operators.joins import lookup_join
from skyledger.operators.moments import baseline_from_state, merge_states, months_from_state, weather_state
from skyledger.operators.quality import accept, quarantine
from skyledger.operators.risk import daily_risk, risk_base, risk_level_counts, temp_baseline
from skyledger.plans import fixture
from skyledger.session import keep, shared_dir
from skyledger.sources.bronze import bronze_path, file_columns, load_cities, read_bronze, read_landing, write_bronze, write_landing
from skyledger.sources.dimensions import CITIES, cities_dim, weathercode_dim
from skyledger.sources.schemas import DAILY_CLEAN_COLUMNS, DAILY_VARIABLES
from skyledger.sources.tables import append_bucketed, ensure_bucketed

#: Buckets of the stored keys in ``backfill_insert``; a large history takes a few thousand.
HISTORY_BUCKETS = 16

Query = Callable[[SparkSession, str], DataFrame]


def _iso(column: str) -> Column:
    return F.col(column).cast("string").alias(column)


def _iso_utc(column: str) -> Column:
    in_utc = F.to_utc_timestamp(column, F.current_timezone())
    return F.date_format(in_utc, "yyyy-MM-dd HH:mm:ss")


def _with_iso_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("date", _iso("date"))


def _accepted(spark: SparkSession, sf: str) -> DataFrame:
    return accept(fixture.typed_observations(spark, sf))


def _risk(spark: SparkSession, sf: str) -> DataFrame:
    return daily_risk(_accepted(spark, sf), cities_dim(spark), dim_rows=len(CITIES))


def q_daily_risk(spark: SparkSession, sf: str) -> DataFrame:
    return _with_iso_date(_risk(spark, sf))


def q_risk_base(spark: SparkSession, sf: str) -> DataFrame:
    base = risk_base(_accepted(spark, sf), cities_dim(spark), dim_rows=len(CITIES))
    return _with_iso_date(base).withColumn("temperature_reference_c", round2(F.col("temperature_reference_c")))


def q_temp_baseline(spark: SparkSession, sf: str) -> DataFrame:
    base = risk_base(_accepted(spark, sf), cities_dim(spark), dim_rows=len(CITIES))
    return temp_baseline(base).select(
        "city_id",
        round2(F.col("baseline_avg")).alias("baseline_avg"),
        round2(F.col("baseline_std")).alias("baseline_std"),
    )


def q_risk_baseline_state(spark: SparkSession, sf: str) -> DataFrame:
    """Baselines and months of a state that three inserts added to, each without the rows before it."""
    rows = _accepted(spark, sf).select("obs_id", "city_id", "date", *DAILY_VARIABLES)
    state = None
    for part in range(3):
        added = weather_state(rows.filter(F.col("obs_id") % 3 == part))
        state = keep(added if state is None else merge_states([state, added]))
    known = state.join(cities_dim(spark).select("city_id"), "city_id", "left_semi")
    months = months_from_state(known)
    risk = baseline_from_state(known)
    return months.join(risk, "city_id").select(
        "city_id",
        "month_number",
        "days",
        round2(F.col("rain_mm")).alias("avg_rain"),
        round2(F.col("mid_std")).alias("variability"),
        round2(F.col("baseline_avg")).alias("baseline_avg"),
        round2(F.col("baseline_std")).alias("baseline_std"),
    )


def q_temp_ladder(spark: SparkSession, sf: str) -> DataFrame:
    """Risk per station. Stations with one row have no deviation and take the step score."""
    return _with_iso_date(daily_risk(_accepted(spark, sf), entity="station_id"))


def q_risk_level_dist(spark: SparkSession, sf: str) -> DataFrame:
    return risk_level_counts(_risk(spark, sf))


def q_clamp_score(spark: SparkSession, sf: str) -> DataFrame:
    price = F.when(F.col("l_linenumber") % 4 != 3, F.col("l_extendedprice") / 500.0 - 20.0)
    return fixture.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", clamp(price).alias("score")
    )


def q_round2(spark: SparkSession, sf: str) -> DataFrame:
    sign = F.when(F.col("l_returnflag") == "R", -1.0).otherwise(1.0)
    net = F.col("l_extendedprice") * (1.0 - F.col("l_discount")) * (1.0 + F.col("l_tax")) * sign / 8.0
    return fixture.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", round2(net).alias("net")
    )


def q_silver_accept(spark: SparkSession, sf: str) -> DataFrame:
    rows = _accepted(spark, sf)
    return rows.select("obs_id", "city_id", "city_name", _iso("date"), *DAILY_VARIABLES, "year", "month", "season")


def q_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return quarantine(fixture.typed_observations(spark, sf)).select(
        "city_id", "city_name", _iso("date"), "quality_issue", "payload_source"
    )


def q_silver_incremental(spark: SparkSession, sf: str) -> DataFrame:
    batch = fixture.typed_observations(spark, sf)
    existing = accept(batch).filter("obs_id % 4 = 0")
    return incremental_insert(batch, existing).select("obs_id", "city_id", _iso("date"), *DAILY_VARIABLES)


def q_backfill_insert(spark: SparkSession, sf: str) -> DataFrame:
    """A batch of all years against a history whose keys lie in buckets: only the batch is shuffled."""
    batch = fixture.typed_observations(spark, sf)
    name = f"history_{uuid.uuid4().hex}"
    kinds = {key: DAILY_CLEAN_COLUMNS[key] for key in SILVER_KEYS}
    ensure_bucketed(spark, name, kinds, SILVER_KEYS, HISTORY_BUCKETS, _folder(spark, "history"))
    history = accept(batch).filter("obs_id % 4 = 1")
    append_bucketed(history.select(*SILVER_KEYS), name, SILVER_KEYS, HISTORY_BUCKETS)
    new = incremental_insert(batch, spark.table(name))
    return new.select("obs_id", "city_id", _iso("date"), *DAILY_VARIABLES)


def _stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written once, as a layer's table is, and read back."""
    path = _folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def q_dq_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """One pass over each stored layer: nothing is computed again to be counted."""
    typed = _stored(fixture.typed_observations(spark, sf), "typed")
    clean = accept(typed)
    risk = daily_risk(clean, cities_dim(spark), dim_rows=len(CITIES))
    return invariants(
        typed,
        _stored(risk, "risk"),
        _stored(climate_monthly(clean, cities_dim(spark)), "climate"),
        _stored(extreme_events(clean), "events"),
    )


def q_dq_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Violations as they are observed while each layer is written; the tables are read by nobody."""
    typed = Watched(fixture.typed_observations(spark, sf), "silver", silver_rules())
    clean = accept(_stored(typed.rows, "typed"))
    layers = [
        Watched(daily_risk(clean, cities_dim(spark), dim_rows=len(CITIES)), "daily_risk", risk_rules()),
        Watched(climate_monthly(clean, cities_dim(spark)), "climate_monthly", climate_rules()),
        Watched(extreme_events(clean), "extreme_events", event_rules()),
    ]
    for layer in layers:
        _stored(layer.rows, layer.name)
    found = [line for layer in (typed, *layers) for line in layer.report()]
    return spark.createDataFrame(found, REPORT_SCHEMA)  # a line for each rule


def q_month_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar rows with the number of dated observations of their city and month."""
    dated = fixture.typed_observations(spark, sf).filter("date IS NOT NULL")
    days = dated.groupBy("city_id", F.col("month").alias("month_number")).agg(F.count("*").alias("days"))
    calendar = month_calendar(cities_dim(spark))
    return calendar.join(days, ["city_id", "month_number"], "left").fillna({"days": 0})


def q_climate_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return climate_monthly(_accepted(spark, sf), cities_dim(spark)).drop("generated_at")


def q_extreme_events(spark: SparkSession, sf: str) -> DataFrame:
    events = extreme_events(_accepted(spark, sf)).drop("generated_at")
    return _with_iso_date(in_report_order(events))


def _detector_query(detector: Detector) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _with_iso_date(extreme_events(_accepted(spark, sf), [detector]).drop("generated_at"))

    return run


def q_cities_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted observations by the attributes of their city."""
    rows = _accepted(spark, sf).select("city_id")
    joined = lookup_join(rows, cities_dim(spark), ["city_id"], lookup_rows=len(CITIES))
    return joined.groupBy(*cities_dim(spark).columns).agg(F.count("*").alias("days"))


def q_cities_config(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension of a written configuration that has a city for each nation."""
    city = F.struct(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"),
        F.col("n_name").alias("name"),
        (F.col("n_nationkey") / 2.0).alias("lat"),
        (F.col("n_regionkey") * -1.5).alias("lon"),
        (F.col("n_nationkey") * 10).alias("elevation_m"),
    )
    nations = fixture.table(spark, sf, "nation").agg(F.collect_list(city).alias("cities"))
    folder = _folder(spark, "config")
    nations.select(F.to_json(F.struct("cities")).alias("value")).coalesce(1).write.text(folder)
    return configured_cities(load_cities(spark, folder))


def q_weathercode_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Observations by weather code: codes without a description and codes never seen are kept."""
    days = fixture.observations(spark, sf).groupBy("weathercode").agg(F.count("*").alias("days"))
    joined = days.join(weathercode_dim(spark), "weathercode", "full")
    return joined.select("weathercode", "weather_description", F.coalesce("days", F.lit(0)).cast("bigint").alias("days"))


def q_city_key(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.observations(spark, sf).select(
        "obs_id", "city_name", city_key(F.col("city_name")).alias("city_id")
    )


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    """Staging rows of the landed documents, which are stored as any landing is."""
    landed = _stored(fixture.landed(spark, sf), "landed")
    return staging_rows(require_valid(envelope_fields(landed)), fixture.STORE_URI)


def q_parse_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rows of a stored staging table, whose payloads are parsed once."""
    parsed = parse_daily(_stored(_staged(spark, sf), "staged"))
    return parsed.select("city_id", "city_name", _iso("date"), *DAILY_VARIABLES, "payload_source")


def q_typed_daily(spark: SparkSession, sf: str) -> DataFrame:
    typed = typed_daily(parse_daily(_stored(_staged(spark, sf), "staged")))
    stamp = _iso_utc("extraction_timestamp_utc").alias("extracted_at")
    return typed.select("city_id", _iso("date"), "year", "month", "season", *DAILY_VARIABLES, stamp)


def q_json_scalar(spark: SparkSession, sf: str) -> DataFrame:
    props = F.col("props")
    draft = F.concat(F.lit(',"tags":["a"],"none":null,"draft":"['), F.col("event_id").cast("string"))
    nested = F.concat(F.lit('{"outer":'), props, draft, F.lit('] x","brace":"{z}"}'))
    return fixture.table(spark, sf, "events").select(
        "event_id",
        json_scalar(props, "$.k").alias("k"),
        json_scalar(nested, "$.outer.k").alias("outer_k"),
        json_scalar(nested, "$.outer").alias("object_value"),
        json_scalar(nested, "$.tags").alias("array_value"),
        json_scalar(nested, "$.none").alias("null_value"),
        json_scalar(nested, "$.draft").alias("draft"),
        json_scalar(nested, "$.brace").alias("brace"),
    )


def q_envelope_build(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.envelopes(spark, sf).select("doc_id", "city_id", "source_type", "document")


def q_envelope_validate(spark: SparkSession, sf: str) -> DataFrame:
    return envelope_fields(fixture.spoiled_envelopes(spark, sf)).select("doc_id", "error")


def _loose(spark: SparkSession, sf: str) -> DataFrame:
    files = fixture.loosely_written_envelopes(spark, sf).select(
        "doc_id",
        F.col("doc_id").cast("string").alias("path"),
        F.col("doc_id").cast("string").alias("source_file_name"),
        F.sha2(F.col("document").cast("binary"), 256).alias("payload_sha256"),
        "document",
    )
    return envelope_fields(files)


def q_envelope_strict(spark: SparkSession, sf: str) -> DataFrame:
    """What a strict reader makes of documents that a lenient one takes for something else."""
    city = F.when(F.col("error").isNull(), F.coalesce(member(F.col("meta"), "city_id"), F.lit("None")))
    return _loose(spark, sf).select("doc_id", "error", city.alias("city_id"), "records")


def q_envelope_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return rejected(_loose(spark, sf)).select("payload_sha256", "error")


def _folder(spark: SparkSession, name: str) -> str:
    """A folder for one layer of one query. Results read it lazily; ``drop_stored`` clears up."""
    return f"{_workload_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _workload_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/workload-{spark.sparkContext.applicationId}"


def drop_stored(spark: SparkSession) -> None:
    """Delete the layers that this application's queries stored, once their results are read."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_workload_dir(spark))
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def q_landing_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """All envelopes landed as files and read back."""
    root = _folder(spark, "landing")
    write_landing(fixture.envelopes(spark, sf), root)
    read = envelope_fields(read_landing(spark, root))
    return read.select("payload_sha256", F.length("document").cast("bigint").alias("chars"), "error")


def q_bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The bytes of all staged documents stored twice, as a rerun does, and read back by uri."""
    root = _folder(spark, "bronze")
    files = _staged(spark, sf).withColumn("content", F.col("payload").cast("binary"))
    for _ in range(2):
        write_bronze(files, root)
    stored = read_bronze(spark, root)
    intact = F.sha2("content", 256) == F.col("payload_sha256")
    return stored.select("gcs_uri", "payload_sha256", F.octet_length("content").cast("bigint").alias("bytes"), intact.alias("intact"))


def q_payload_validate(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.spoiled_responses(spark, sf).select("doc_id", response_error(F.col("response")).alias("error"))


def q_record_count(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture.spoiled_responses(spark, sf)
    return rows.select("doc_id", record_count(F.col("response")).alias("records"))


def q_bronze_path(spark: SparkSession, sf: str) -> DataFrame:
    date = F.date_format("extraction_date", "yyyy-MM-dd")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".json"))
    path = bronze_path(F.col("source_type"), F.coalesce("city_id", F.lit("None")), date, name, "/raw/weather/")
    return fixture.responses(spark, sf).select("doc_id", path.alias("path"))


def q_raw_stage(spark: SparkSession, sf: str) -> DataFrame:
    return _staged(spark, sf).select(
        "source_type",
        "city_id",
        "city_name",
        _iso("extraction_date"),
        _iso_utc("extraction_timestamp_utc").alias("extracted_at"),
        "record_count",
        "gcs_uri",
        "source_file_name",
        "payload_sha256",
        F.sha2("payload", 256).alias("staged_sha256"),
    )


def q_raw_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Staging of all documents where the second day's extraction is staged already.

    The batch is read several times, so it is computed once, as the staging refresh does.
    """
    batch = keep(_staged(spark, sf))
    existing = batch.filter(F.col("extraction_date") == F.lit("2024-01-02").cast("date"))
    kept = dedup_staging(batch, existing)
    return kept.select("city_id", "source_type", _iso("extraction_date"), "gcs_uri", "record_count")


def q_payload_sha(spark: SparkSession, sf: str) -> DataFrame:
    """Checksums of texts as a scan of files gives them, byte for byte."""
    files = fixture.table(spark, sf, "documents").select(
        F.concat_ws("/", F.lit("in"), F.col("doc_id").cast("string")).alias("path"), F.encode("text", "utf-8").alias("content")
    )
    scanned = file_columns(files)
    return scanned.select(F.col("source_file_name").cast("bigint").alias("doc_id"), F.col("payload_sha256").alias("sha256"))


QUERIES: dict[str, Query] = {
    "daily_risk": q_daily_risk,
    "risk_base": q_risk_base,
    "temp_baseline": q_temp_baseline,
    "risk_baseline_state": q_risk_baseline_state,
    "temp_ladder": q_temp_ladder,
    "clamp_score": q_clamp_score,
    "round2": q_round2,
    "risk_level_dist": q_risk_level_dist,
    "silver_accept": q_silver_accept,
    "quarantine": q_quarantine,
    "silver_incremental": q_silver_incremental,
    "backfill_insert": q_backfill_insert,
    "dq_invariants": q_dq_invariants,
    "dq_gate": q_dq_gate,
    "month_calendar": q_month_calendar,
    "climate_monthly": q_climate_monthly,
    "extreme_events": q_extreme_events,
    "event_heat_wave": _detector_query(HEAT_WAVE),
    "event_frost": _detector_query(FROST),
    "event_heavy_rain": _detector_query(HEAVY_RAIN),
    "event_high_wind": _detector_query(HIGH_WIND),
    "event_storm": _detector_query(STORM),
    "cities_dim": q_cities_dim,
    "cities_config": q_cities_config,
    "weathercode_dim": q_weathercode_dim,
    "city_key": q_city_key,
    "typed_daily": q_typed_daily,
    "parse_daily": q_parse_daily,
    "json_scalar": q_json_scalar,
    "envelope_build": q_envelope_build,
    "envelope_validate": q_envelope_validate,
    "envelope_strict": q_envelope_strict,
    "envelope_rejects": q_envelope_rejects,
    "landing_roundtrip": q_landing_roundtrip,
    "bronze_roundtrip": q_bronze_roundtrip,
    "payload_validate": q_payload_validate,
    "record_count": q_record_count,
    "bronze_path": q_bronze_path,
    "raw_stage": q_raw_stage,
    "raw_dedup": q_raw_dedup,
    "payload_sha": q_payload_sha,
}
