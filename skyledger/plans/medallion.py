"""Layer refreshes over catalog tables: landed files to staging, Silver and Gold."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.cities import configured_cities
from skyledger.operators.climate import climate_table, observed_months
from skyledger.operators.daily import parse_daily, typed_daily
from skyledger.operators.envelope import (
    dedup_staging,
    dropped_documents,
    envelope_fields,
    rejected,
    require_valid,
    staging_rows,
    valid,
)
from skyledger.operators.events import extreme_events
from skyledger.operators.incremental import (
    REJECT_KEYS,
    in_buckets,
    incremental_insert,
    new_rejects,
    of_buckets,
    within,
)
from skyledger.operators.invariants import Watched, climate_rules, event_rules, risk_rules
from skyledger.operators.moments import (
    STATE_COLUMNS,
    baseline_from_state,
    covers,
    merge_states,
    months_from_state,
    weather_state,
)
from skyledger.operators.quality import quarantine
from skyledger.operators.risk import daily_risk
from skyledger.sources.bronze import landed_bytes, load_cities, read_landing, write_bronze
from skyledger.sources.dimensions import cities_dim, weathercode_dim
from skyledger.sources.schemas import (
    DAILY_CLEAN_COLUMNS,
    DUPLICATE_COLUMNS,
    LANDING_REJECT_COLUMNS,
    QUARANTINE_COLUMNS,
    RAW_WEATHER_COLUMNS,
)
from skyledger.session import keep
from skyledger.sources.commits import BATCH_COLUMNS, Batch, committed, ensure_batched
from skyledger.sources.tables import ensure_database, ensure_table, in_ranges, replace, written_once


@dataclass(frozen=True)
class Layers:
    """Names of the databases and tables."""

    silver: str = "silver"
    gold: str = "gold"

    @property
    def raw(self) -> str:
        return f"{self.silver}.raw_weather_json"

    @property
    def clean(self) -> str:
        return f"{self.silver}.daily_weather_clean"

    @property
    def rejects(self) -> str:
        return f"{self.silver}.quarantine_log"

    @property
    def landing_rejects(self) -> str:
        return f"{self.silver}.landing_reject_log"

    @property
    def duplicates(self) -> str:
        return f"{self.silver}.duplicate_log"

    @property
    def state(self) -> str:
        return f"{self.silver}.weather_state"

    @property
    def batches(self) -> str:
        return f"{self.silver}.batches"

    @property
    def cities(self) -> str:
        return f"{self.silver}.cities_dim"

    @property
    def codes(self) -> str:
        return f"{self.silver}.weathercode_dim"

    @property
    def risk(self) -> str:
        return f"{self.gold}.daily_risk_index_by_city"

    @property
    def climate(self) -> str:
        return f"{self.gold}.climate_comparative_by_month"

    @property
    def events(self) -> str:
        return f"{self.gold}.extreme_events_catalog"


def _moment(run_at: datetime | None) -> Column:
    return F.current_timestamp() if run_at is None else F.lit(run_at).cast("timestamp")


def create_silver(spark: SparkSession, layers: Layers = Layers()) -> None:
    """Create the Silver tables that do not exist. The clean table is foldered by year."""
    ensure_database(spark, layers.silver)
    ensure_table(spark, layers.batches, BATCH_COLUMNS)
    ensure_batched(spark, layers.raw, RAW_WEATHER_COLUMNS, ("extraction_date",))
    ensure_batched(spark, layers.landing_rejects, {**LANDING_REJECT_COLUMNS, "bucket": "int"}, ("bucket",))
    ensure_batched(spark, layers.duplicates, {**DUPLICATE_COLUMNS, "bucket": "int"}, ("bucket",))
    ensure_batched(spark, layers.clean, DAILY_CLEAN_COLUMNS, ("year",))
    ensure_batched(spark, layers.rejects, {**QUARANTINE_COLUMNS, "bucket": "int"}, ("bucket",))
    ensure_batched(spark, layers.state, STATE_COLUMNS)


def stage_landing(
    spark: SparkSession,
    root: str,
    store_uri: str,
    layers: Layers = Layers(),
    *,
    prefix: str = "",
    run_at: datetime | None = None,
    allow_empty: bool = False,
    dry_run: bool = False,
    bronze_root: str | None = None,
    strict: bool = False,
    batch: Batch | None = None,
) -> DataFrame:
    """Validate all landed files and append the new ones to staging; returns the staged rows.

    Staging and both logs are one batch; with ``batch`` they are part of that one, which its owner
    commits.

    Invalid files are logged and left out; with ``strict`` the first one fails the run before a
    row is written. A dry run validates as it is read and returns its rows unwritten. Documents
    that share an insert id with the kept one are logged with both checksums. ``bronze_root``
    keeps the landed bytes of all valid files, dropped ones included; it is written after staging,
    and a rerun that stores a document again is read once.
    """
    files = read_landing(spark, root)
    if not allow_empty and files.select("path").isEmpty():
        raise FileNotFoundError(f"nothing landed below {root}")
    checked, moment = envelope_fields(files), _moment(run_at)
    good = require_valid(checked) if strict else valid(checked)
    if dry_run:
        return staging_rows(good, store_uri, prefix, moment)
    create_silver(spark, layers)
    if batch is None:
        with Batch(spark, layers.batches) as own:
            _stage(spark, root, layers, own, good, checked, moment, store_uri, prefix, bronze_root, strict)
        return spark.table(layers.raw)
    _stage(spark, root, layers, batch, good, checked, moment, store_uri, prefix, bronze_root, strict)
    return batch.visible(layers.raw)


def _stage(
    spark: SparkSession,
    root: str,
    layers: Layers,
    batch: Batch,
    good: DataFrame,
    checked: DataFrame,
    moment: Column,
    store_uri: str,
    prefix: str,
    bronze_root: str | None,
    strict: bool,
) -> None:
    with written_once(staging_rows(good, store_uri, prefix, moment, with_path=True)) as rows:
        staged = within(batch.visible(layers.raw), rows, "extraction_date", "extraction_date")
        batch.add(dedup_staging(rows.drop("path"), staged), layers.raw, ("extraction_date",))
        log_new(dropped_documents(rows, moment), layers.duplicates, ("gcs_uri", "payload_sha256"), batch)
        if not strict:
            log_new(rejected(checked, moment), layers.landing_rejects, ("path", "payload_sha256"), batch)
        if bronze_root is not None:
            named = rows.select("path", "gcs_uri", "payload_sha256", "source_type", "city_id", "extraction_date")
            write_bronze(named.join(landed_bytes(spark, root), "path"), bronze_root)


def log_new(rows: DataFrame, name: str, keys: tuple[str, ...], batch: Batch) -> None:
    """Add log rows whose keys the log does not hold yet. NULL equals NULL here."""
    with written_once(in_buckets(rows, keys)) as found:
        _add_log(new_rejects(found, of_buckets(batch.visible(name), found), keys), name, batch)


def _add_log(rows: DataFrame, name: str, batch: Batch) -> None:
    if "bucket" in batch.spark.table(name).columns:
        batch.add(rows, name, ("bucket",))
    else:  # a log of earlier releases, in one folder
        batch.add(rows, name)


def refresh_silver(
    spark: SparkSession,
    layers: Layers = Layers(),
    *,
    run_at: datetime | None = None,
    log_once: bool = False,
    batch: Batch | None = None,
    cities: str | None = None,
) -> None:
    """Rebuild the dimensions, then insert accepted unseen rows and log the rejects.

    The whole staging table is parsed, once. Rejects are logged again on every run unless
    ``log_once`` is set. ``cities`` is the path of a city configuration; without one the dimension has
    the built-in cities. All appends are one batch, or part of ``batch``, whose owner commits it.
    """
    create_silver(spark, layers)
    if batch is None:
        with Batch(spark, layers.batches) as own:
            refresh_silver(spark, layers, run_at=run_at, log_once=log_once, batch=own, cities=cities)
        return
    replace(cities_dim(spark) if cities is None else configured_cities(load_cities(spark, cities)), layers.cities)
    replace(weathercode_dim(spark), layers.codes)
    parsed = typed_daily(parse_daily(batch.visible(layers.raw)))
    insert_parsed(parsed, layers, batch, run_at=run_at, log_once=log_once)


def insert_parsed(
    parsed: DataFrame,
    layers: Layers,
    batch: Batch,
    *,
    run_at: datetime | None = None,
    log_once: bool = False,
) -> None:
    """Write parsed rows once, then add to the batch the accepted ones, the rejects, and what the
    accepted ones add to the moments that Gold's baselines are made of."""
    moment = _moment(run_at)
    with written_once(parsed) as rows:
        target = within(batch.visible(layers.clean), rows, "year", "date")
        new = incremental_insert(rows, target).withColumn("loaded_at_utc", moment)
        fresh = batch.add(new, layers.clean, ("year",))
        batch.add(weather_state(fresh), layers.state)
        rejects = quarantine(rows, rejected_at=moment)
        if log_once:
            log_new(rejects, layers.rejects, REJECT_KEYS, batch)
        else:
            _add_log(in_buckets(rejects, REJECT_KEYS), layers.rejects, batch)


def current_state(spark: SparkSession, layers: Layers = Layers()) -> DataFrame | None:
    """The merged moments of all committed inserts; None unless they cover all rows of the table.

    They do not where rows were written otherwise, as by releases that kept no moments.
    """
    parts = committed(spark, layers.state, layers.batches).select(*STATE_COLUMNS)
    state = keep(merge_states([parts]))  # a row for each city and month
    return state if covers(state, committed(spark, layers.clean, layers.batches)) else None


def refresh_gold(spark: SparkSession, layers: Layers = Layers(), *, run_at: datetime | None = None) -> None:
    """Rebuild the three Gold tables from Silver, independently of each other.

    Baselines and months come from the moments that inserts kept, where these cover all rows. Each
    table is published only if no row of it breaks a rule (``invariants``), which is counted while it
    is written; else the old one stays and the run fails.
    """
    ensure_database(spark, layers.gold)
    clean, cities = committed(spark, layers.clean, layers.batches), spark.table(layers.cities)
    moment = _moment(run_at)
    state = current_state(spark, layers)
    baseline = None if state is None else baseline_from_state(state)
    months = observed_months(clean) if state is None else months_from_state(state)
    risk = daily_risk(clean, cities, baseline=baseline).withColumn("year", F.year("date"))
    risk = Watched(risk.hint("rebalance", "year"), "daily_risk", risk_rules())
    replace(risk.rows, layers.risk, sort_by=("date",), partition_by=("year",), gate=risk.check)
    climate = Watched(climate_table(months, cities, generated_at=moment), "climate_monthly", climate_rules())
    replace(climate.rows, layers.climate, gate=climate.check)
    # A range partitioning samples its input first, so what is observed goes above it.
    events = extreme_events(clean, generated_at=moment).withColumn("year", F.year("date"))
    order = ("date", "city_name", "event_type")
    events = Watched(in_ranges(events, ("year",), order), "extreme_events", event_rules())
    replace(events.rows, layers.events, sort_by=order, partition_by=("year",), gate=events.check)


def run_all(
    spark: SparkSession,
    root: str,
    store_uri: str,
    layers: Layers = Layers(),
    *,
    run_at: datetime | None = None,
    cities: str | None = None,
) -> None:
    """Landed files to Gold. Staging, Silver and all logs are one batch, there whole or not at all."""
    create_silver(spark, layers)
    with Batch(spark, layers.batches) as batch:
        stage_landing(spark, root, store_uri, layers, run_at=run_at, batch=batch)
        refresh_silver(spark, layers, run_at=run_at, batch=batch, cities=cities)
    refresh_gold(spark, layers, run_at=run_at)
