"""The workload as SQL for an independent engine, over the same tables.

Written from the table definitions, not from the DataFrame code: scores with window functions,
events from a threshold table, documents with list aggregates.
"""

from __future__ import annotations

from skyledger.plans.fixture import OBS_SQL
from skyledger.sources.schemas import DAILY_VARIABLES, DOUBLE_VARIABLES

_OBS = OBS_SQL.replace("{orders}", "orders")


def _r2(value: str) -> str:
    """Half away from zero to two decimals, in double arithmetic."""
    return (
        f"(CASE WHEN ({value}) >= 0 THEN floor(({value}) * 100 + CAST(0.5 AS DOUBLE)) / 100 "
        f"ELSE -floor(-({value}) * 100 + CAST(0.5 AS DOUBLE)) / 100 END + CAST(0 AS DOUBLE))"
    )


def _clamped(value: str) -> str:
    return f"(CASE WHEN ({value}) IS NOT NULL THEN least(CAST(100 AS DOUBLE), greatest(CAST(0 AS DOUBLE), {value})) END)"


def _values(rows: list[tuple]) -> str:
    def literal(item: object) -> str:
        return f"CAST({item} AS DOUBLE)" if isinstance(item, float) else repr(item)

    return ", ".join("(" + ", ".join(literal(item) for item in row) + ")" for row in rows)


# The city dimension, stated here once more so that a wrong literal shows.
_CITIES = """
SELECT * FROM (VALUES
  ('santa_cruz', 'Santa Cruz de la Sierra', CAST(-17.7833 AS DOUBLE), CAST(-63.1833 AS DOUBLE), 416, 'Santa Cruz', 'Lowlands'),
  ('la_paz', 'La Paz', -16.5, -68.15, 3640, 'La Paz', 'Altiplano'),
  ('cochabamba', 'Cochabamba', -17.3895, -66.1568, 2558, 'Cochabamba', 'Valleys'),
  ('sucre', 'Sucre', -19.0431, -65.2591, 2810, 'Chuquisaca', 'Valleys'),
  ('oruro', 'Oruro', -17.9833, -67.15, 3706, 'Oruro', 'Altiplano'),
  ('tarija', 'Tarija', -21.5353, -64.7298, 1866, 'Tarija', 'Valleys')
) v(city_id, city_name, latitude, longitude, elevation_m, department, region)"""
# Weather code descriptions.
_CODES = """
SELECT * FROM (VALUES (0, 'Clear sky'), (1, 'Mainly clear'), (2, 'Partly cloudy'), (3, 'Overcast'), (45, 'Fog'),
  (48, 'Depositing rime fog'), (51, 'Light drizzle'), (53, 'Moderate drizzle'), (55, 'Dense drizzle'),
  (61, 'Slight rain'), (63, 'Moderate rain'), (65, 'Heavy rain'), (71, 'Slight snow fall'),
  (73, 'Moderate snow fall'), (75, 'Heavy snow fall'), (80, 'Slight rain showers'), (81, 'Moderate rain showers'),
  (82, 'Violent rain showers'), (95, 'Thunderstorm'), (96, 'Thunderstorm with slight hail'),
  (99, 'Thunderstorm with heavy hail')) v(weathercode, weather_description)"""
_SEASON = (
    "CASE WHEN date IS NULL THEN 'Unknown' "
    "ELSE list_extract(['Summer', 'Autumn', 'Winter', 'Spring'], (month(date) % 12) // 3 + 1) END"
)
_MEASURES = ", ".join(DAILY_VARIABLES)

# obs -> typed (all rows with a city key) -> clean (accepted rows)
_TYPED = f"""
WITH obs AS ({_OBS}),
cities AS ({_CITIES}),
typed AS (
  SELECT o.obs_id, o.station_id, o.source_type, o.chunk,
    coalesce(c.city_id, lower(replace(o.city_name, ' ', '_'))) AS city_id,
    o.city_name, o.date, {", ".join("o." + name for name in DAILY_VARIABLES)},
    CAST(year(o.date) AS BIGINT) AS year, CAST(month(o.date) AS BIGINT) AS month, {_SEASON} AS season
  FROM obs o LEFT JOIN cities c ON lower(c.city_name) = lower(o.city_name)
),
clean AS (
  SELECT * FROM typed
  WHERE city_id IS NOT NULL AND date IS NOT NULL AND temperature_2m_max IS NOT NULL
    AND temperature_2m_min <= temperature_2m_max AND precipitation_sum >= 0
    AND (windspeed_10m_max IS NULL OR windspeed_10m_max >= 0)
)"""

# Documents print their measures with two decimals.
_PRINTED = ", ".join(f"{_r2(name)} AS {name}" for name in DOUBLE_VARIABLES)

_DAY = "strftime(date, '%Y-%m-%d') AS date"

# Score steps on absolute temperature.
_STEPS = (
    "CASE WHEN temperature_2m_max >= 37 OR temperature_2m_min <= 2 THEN 100 "
    "WHEN temperature_2m_max >= 34 OR temperature_2m_min <= 5 THEN 75 "
    "WHEN temperature_2m_max >= 30 OR temperature_2m_min <= 8 THEN 50 ELSE 10 END"
)


def _risk(entity: str) -> str:
    """CTEs up to ``risk``, with the baseline as a window."""
    if entity == "city_id":
        source = "SELECT w.* EXCLUDE (city_name), c.city_name FROM clean w JOIN cities c ON c.city_id = w.city_id"
    else:
        source = "SELECT * FROM clean"
    deviation = "abs(ref - avg_ref) / std_ref * 25"
    temp = f"CASE WHEN coalesce(std_ref, 0) = 0 THEN CAST({_STEPS} AS DOUBLE) ELSE {deviation} END"
    weighted = (
        "t * CAST(0.40 AS DOUBLE) + p * CAST(0.35 AS DOUBLE) + w * CAST(0.25 AS DOUBLE)"
    )
    return f"""{_TYPED},
base AS (
  SELECT *, coalesce(temperature_2m_mean, (temperature_2m_max + temperature_2m_min) / 2) AS ref FROM ({source}) s
),
framed AS (
  SELECT *, avg(ref) OVER (PARTITION BY {entity}) AS avg_ref, stddev_pop(ref) OVER (PARTITION BY {entity}) AS std_ref
  FROM base
),
raw_scores AS (
  SELECT {entity}, city_name, date, {_clamped(temp)} AS t0,
    {_clamped("precipitation_sum / 50 * 100")} AS p0, {_clamped("windspeed_10m_max / 60 * 100")} AS w0
  FROM framed
),
scores AS (SELECT {entity}, city_name, date, {_r2("t0")} AS t, {_r2("p0")} AS p, {_r2("w0")} AS w FROM raw_scores),
combined AS (SELECT *, {_r2(weighted)} AS total FROM scores),
risk AS (
  SELECT {entity}, city_name, date, t AS temp_risk_score, p AS precip_risk_score, w AS wind_risk_score,
    total AS composite_risk_score,
    CASE WHEN total IS NULL OR total > 75 THEN 'CRITICAL' WHEN total > 50 THEN 'HIGH'
      WHEN total > 25 THEN 'MODERATE' ELSE 'LOW' END AS risk_level
  FROM combined
)"""


_SCORES = "temp_risk_score, precip_risk_score, wind_risk_score, composite_risk_score, risk_level"

_MONTHS = """
months AS (
  SELECT CAST(m AS BIGINT) AS month_number,
    list_extract(['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', 'Septiembre',
      'Octubre', 'Noviembre', 'Diciembre'], m) AS month_name,
    list_extract(['Verano', 'Otono', 'Invierno', 'Primavera'], (m % 12) // 3 + 1) AS season
  FROM (SELECT unnest(range(1, 13)) AS m)
)"""

_CLIMATE = f"""{_MONTHS},
climate AS (
  SELECT c.city_id, c.city_name, m.month_number, m.month_name, m.season,
    {_r2("avg(w.temperature_2m_max)")} AS avg_temp_max,
    {_r2("avg(w.temperature_2m_min)")} AS avg_temp_min,
    {_r2("avg(w.precipitation_sum)")} AS avg_precipitation,
    {_r2("avg(w.windspeed_10m_max)")} AS avg_windspeed,
    {_r2("stddev_pop((w.temperature_2m_max + w.temperature_2m_min) / 2)")} AS climate_variability_index,
    count(w.date) AS observed_days,
    CASE WHEN count(w.date) >= 15 THEN 'OBSERVED' WHEN count(w.date) > 0 THEN 'PARTIAL_MONTH'
      ELSE 'NO_OBSERVATIONS' END AS data_completeness_status
  FROM cities c JOIN months m ON TRUE
  LEFT JOIN (SELECT * FROM clean WHERE windspeed_10m_max IS NOT NULL) w
    ON w.city_id = c.city_id AND w.month = m.month_number
  GROUP BY ALL
)"""

# Type, measure, direction (1 above, -1 below), threshold, severe and extreme bounds.
_DETECTORS = (
    ("HEAT_WAVE", "temperature_2m_max", 1, 37.0, 40.0, 42.0),
    ("FROST", "temperature_2m_min", -1, 2.0, 0.0, -5.0),
    ("HEAVY_RAIN", "precipitation_sum", 1, 50.0, 75.0, 100.0),
    ("HIGH_WIND", "windspeed_10m_max", 1, 60.0, 75.0, 90.0),
    ("STORM", "weathercode", 1, 95.0, 96.0, 99.0),
)

_EVENTS = f"""
valid AS (SELECT * FROM clean WHERE windspeed_10m_max IS NOT NULL AND weathercode IS NOT NULL),
measures AS (
  UNPIVOT (SELECT obs_id, city_id, city_name, date, year, month, temperature_2m_max, temperature_2m_min,
    precipitation_sum, windspeed_10m_max, CAST(weathercode AS DOUBLE) AS weathercode FROM valid)
  ON temperature_2m_max, temperature_2m_min, precipitation_sum, windspeed_10m_max, weathercode
  INTO NAME measure VALUE observed
),
detectors AS (
  SELECT * FROM (VALUES {_values(list(_DETECTORS))}) v(event_type, measure, way, threshold, severe, extreme)
),
events AS (
  SELECT m.city_id, m.city_name, m.date, d.event_type,
    CASE WHEN way * (observed - extreme) >= 0 THEN 'EXTREME' WHEN way * (observed - severe) >= 0 THEN 'SEVERE'
      ELSE 'MODERATE' END AS event_severity,
    observed AS observed_value, threshold AS threshold_value,
    {_r2("way * (observed - threshold) / nullif(threshold, 0) * 100")} AS exceedance_pct, m.year, m.month
  FROM measures m JOIN detectors d USING (measure)
  WHERE way * (observed - threshold) > 0 OR (event_type = 'STORM' AND observed = threshold)
)"""

_EVENT_COLUMNS = f"""city_id, city_name, {_DAY}, event_type, event_severity, observed_value, threshold_value,
  exceedance_pct, year, month"""


def _event_query(event_type: str | None = None) -> str:
    where = f" WHERE event_type = '{event_type}'" if event_type else ""
    return f"{_TYPED},{_EVENTS} SELECT {_EVENT_COLUMNS} FROM events{where}"


def _issue(code: str, condition: str) -> str:
    return f"CASE WHEN {condition} THEN '{code}' END"


_ISSUES = {
    "CITY_ID_NULL": "city_id IS NULL",
    "DATE_NULL": "date IS NULL",
    "TEMP_MAX_NULL": "temperature_2m_max IS NULL",
    "TEMP_MIN_NULL": "temperature_2m_min IS NULL",
    "PRECIPITATION_NULL": "precipitation_sum IS NULL",
    "TEMP_MAX_LT_TEMP_MIN": "temperature_2m_min > temperature_2m_max",
    "PRECIPITATION_NEGATIVE": "precipitation_sum < 0",
    "WINDSPEED_NEGATIVE": "windspeed_10m_max < 0",
}

_QUARANTINE = f"""{_TYPED},
judged AS (
  SELECT *, concat_ws('|', {", ".join(_issue(code, test) for code, test in _ISSUES.items())}) AS quality_issue
  FROM typed
)
SELECT city_id, city_name, {_DAY}, quality_issue, '$.data.daily' AS payload_source
FROM judged WHERE quality_issue <> ''"""


def _invariant(table: str, source: str, rule: str, condition: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) AS checked_rows, "
        f"count(*) FILTER (WHERE {condition}) AS violations FROM {source}"
    )


_INVARIANTS = [
    *[("silver", "typed", code, test) for code, test in _ISSUES.items()],
    ("silver", "typed", "NOT_COMPARABLE", "isnan(temperature_2m_max) OR isnan(precipitation_sum)"),
    ("daily_risk", "risk", "TEMP_RISK_SCORE_RANGE", "temp_risk_score < 0 OR temp_risk_score > 100"),
    ("daily_risk", "risk", "PRECIP_RISK_SCORE_RANGE", "precip_risk_score < 0 OR precip_risk_score > 100"),
    ("daily_risk", "risk", "WIND_RISK_SCORE_RANGE", "wind_risk_score < 0 OR wind_risk_score > 100"),
    ("daily_risk", "risk", "COMPOSITE_RISK_SCORE_RANGE", "composite_risk_score < 0 OR composite_risk_score > 100"),
    ("daily_risk", "risk", "RISK_LEVEL_KNOWN", "risk_level NOT IN ('LOW', 'MODERATE', 'HIGH', 'CRITICAL')"),
    ("daily_risk", "risk", "COMPOSITE_MISSING", "composite_risk_score IS NULL"),
    ("climate_monthly", "climate", "ONE_ROW_PER_MONTH", "FALSE"),
    ("climate_monthly", "climate", "AVG_MAX_AT_LEAST_AVG_MIN", "avg_temp_max < avg_temp_min"),
    ("climate_monthly", "climate", "VARIABILITY_NOT_NEGATIVE", "climate_variability_index < 0"),
    ("climate_monthly", "climate", "MONTH_WITHOUT_OBSERVATIONS", "observed_days = 0"),
    ("extreme_events", "events", "EVENT_TYPE_KNOWN", "event_type IS NULL"),
    ("extreme_events", "events", "SEVERITY_KNOWN", "event_severity IS NULL"),
    ("extreme_events", "events", "EXCEEDANCE_NOT_NEGATIVE", "exceedance_pct < 0"),
]

# One document per chunk, city and source, with the daily arrays in obs_id order.
_FORECAST = [n for n in DAILY_VARIABLES if n not in ("temperature_2m_mean", "et0_fao_evapotranspiration")]


def _daily_json(names: list[str]) -> str:
    lists = ", ".join(f"'{name}': list({name} ORDER BY obs_id)" for name in names)
    return (
        "to_json({'latitude': lat, 'longitude': lon, 'daily': "
        f"{{'time': list(strftime(date, '%Y-%m-%d') ORDER BY obs_id), {lists}}}}})"
    )


_DOCS = f"""{_TYPED},
printed AS (
  SELECT * REPLACE ({_PRINTED}) FROM typed
),
numbered AS (
  SELECT *, min(obs_id) OVER (PARTITION BY chunk, city_name, source_type) AS doc_id FROM printed
),
placed AS (
  SELECT *, CAST(-100 - doc_id % 90 AS DOUBLE) / 10 AS lat, CAST(-600 - doc_id % 90 AS DOUBLE) / 10 AS lon
  FROM numbered
),
responses AS (
  SELECT doc_id, chunk, city_id, city_name, source_type, lat, lon, count(*) AS days,
    strftime(DATE '2024-01-01' + CAST(chunk % 7 AS INTEGER), '%Y-%m-%d') AS extraction_date,
    CAST(CASE WHEN source_type = 'forecast' THEN {_daily_json(_FORECAST)}
      ELSE {_daily_json(list(DAILY_VARIABLES))} END AS VARCHAR) AS response
  FROM placed GROUP BY doc_id, chunk, city_id, city_name, source_type, lat, lon
),
documents_built AS (
  SELECT *, '{{"meta":' || CAST(to_json({{'project': 'skyledger', 'source_system': 'derived', 'source_type': source_type,
      'extraction_date': extraction_date, 'extraction_timestamp_utc': extraction_date || 'T06:00:00+00:00',
      'city_id': city_id, 'city_name': city_name, 'latitude': lat, 'longitude': lon, 'elevation_m': chunk * 10,
      'timezone': 'America/La_Paz', 'source_url': 'https://weather.example/' || source_type,
      'record_count': days}}) AS VARCHAR) || ',"data":' || response || '}}' AS document
  FROM responses
),
staged AS (
  SELECT *, coalesce(city_id, 'None') AS staged_city,
    source_type || '_' || replace(extraction_date, '-', '') || '.json.' || lpad(CAST(chunk AS VARCHAR), 12, '0') AS file_name,
    'store://bronze/' || source_type || '/' || staged_city || '/' || replace(extraction_date, '-', '/') || '/' || file_name AS uri
  FROM documents_built
)"""



def _scalar(document: str, path: str) -> str:
    kind = f"json_type(json_extract({document}, '{path}'))"
    return f"CASE WHEN {kind} NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN json_extract_string({document}, '{path}') END"


_LOOSE = f"""{_DOCS},
loose AS (
  SELECT doc_id, days, coalesce(city_id, 'None') AS city_id, CASE doc_id % 8
    WHEN 0 THEN document || ' oops' WHEN 1 THEN document || document
    WHEN 2 THEN replace(document, '"meta":', chr(39) || 'meta' || chr(39) || ':')
    WHEN 3 THEN regexp_replace(document, '"record_count":([0-9]+)', '"record_count":\\1.0')
    WHEN 4 THEN regexp_replace(document, '"extraction_timestamp_utc":"[^"]*"', '"extraction_timestamp_utc":"2024-05"')
    WHEN 5 THEN replace(document, '"meta":{{', '"meta":{{"city_id":"x",')
    WHEN 6 THEN document || ']' ELSE chr(32) || chr(10) || replace(document, '":', '" : ') || chr(9) || ' ' END AS document
  FROM documents_built
),
judged AS (
  SELECT *, CASE WHEN NOT json_valid(document) THEN 'document is not an object'
    WHEN NOT regexp_full_match(json_extract_string(document, '$.meta.extraction_timestamp_utc'), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T.*')
    THEN 'extraction_timestamp_utc is not a timestamp' END AS error
  FROM loose
)"""

ORACLES: dict[str, str] = {
    "daily_risk": f"{_risk('city_id')} SELECT city_id, city_name, {_DAY}, {_SCORES} FROM risk",
    "risk_base": f"""{_risk("city_id")}
SELECT city_id, city_name, {_DAY}, temperature_2m_max, temperature_2m_min, precipitation_sum, windspeed_10m_max,
  {_r2("ref")} AS temperature_reference_c FROM base""",
    "temp_baseline": f"""{_risk("city_id")}
SELECT DISTINCT city_id, {_r2("avg_ref")} AS baseline_avg, {_r2("std_ref")} AS baseline_std FROM framed""",
    "risk_baseline_state": f"""{_risk("city_id")},
baselines AS (SELECT DISTINCT city_id, avg_ref, std_ref FROM framed)
SELECT w.city_id, w.month AS month_number, count(*) AS days, {_r2("avg(w.precipitation_sum)")} AS avg_rain,
  {_r2("stddev_pop((w.temperature_2m_max + w.temperature_2m_min) / 2)")} AS variability,
  {_r2("any_value(avg_ref)")} AS baseline_avg, {_r2("any_value(std_ref)")} AS baseline_std
FROM clean w JOIN baselines b ON b.city_id = w.city_id WHERE w.windspeed_10m_max IS NOT NULL
GROUP BY w.city_id, w.month""",
    "temp_ladder": f"{_risk('station_id')} SELECT station_id, city_name, {_DAY}, {_SCORES} FROM risk",
    "risk_level_dist": f"{_risk('city_id')} SELECT city_id, risk_level, count(*) AS days FROM risk GROUP BY ALL",
    "clamp_score": """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber % 4 = 3 THEN NULL WHEN l_extendedprice / 500 - 20 < 0 THEN CAST(0 AS DOUBLE)
    WHEN l_extendedprice / 500 - 20 > 100 THEN CAST(100 AS DOUBLE) ELSE l_extendedprice / 500 - 20 END AS score
FROM lineitem""",
    "round2": f"""
SELECT l_orderkey, l_linenumber, l_partkey, {_r2("net")} AS net
FROM (SELECT *, l_extendedprice * (1 - l_discount) * (1 + l_tax)
  * (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) / 8 AS net FROM lineitem) l""",
    "silver_accept": f"{_TYPED} SELECT obs_id, city_id, city_name, {_DAY}, {_MEASURES}, year, month, season FROM clean",
    "quarantine": _QUARANTINE,
    "silver_incremental": f"""{_TYPED},
existing AS (SELECT * FROM clean WHERE obs_id % 4 = 0)
SELECT obs_id, city_id, {_DAY}, {_MEASURES} FROM clean n
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.city_id = n.city_id AND e.date = n.date)""",
    "backfill_insert": f"""{_TYPED},
existing AS (SELECT * FROM clean WHERE obs_id % 4 = 1)
SELECT obs_id, city_id, {_DAY}, {_MEASURES} FROM clean n
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.city_id = n.city_id AND e.date = n.date)""",
    "dq_invariants": f"{_risk('city_id')},{_CLIMATE},{_EVENTS} "
    + " UNION ALL ".join(_invariant(*rule) for rule in _INVARIANTS),
    "dq_gate": f"{_risk('city_id')},{_CLIMATE},{_EVENTS} "
    + " UNION ALL ".join(_invariant(*rule) for rule in _INVARIANTS if rule[2] != "ONE_ROW_PER_MONTH"),
    "month_calendar": f"""{_TYPED},{_MONTHS}
SELECT c.city_id, c.city_name, m.month_number, m.month_name, m.season, count(t.date) AS days
FROM cities c JOIN months m ON TRUE LEFT JOIN typed t ON t.city_id = c.city_id AND t.month = m.month_number
GROUP BY ALL""",
    "climate_monthly": f"{_TYPED},{_CLIMATE} SELECT * FROM climate",
    "extreme_events": _event_query(),
    "event_heat_wave": _event_query("HEAT_WAVE"),
    "event_frost": _event_query("FROST"),
    "event_heavy_rain": _event_query("HEAVY_RAIN"),
    "event_high_wind": _event_query("HIGH_WIND"),
    "event_storm": _event_query("STORM"),
    "cities_dim": f"{_TYPED} SELECT c.*, count(*) AS days FROM clean w JOIN cities c USING (city_id) GROUP BY ALL",
    "cities_config": """
SELECT lower(replace(n_name, ' ', '_')) AS city_id, n_name AS city_name, n_nationkey / CAST(2 AS DOUBLE) AS latitude,
  n_regionkey * CAST(-1.5 AS DOUBLE) AS longitude, CAST(n_nationkey * 10 AS BIGINT) AS elevation_m,
  CAST(NULL AS VARCHAR) AS department, CAST(NULL AS VARCHAR) AS region FROM nation""",
    "weathercode_dim": f"""{_TYPED}, codes AS ({_CODES})
SELECT coalesce(t.weathercode, codes.weathercode) AS weathercode, weather_description, count(t.obs_id) AS days
FROM typed t FULL JOIN codes ON codes.weathercode = t.weathercode GROUP BY ALL""",
    "city_key": f"{_TYPED} SELECT obs_id, city_name, city_id FROM typed",
    "typed_daily": f"""{_TYPED}
SELECT city_id, {_DAY}, year, month, season, weathercode, {_PRINTED},
  strftime(DATE '2024-01-01' + CAST(chunk % 7 AS INTEGER), '%Y-%m-%d') || ' 06:00:00' AS extracted_at FROM typed""",
    "parse_daily": f"""{_TYPED}
SELECT city_id, city_name, {_DAY}, weathercode, {_PRINTED}, '$.data.daily' AS payload_source FROM typed""",
    "json_scalar": f"""
WITH e AS (
  SELECT event_id, props, '{{"outer":' || props || ',"tags":["a"],"none":null,"draft":"[' || event_id || '] x","brace":"{{z}}"}}' AS nested
  FROM events
)
SELECT event_id, {_scalar("props", "$.k")} AS k, {_scalar("nested", "$.outer.k")} AS outer_k,
  {_scalar("nested", "$.outer")} AS object_value, {_scalar("nested", "$.tags")} AS array_value,
  {_scalar("nested", "$.none")} AS null_value, {_scalar("nested", "$.draft")} AS draft, {_scalar("nested", "$.brace")} AS brace
FROM e""",
    "envelope_build": f"{_DOCS} SELECT doc_id, city_id, source_type, document FROM documents_built",
    "envelope_validate": f"""{_DOCS}
SELECT doc_id, list_extract(['document is not an object', 'no object under meta', 'no object under data',
  'absent from meta: city_id', 'record_count is not an integer', 'extraction_date is not a date',
  'extraction_timestamp_utc is not a timestamp'], doc_id % 11 + 1) AS error FROM responses""",
    "payload_validate": f"""{_DOCS}
SELECT doc_id, list_extract(['response is not an object', 'missing root fields: latitude', 'daily is not an object',
  'daily.time is not a non-empty array', 'daily.time is not a non-empty array'], doc_id % 7 + 1) AS error
FROM responses""",
    "record_count": f"""{_DOCS}
SELECT doc_id, CASE WHEN doc_id % 7 IN (0, 2, 3, 4) THEN 0 ELSE days END AS records FROM responses""",
    "bronze_path": f"""{_DOCS}
SELECT doc_id, 'raw/weather/' || source_type || '/' || staged_city || '/' || replace(extraction_date, '-', '/')
  || '/' || doc_id || '.json' AS path FROM staged""",
    "raw_stage": f"""{_DOCS}
SELECT source_type, staged_city AS city_id, coalesce(city_name, 'None') AS city_name, extraction_date,
  extraction_date || ' 06:00:00' AS extracted_at, days AS record_count, uri AS gcs_uri, file_name AS source_file_name,
  sha256(document) AS payload_sha256, sha256(document) AS staged_sha256 FROM staged""",
    "raw_dedup": f"""{_DOCS}
SELECT staged_city AS city_id, source_type, extraction_date, min(uri) AS gcs_uri, arg_min(days, uri) AS record_count
FROM staged WHERE extraction_date <> '2024-01-02' GROUP BY staged_city, source_type, extraction_date""",
    "envelope_strict": f"""{_LOOSE}
SELECT doc_id, error, CASE WHEN error IS NULL THEN city_id END AS city_id,
  CASE WHEN json_valid(document) THEN CAST(trunc(CAST(json_extract(document, '$.meta.record_count') AS DOUBLE)) AS BIGINT) END AS records
FROM judged""",
    "envelope_rejects": f"""{_LOOSE}
SELECT sha256(document) AS payload_sha256, error FROM judged WHERE error IS NOT NULL""",
    "landing_roundtrip": f"""{_DOCS}
SELECT sha256(document) AS payload_sha256, length(document) AS chars, CAST(NULL AS VARCHAR) AS error FROM documents_built""",
    "bronze_roundtrip": f"""{_DOCS}
SELECT uri AS gcs_uri, sha256(document) AS payload_sha256, strlen(document) AS bytes, TRUE AS intact FROM staged""",
    "payload_sha": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
}
