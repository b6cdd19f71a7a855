"""Column contracts of the staged, Silver and Gold tables, and of the JSON payload."""

from __future__ import annotations

# Daily variables of a response. Forecasts lack the last two; a missing array reads as NULL.
DOUBLE_VARIABLES = (
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "precipitation_sum",
    "windspeed_10m_max",
    "et0_fao_evapotranspiration",
)
LONG_VARIABLES = ("weathercode",)
DAILY_VARIABLES = (
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "precipitation_sum",
    "windspeed_10m_max",
    "weathercode",
    "et0_fao_evapotranspiration",
)

REQUIRED_META = (
    "city_id",
    "city_name",
    "extraction_date",
    "extraction_timestamp_utc",
    "record_count",
    "source_type",
)
REQUIRED_RESPONSE = ("daily", "latitude", "longitude")
REQUIRED_CITY = ("id", "lat", "lon", "name")

# Arrays are read as text so that one bad element becomes one NULL, not a lost document.
DAILY_JSON = "struct<time: array<string>, " + ", ".join(f"{v}: array<string>" for v in DAILY_VARIABLES) + ">"
PAYLOAD_JSON = f"meta struct<city_name: string>, data struct<daily: {DAILY_JSON}>"
# The document and its seal. Maps keep the difference between an absent key and a key that holds
# null; of data it only matters that it is an object.
ENVELOPE_JSON = "array<struct<meta: map<string, string>, data: struct<none: string>, seal: string>>"

RAW_WEATHER_COLUMNS = {
    "source_type": "string",
    "city_id": "string",
    "city_name": "string",
    "extraction_date": "date",
    "extraction_timestamp_utc": "timestamp",
    "record_count": "bigint",
    "gcs_uri": "string",
    "source_file_name": "string",
    "payload_sha256": "string",
    "payload": "string",
    "uploaded_at_utc": "timestamp",
}

DAILY_CLEAN_COLUMNS = {
    "city_id": "string",
    "city_name": "string",
    "date": "date",
    "temperature_2m_max": "double",
    "temperature_2m_min": "double",
    "temperature_2m_mean": "double",
    "precipitation_sum": "double",
    "windspeed_10m_max": "double",
    "weathercode": "bigint",
    "et0_fao_evapotranspiration": "double",
    "year": "bigint",
    "month": "bigint",
    "season": "string",
    "extraction_timestamp_utc": "timestamp",
    "loaded_at_utc": "timestamp",
}

QUARANTINE_COLUMNS = {
    "city_id": "string",
    "city_name": "string",
    "date": "date",
    "quality_issue": "string",
    "payload_source": "string",
    "extraction_timestamp_utc": "timestamp",
    "rejected_at_utc": "timestamp",
}


LANDING_REJECT_COLUMNS = {
    "path": "string",
    "source_file_name": "string",
    "payload_sha256": "string",
    "error": "string",
    "rejected_at_utc": "timestamp",
}

DUPLICATE_COLUMNS = {
    "city_id": "string",
    "source_type": "string",
    "extraction_date": "date",
    "gcs_uri": "string",
    "payload_sha256": "string",
    "kept_uri": "string",
    "kept_sha256": "string",
    "logged_at_utc": "timestamp",
}


def ddl(columns: dict[str, str]) -> str:
    """Column list for CREATE TABLE or an explicit read schema."""
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())
