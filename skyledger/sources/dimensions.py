"""The two fixed dimensions and the calendar that is derived from them."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class City(NamedTuple):
    city_id: str
    city_name: str
    latitude: float
    longitude: float
    elevation_m: int
    department: str
    region: str


# The city dimension.
CITIES = (
    City("santa_cruz", "Santa Cruz de la Sierra", -17.7833, -63.1833, 416, "Santa Cruz", "Lowlands"),
    City("la_paz", "La Paz", -16.5, -68.15, 3640, "La Paz", "Altiplano"),
    City("cochabamba", "Cochabamba", -17.3895, -66.1568, 2558, "Cochabamba", "Valleys"),
    City("sucre", "Sucre", -19.0431, -65.2591, 2810, "Chuquisaca", "Valleys"),
    City("oruro", "Oruro", -17.9833, -67.15, 3706, "Oruro", "Altiplano"),
    City("tarija", "Tarija", -21.5353, -64.7298, 1866, "Tarija", "Valleys"),
)

# Weather code descriptions.
WEATHER_CODES = (
    (0, "Clear sky"),
    (1, "Mainly clear"),
    (2, "Partly cloudy"),
    (3, "Overcast"),
    (45, "Fog"),
    (48, "Depositing rime fog"),
    (51, "Light drizzle"),
    (53, "Moderate drizzle"),
    (55, "Dense drizzle"),
    (61, "Slight rain"),
    (63, "Moderate rain"),
    (65, "Heavy rain"),
    (71, "Slight snow fall"),
    (73, "Moderate snow fall"),
    (75, "Heavy snow fall"),
    (80, "Slight rain showers"),
    (81, "Moderate rain showers"),
    (82, "Violent rain showers"),
    (95, "Thunderstorm"),
    (96, "Thunderstorm with slight hail"),
    (99, "Thunderstorm with heavy hail"),
)

CITY_COLUMNS = ("city_id", "city_name", "latitude", "longitude", "elevation_m", "department", "region")
WEATHER_CODE_COLUMNS = ("weathercode", "weather_description")


def _literal(value: str | int | float) -> str:
    """SQL literal of type string, bigint or double."""
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    return f"{value}D" if isinstance(value, float) else f"{value}L"


def _inline_table(spark: SparkSession, rows: Iterable[tuple], columns: tuple[str, ...]) -> DataFrame:
    """Literal rows as an inline table, whose size the planner knows without running a job."""
    values = ", ".join("(" + ", ".join(_literal(value) for value in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def cities_dim(spark: SparkSession) -> DataFrame:
    """One row per city. ``len(CITIES)`` is its proven size, so it can always be broadcast."""
    return _inline_table(spark, CITIES, CITY_COLUMNS)


def weathercode_dim(spark: SparkSession) -> DataFrame:
    """One row per weather code. ``len(WEATHER_CODES)`` is its proven size."""
    return _inline_table(spark, WEATHER_CODES, WEATHER_CODE_COLUMNS)
