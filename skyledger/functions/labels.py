"""City keys, month names and season names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.sources.dimensions import CITIES

# Season of each calendar month, southern hemisphere. Silver is labelled in
# English, the Gold climate table in Spanish.
SEASON_MONTHS = ((12, 1, 2), (3, 4, 5), (6, 7, 8), (9, 10, 11))
SEASONS_EN = ("Summer", "Autumn", "Winter", "Spring")
SEASONS_ES = ("Verano", "Otono", "Invierno", "Primavera")

# Spanish month names.
MONTHS_ES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)


def first_match(cases: Iterable[tuple[Column, Column]]) -> Column:
    """CASE WHEN over (condition, value) pairs; NULL when none holds."""
    (condition, value), *rest = cases
    result = F.when(condition, value)
    for condition, value in rest:
        result = result.when(condition, value)
    return result


def _snake(name: str) -> str:
    return name.lower().replace(" ", "_")


def city_key(name: Column) -> Column:
    """City id: the dimension's id for a known name in any case, else lower snake case.

    Only a name whose id is not its snake case needs a lookup.
    """
    lowered = F.lower(name)
    snake = F.replace(lowered, F.lit(" "), F.lit("_"))
    named = [city for city in CITIES if city.city_id != _snake(city.city_name)]
    return first_match((lowered == city.city_name.lower(), F.lit(city.city_id)) for city in named).otherwise(snake)


def _season(month: Column, names: tuple[str, ...]) -> Column:
    return first_match((month.isin(*months), F.lit(name)) for months, name in zip(SEASON_MONTHS, names))


def season_en(month: Column) -> Column:
    """English season; a missing month gives 'Unknown'."""
    return _season(month, SEASONS_EN).otherwise(F.lit("Unknown"))


def season_es(month: Column) -> Column:
    """Spanish season; a missing month gives NULL."""
    return _season(month, SEASONS_ES)


def month_name_es(month: Column) -> Column:
    """Spanish name of month 1 to 12, otherwise NULL."""
    return F.get(F.array(*[F.lit(name) for name in MONTHS_ES]), month.cast("int") - 1)
