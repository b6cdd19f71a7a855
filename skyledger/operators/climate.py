"""Monthly climate comparison: one row per city and month of the year, observed or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.labels import month_name_es, season_es
from skyledger.functions.numeric import round2
from skyledger.operators.quality import CLIMATE_RULES, accept

# Fixed value: a month with fewer observed days is partial.
FULL_MONTH_DAYS = 15


def month_calendar(dim: DataFrame, entity: str = "city_id") -> DataFrame:
    """Twelve rows per dimension row, made by exploding the months: no cross join."""
    months = dim.select(entity, "city_name", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    return months.select(
        entity,
        "city_name",
        F.col("month").cast("bigint").alias("month_number"),
        month_name_es(F.col("month")).alias("month_name"),
        season_es(F.col("month")).alias("season"),
    )


def completeness(days: Column, full_month_days: int = FULL_MONTH_DAYS) -> Column:
    """Status of a month by its number of observed days."""
    return (
        F.when(days == 0, "NO_OBSERVATIONS").when(days < full_month_days, "PARTIAL_MONTH").otherwise("OBSERVED")
    )


def climate_monthly(
    clean: DataFrame,
    dim: DataFrame,
    entity: str = "city_id",
    full_month_days: int = FULL_MONTH_DAYS,
    generated_at: Column | None = None,
) -> DataFrame:
    """Averages per city and month of the year, all years pooled.

    The facts are aggregated before they meet the calendar, so only one row per city and month
    reaches the join and no hot city does.
    """
    return climate_table(observed_months(clean, entity), dim, entity, full_month_days, generated_at)


def observed_months(clean: DataFrame, entity: str = "city_id") -> DataFrame:
    """One row per city and month that has observations."""
    mid_range = (F.col("temperature_2m_max") + F.col("temperature_2m_min")) / 2.0
    return (
        accept(clean, CLIMATE_RULES)
        .groupBy(entity, F.month("date").cast("bigint").alias("month_number"))
        .agg(
            F.count("date").alias("days"),
            F.avg("temperature_2m_max").alias("max_c"),
            F.avg("temperature_2m_min").alias("min_c"),
            F.avg("precipitation_sum").alias("rain_mm"),
            F.avg("windspeed_10m_max").alias("wind_kmh"),
            F.stddev_pop(mid_range).alias("mid_std"),
        )
    )


def climate_table(
    observed: DataFrame,
    dim: DataFrame,
    entity: str = "city_id",
    full_month_days: int = FULL_MONTH_DAYS,
    generated_at: Column | None = None,
) -> DataFrame:
    """The calendar of all cities with what ``observed`` (``observed_months``) has of them."""
    months = month_calendar(dim, entity).join(observed, [entity, "month_number"], "left")
    days = F.coalesce("days", F.lit(0).cast("bigint"))
    return months.select(
        entity,
        "city_name",
        "month_number",
        "month_name",
        "season",
        round2(F.col("max_c")).alias("avg_temp_max"),
        round2(F.col("min_c")).alias("avg_temp_min"),
        round2(F.col("rain_mm")).alias("avg_precipitation"),
        round2(F.col("wind_kmh")).alias("avg_windspeed"),
        round2(F.col("mid_std")).alias("climate_variability_index"),
        days.alias("observed_days"),
        completeness(days, full_month_days).alias("data_completeness_status"),
        (F.current_timestamp() if generated_at is None else generated_at).alias("generated_at"),
    )
