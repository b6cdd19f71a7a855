"""Daily composite risk index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.labels import first_match
from skyledger.functions.numeric import clamp, round2
from skyledger.operators.joins import BROADCAST_ROWS, HOT_ROWS, lookup_join
from skyledger.session import keep


@dataclass(frozen=True)
class RiskModel:
    """Weights, reference loads, temperature steps and level bounds."""

    temp_weight: float = 0.40
    precip_weight: float = 0.35
    wind_weight: float = 0.25
    precip_reference_mm: float = 50.0
    wind_reference_kmh: float = 60.0
    points_per_deviation: float = 25.0
    # (hot at or above, cold at or below, score), first match wins.
    temp_steps: tuple[tuple[float, float, float], ...] = (
        (37.0, 2.0, 100.0),
        (34.0, 5.0, 75.0),
        (30.0, 8.0, 50.0),
    )
    temp_step_default: float = 10.0
    # (score up to and including, level); anything else, NULL included, is the last level.
    levels: tuple[tuple[float, str], ...] = ((25.0, "LOW"), (50.0, "MODERATE"), (75.0, "HIGH"))
    last_level: str = "CRITICAL"


MODEL = RiskModel()


def risk_base(
    clean: DataFrame,
    dim: DataFrame | None = None,
    entity: str = "city_id",
    *,
    dim_rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Clean rows with their reference temperature.

    With ``dim``, entities it does not hold are dropped and the name is the dimension's.
    """
    mid_range = (F.col("temperature_2m_max") + F.col("temperature_2m_min")) / 2.0
    base = clean.select(
        entity,
        *([] if dim is not None else ["city_name"]),
        "date",
        "temperature_2m_max",
        "temperature_2m_min",
        F.coalesce("temperature_2m_mean", mid_range).alias("temperature_reference_c"),
        "precipitation_sum",
        "windspeed_10m_max",
    )
    if dim is None:
        return base
    names = dim.select(entity, "city_name")
    return lookup_join(base, names, [entity], lookup_rows=dim_rows, broadcast_rows=broadcast_rows)


def temp_baseline(base: DataFrame, entity: str = "city_id") -> DataFrame:
    """Mean and population deviation of the reference temperature per entity.

    An aggregate combines map-side, so an entity with a third of all rows still sends one row per
    map task; a window over the entity would bring all its rows to one task and sort them.
    """
    return base.groupBy(entity).agg(
        F.avg("temperature_reference_c").alias("baseline_avg"),
        F.stddev_pop("temperature_reference_c").alias("baseline_std"),
    )


def temp_step_score(model: RiskModel = MODEL) -> Column:
    """Score by absolute temperature, for entities whose temperature does not vary."""
    hot, cold = F.col("temperature_2m_max"), F.col("temperature_2m_min")
    return first_match(
        ((hot >= at_least) | (cold <= at_most), F.lit(score)) for at_least, at_most, score in model.temp_steps
    ).otherwise(F.lit(model.temp_step_default))


def risk_level(score: Column, model: RiskModel = MODEL) -> Column:
    """Level of a composite score. A NULL score matches no bound and so gets the last level."""
    return first_match((score <= bound, F.lit(level)) for bound, level in model.levels).otherwise(
        F.lit(model.last_level)
    )


def score(rows: DataFrame, entity: str = "city_id", model: RiskModel = MODEL) -> DataFrame:
    """Component and composite scores of rows that carry their baseline."""
    std = F.col("baseline_std")
    deviation = F.abs(F.col("temperature_reference_c") - F.col("baseline_avg")) / std
    by_deviation = deviation * model.points_per_deviation
    parts = rows.select(
        entity,
        "city_name",
        "date",
        F.when(std.isNull() | (std == 0.0), temp_step_score(model)).otherwise(by_deviation).alias("temp"),
        (F.col("precipitation_sum") / model.precip_reference_mm * 100.0).alias("precip"),
        (F.col("windspeed_10m_max") / model.wind_reference_kmh * 100.0).alias("wind"),
    ).select(
        entity,
        "city_name",
        "date",
        *[round2(clamp(F.col(part))).alias(f"{part}_risk_score") for part in ("temp", "precip", "wind")],
    )
    weighted = (
        F.col("temp_risk_score") * model.temp_weight
        + F.col("precip_risk_score") * model.precip_weight
        + F.col("wind_risk_score") * model.wind_weight
    )
    return parts.withColumn("composite_risk_score", round2(weighted)).withColumn(
        "risk_level", risk_level(F.col("composite_risk_score"), model)
    )


def daily_risk(
    clean: DataFrame,
    dim: DataFrame | None = None,
    entity: str = "city_id",
    model: RiskModel = MODEL,
    *,
    dim_rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    baseline: DataFrame | None = None,
) -> DataFrame:
    """Risk row per clean row: scores against the entity's own temperature baseline.

    ``baseline`` may come from kept state (``moments.baseline_from_state``); else it is aggregated.
    The baseline has at most one row per dimension row, so a broadcastable dimension proves a
    broadcastable baseline. Without one, the baseline is kept and counted first.
    """
    if dim is not None and dim_rows is None:
        dim_rows = dim.count()
    base = risk_base(clean, dim, entity, dim_rows=dim_rows, broadcast_rows=broadcast_rows)
    baseline = temp_baseline(base, entity) if baseline is None else baseline
    proven = dim_rows if dim_rows is not None and dim_rows <= broadcast_rows else None
    rows = lookup_join(
        base,
        baseline if proven is not None else keep(baseline),
        [entity],
        lookup_rows=proven,
        broadcast_rows=broadcast_rows,
        hot_rows=hot_rows,
    )
    return score(rows, entity, model)


def risk_level_counts(risk: DataFrame, entity: str = "city_id") -> DataFrame:
    """Days per entity and level."""
    return risk.groupBy(entity, "risk_level").agg(F.count("*").alias("days"))
