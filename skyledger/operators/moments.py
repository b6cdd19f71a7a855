"""Count, mean and squared deviations as state that is added to, insert by insert.

A state has a row for each key and, for each measure, a struct ``n, mean, m2``. The states of two
sets of rows merge into that of both without their rows, whatever the order, so a baseline over the
whole history costs a pass over the new rows only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.quality import CLIMATE_RULES

#: Keys of the weather state: risk rolls the months up, climate reads them as they are.
STATE_KEYS = ("city_id", "month_number")
CLIMATE_MEASURES = ("max_c", "min_c", "rain_mm", "wind_kmh", "mid_c")
MEASURES = ("reference_c", *CLIMATE_MEASURES)
STATE_COLUMNS = {
    "city_id": "string",
    "month_number": "bigint",
    **{name: "struct<n: bigint, mean: double, m2: double>" for name in (*MEASURES, "days", "all_rows")},
}


def moments(value: Column) -> Column:
    """The moments of a group's values. NULL counts nowhere; a group without values has zeros."""
    deviations = F.var_pop(value) * F.count(value)
    return F.struct(
        F.count(value).alias("n"),
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
        F.coalesce(deviations, F.lit(0.0)).alias("m2"),
    )


def _add(a: Column, b: Column) -> Column:
    """Both sets of values, by their means' distance: nothing large is subtracted."""
    n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
    share = F.when(n > 0, b["n"] / n).otherwise(0.0)
    return F.struct(
        n.alias("n"),
        (a["mean"] + apart * share).alias("mean"),
        (a["m2"] + b["m2"] + apart * apart * a["n"] * share).alias("m2"),
    )


def _fold(parts: Column) -> Column:
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(parts, zero, _add)


def merge_states(states: Sequence[DataFrame], keys: Sequence[str] = STATE_KEYS) -> DataFrame:
    """One state of all. Each given state has a key once, so a row meets as many as are given."""
    union = reduce(DataFrame.unionByName, states)
    measures = [c for c in union.columns if c not in keys]
    return union.groupBy(*keys).agg(*[_fold(F.collect_list(c)).alias(c) for c in measures])


def roll_up(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state by fewer keys. The keys that go, such as months, must be few."""
    measures = [c for c in state.columns if state.schema[c].dataType.typeName() == "struct"]
    return state.groupBy(*keys).agg(*[_fold(F.collect_list(c)).alias(c) for c in measures])


def mean(measure: str) -> Column:
    """NULL without values, as an average is."""
    return F.when(F.col(measure)["n"] > 0, F.col(measure)["mean"])


def deviation(measure: str) -> Column:
    """Population deviation; NULL without values."""
    found = F.col(measure)
    return F.when(found["n"] > 0, F.sqrt(F.greatest(found["m2"], F.lit(0.0)) / found["n"]))


def _values() -> Mapping[str, Column]:
    high, low = F.col("temperature_2m_max"), F.col("temperature_2m_min")
    mid = (high + low) / 2.0
    values = {"max_c": high, "min_c": low, "rain_mm": F.col("precipitation_sum"), "wind_kmh": F.col("windspeed_10m_max")}
    return {**{name: F.when(F.col("in_climate"), v) for name, v in {**values, "mid_c": mid}.items()},
            "reference_c": F.coalesce("temperature_2m_mean", mid)}


def weather_state(clean: DataFrame, entity: str = "city_id") -> DataFrame:
    """State of accepted rows by entity and month of the year.

    Rows that climate leaves out count for the risk baseline only. Entities and months may be NULL;
    the readers of the state drop what they would drop among rows.
    """
    marked = clean.withColumn("in_climate", accept_condition())
    grouped = marked.groupBy(entity, F.month("date").cast("bigint").alias("month_number"))
    values = _values()
    return grouped.agg(
        *[moments(values[name]).alias(name) for name in MEASURES],
        moments(F.when(F.col("in_climate") & F.col("date").isNotNull(), F.lit(1.0))).alias("days"),
        moments(F.lit(1.0)).alias("all_rows"),
    )


def accept_condition() -> Column:
    """Whether a row passes the climate rules: false where a rule cannot be judged, as in a filter."""
    held = [rule.holds() for rule in CLIMATE_RULES]
    return F.coalesce(reduce(Column.__and__, held), F.lit(False))


def covers(state: DataFrame, clean: DataFrame) -> bool:
    """Whether the state is of just as many rows as there are."""
    counted = state.agg(F.sum(F.col("all_rows")["n"])).first()[0]
    return (counted or 0) == clean.count()


def baseline_from_state(state: DataFrame, entity: str = "city_id") -> DataFrame:
    """What ``temp_baseline`` gives over all rows."""
    return roll_up(state.select(entity, "reference_c"), [entity]).select(
        entity, mean("reference_c").alias("baseline_avg"), deviation("reference_c").alias("baseline_std")
    )


def months_from_state(state: DataFrame, entity: str = "city_id") -> DataFrame:
    """What ``observed_months`` gives over all rows."""
    return state.filter(F.col("days")["n"] > 0).select(
        entity,
        "month_number",
        F.col("days")["n"].alias("days"),
        *[mean(name).alias(name) for name in CLIMATE_MEASURES if name != "mid_c"],
        deviation("mid_c").alias("mid_std"),
    )
