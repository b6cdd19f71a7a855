"""Catalog of extreme weather events."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numeric import percent_of
from skyledger.operators.quality import EVENT_RULES, accept


@dataclass(frozen=True)
class Detector:
    """A threshold on one measure. ``side`` is 'above' or 'below'."""

    event_type: str
    column: str
    side: str
    threshold: float
    severe: float
    extreme: float
    inclusive: bool = False

    def _value(self) -> Column:
        return F.col(self.column).cast("double")

    def _reaches(self, level: float) -> Column:
        return self._value() >= level if self.side == "above" else self._value() <= level

    def hit(self) -> Column:
        # Compared without a cast, so that the scan can push the predicate down.
        value = F.col(self.column)
        if self.side == "above":
            return value >= self.threshold if self.inclusive else value > self.threshold
        return value <= self.threshold if self.inclusive else value < self.threshold

    def event(self) -> Column:
        """The event columns of a row that hits."""
        threshold = F.lit(float(self.threshold))
        beyond = self._value() - threshold if self.side == "above" else threshold - self._value()
        severity = (
            F.when(self._reaches(self.extreme), "EXTREME")
            .when(self._reaches(self.severe), "SEVERE")
            .otherwise("MODERATE")
        )
        return F.struct(
            F.lit(self.event_type).alias("event_type"),
            severity.alias("event_severity"),
            self._value().alias("observed_value"),
            threshold.alias("threshold_value"),
            percent_of(beyond, threshold).alias("exceedance_pct"),
        )


# Thresholds and severity bounds of each event type.
HEAT_WAVE = Detector("HEAT_WAVE", "temperature_2m_max", "above", 37.0, 40.0, 42.0)
FROST = Detector("FROST", "temperature_2m_min", "below", 2.0, 0.0, -5.0)
HEAVY_RAIN = Detector("HEAVY_RAIN", "precipitation_sum", "above", 50.0, 75.0, 100.0)
HIGH_WIND = Detector("HIGH_WIND", "windspeed_10m_max", "above", 60.0, 75.0, 90.0)
STORM = Detector("STORM", "weathercode", "above", 95, 96, 99, inclusive=True)
DETECTORS = (HEAT_WAVE, FROST, HEAVY_RAIN, HIGH_WIND, STORM)


def extreme_events(
    clean: DataFrame,
    detectors: Sequence[Detector] = DETECTORS,
    generated_at: Column | None = None,
) -> DataFrame:
    """Every event of every valid row: one scan and no shuffle for any number of detectors.

    A row raises one event per detector it hits. Cities outside the dimension are kept, under
    the name that Silver holds.
    """
    hits = accept(clean, EVENT_RULES).filter(reduce(or_, [d.hit() for d in detectors]))
    # Slots of detectors that do not hit are dropped after the explode: compacting the array
    # first would run a lambda per row, outside generated code.
    slots = F.array(*[F.when(d.hit(), d.event()) for d in detectors])
    raised = hits.select("city_id", "city_name", "date", F.explode(slots).alias("event"))
    return raised.filter(F.col("event").isNotNull()).select(
        "city_id",
        "city_name",
        "date",
        "event.*",
        F.year("date").cast("bigint").alias("year"),
        F.month("date").cast("bigint").alias("month"),
        (F.current_timestamp() if generated_at is None else generated_at).alias("generated_at"),
    )


def in_report_order(events: DataFrame) -> DataFrame:
    """Events by date, city name and type.

    The order is not total, and copies of one key cannot be told apart by content, so the row
    position breaks ties: it lets the range partitioner spread a hot key over several tasks.
    """
    return (
        events.withColumn("position", F.monotonically_increasing_id())
        .orderBy("date", "city_name", "event_type", "position")
        .drop("position")
    )
