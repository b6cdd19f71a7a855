"""Table invariants: one row per rule with the number of rows that violate it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skyledger.operators.events import DETECTORS
from skyledger.operators.quality import SILVER_RULES, not_comparable
from skyledger.operators.risk import MODEL

LEVELS = (*[level for _, level in MODEL.levels], MODEL.last_level)
SEVERITIES = ("MODERATE", "SEVERE", "EXTREME")
SILVER_MEASURES = ("temperature_2m_max", "temperature_2m_min", "precipitation_sum", "windspeed_10m_max")


def silver_rules() -> dict[str, Column]:
    """Each Silver rule, and rows that NaN keeps out of both Silver and the quarantine log."""
    rules = {rule.issue: rule.broken() for rule in SILVER_RULES}
    return {**rules, "NOT_COMPARABLE": not_comparable(SILVER_MEASURES)}


def _out_of_range(column: str) -> Column:
    return ~F.col(column).between(0.0, 100.0)


def risk_rules() -> dict[str, Column]:
    scores = ("temp_risk_score", "precip_risk_score", "wind_risk_score", "composite_risk_score")
    return {
        **{f"{score.upper()}_RANGE": _out_of_range(score) for score in scores},
        "RISK_LEVEL_KNOWN": ~F.coalesce(F.col("risk_level").isin(*LEVELS), F.lit(False)),
        "COMPOSITE_MISSING": F.col("composite_risk_score").isNull(),
    }


def climate_rules() -> dict[str, Column]:
    return {
        "AVG_MAX_AT_LEAST_AVG_MIN": F.col("avg_temp_max") < F.col("avg_temp_min"),
        "VARIABILITY_NOT_NEGATIVE": (F.col("observed_days") > 0) & ~(F.col("climate_variability_index") >= 0),
        "MONTH_WITHOUT_OBSERVATIONS": F.col("observed_days") == 0,
    }


def event_rules() -> dict[str, Column]:
    types = [detector.event_type for detector in DETECTORS]
    return {
        "EVENT_TYPE_KNOWN": ~F.col("event_type").isin(*types),
        "SEVERITY_KNOWN": ~F.col("event_severity").isin(*SEVERITIES),
        "EXCEEDANCE_NOT_NEGATIVE": F.col("exceedance_pct") < 0,
    }


#: Rules whose violation is news, not a defect: rows like these are published.
REPORTED = ("COMPOSITE_MISSING", "MONTH_WITHOUT_OBSERVATIONS")


class GateClosed(Exception):
    """A table was written but not published, for rows of it break rules."""


class Watched:
    """Rows whose violations are counted while they are written, without a pass of their own.

    A stage that Spark repeats may count rows twice, so a count is exact or too high; where there is
    no violation it is zero in any case.
    """

    def __init__(self, rows: DataFrame, name: str, rules: dict[str, Column]) -> None:
        self.name, self.rules = name, tuple(rules)
        self._found = Observation()
        counts = [F.count_if(F.coalesce(broken, F.lit(False))).alias(rule) for rule, broken in rules.items()]
        self.rows = rows.observe(self._found, F.count(F.lit(1)).alias("checked_rows"), *counts)

    def report(self) -> list[tuple[str, str, int, int]]:
        """``table_name, rule, checked_rows, violations``, once the rows have been written."""
        found = self._found.get
        return [(self.name, rule, found["checked_rows"], found[rule]) for rule in self.rules]

    def check(self) -> None:
        """Raise on any violation that is a defect."""
        broken = {rule: n for _, rule, _, n in self.report() if n and rule not in REPORTED}
        if broken:
            raise GateClosed(f"{self.name}: {broken}")


REPORT_SCHEMA = "table_name string, rule string, checked_rows bigint, violations bigint"


def count_violations(table: DataFrame, name: str, rules: dict[str, Column]) -> DataFrame:
    """Evaluate all rules of a table in one pass; a rule is a predicate for a violation."""
    counts = [F.count_if(broken).alias(rule) for rule, broken in rules.items()]
    totals = table.agg(F.count("*").alias("checked_rows"), *counts)
    pairs = F.array(
        *[F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("violations")) for rule in rules]
    )
    return totals.select(
        F.lit(name).alias("table_name"), "checked_rows", F.explode(pairs).alias("result")
    ).select("table_name", "result.rule", "checked_rows", "result.violations")


def silver_violations(rows: DataFrame) -> DataFrame:
    return count_violations(rows, "silver", silver_rules())


def risk_violations(risk: DataFrame) -> DataFrame:
    return count_violations(risk, "daily_risk", risk_rules())


def climate_violations(climate: DataFrame, entity: str = "city_id") -> DataFrame:
    """Climate rules, checked per city and month so that a duplicate month shows."""
    months = climate.groupBy(entity, "month_number").agg(
        F.count("*").alias("rows"),
        F.max(F.col("avg_temp_max") < F.col("avg_temp_min")).alias("inverted"),
        F.max((F.col("observed_days") > 0) & ~(F.col("climate_variability_index") >= 0)).alias("negative"),
        F.max(F.col("observed_days") == 0).alias("empty"),
    )
    return count_violations(
        months,
        "climate_monthly",
        {
            "ONE_ROW_PER_MONTH": F.col("rows") > 1,
            "AVG_MAX_AT_LEAST_AVG_MIN": F.col("inverted"),
            "VARIABILITY_NOT_NEGATIVE": F.col("negative"),
            "MONTH_WITHOUT_OBSERVATIONS": F.col("empty"),
        },
    )


def event_violations(events: DataFrame) -> DataFrame:
    return count_violations(events, "extreme_events", event_rules())


def invariants(silver: DataFrame, risk: DataFrame, climate: DataFrame, events: DataFrame) -> DataFrame:
    """The report over all four tables. Each table is reduced to one row before the union."""
    reports = [
        silver_violations(silver),
        risk_violations(risk),
        climate_violations(climate),
        event_violations(events),
    ]
    return reduce(DataFrame.unionByName, reports)
