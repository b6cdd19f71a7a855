"""Row rules. One rule list yields both the accept predicate and the reject reasons.

A row with NaN in a compared column satisfies no comparison, so it is neither accepted nor
rejected; ``not_comparable`` finds such rows and the invariant report counts them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numeric import is_above, is_at_least

PAYLOAD_SOURCE = "$.data.daily"


@dataclass(frozen=True)
class Present:
    """The column must not be NULL."""

    issue: str
    column: str

    def holds(self) -> Column:
        return F.col(self.column).isNotNull()

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AtLeast:
    """The column must reach ``floor``, a number or another column; ``optional`` lets NULL pass."""

    issue: str
    column: str
    floor: float | str
    optional: bool = False

    def _floor(self) -> Column:
        return F.col(self.floor) if isinstance(self.floor, str) else F.lit(float(self.floor))

    def holds(self) -> Column:
        value, floor = F.col(self.column), self._floor()
        reached = is_at_least(value, floor)
        return (value.isNull() | reached) if self.optional else reached

    def broken(self) -> Column:
        return is_above(self._floor(), F.col(self.column))


Rule = Present | AtLeast

# Issue codes, in the order in which they are reported.
SILVER_RULES: tuple[Rule, ...] = (
    Present("CITY_ID_NULL", "city_id"),
    Present("DATE_NULL", "date"),
    Present("TEMP_MAX_NULL", "temperature_2m_max"),
    Present("TEMP_MIN_NULL", "temperature_2m_min"),
    Present("PRECIPITATION_NULL", "precipitation_sum"),
    AtLeast("TEMP_MAX_LT_TEMP_MIN", "temperature_2m_max", "temperature_2m_min"),
    AtLeast("PRECIPITATION_NEGATIVE", "precipitation_sum", 0),
    AtLeast("WINDSPEED_NEGATIVE", "windspeed_10m_max", 0, optional=True),
)

# The Gold tables filter more strictly than Silver, each in its own way.
CLIMATE_RULES: tuple[Rule, ...] = (*SILVER_RULES, Present("WINDSPEED_NULL", "windspeed_10m_max"))
EVENT_RULES: tuple[Rule, ...] = (
    *CLIMATE_RULES,
    Present("CITY_NAME_NULL", "city_name"),
    Present("WEATHERCODE_NULL", "weathercode"),
)


def accept(rows: DataFrame, rules: Sequence[Rule] = SILVER_RULES) -> DataFrame:
    """Rows on which every rule holds. Plain predicates, so the scan can push them down."""
    return rows.filter(reduce(and_, [rule.holds() for rule in rules]))


def any_broken(rules: Sequence[Rule] = SILVER_RULES) -> Column:
    """True where at least one rule is broken."""
    return reduce(or_, [rule.broken() for rule in rules])


def issue_text(rules: Sequence[Rule] = SILVER_RULES) -> Column:
    """Codes of the broken rules in rule order, joined by ``|``."""
    codes = F.array_compact(F.array(*[F.when(rule.broken(), F.lit(rule.issue)) for rule in rules]))
    return F.concat_ws("|", codes)


def quarantine(
    rows: DataFrame, rules: Sequence[Rule] = SILVER_RULES, rejected_at: Column | None = None
) -> DataFrame:
    """Rows that break a rule, with their reasons, in the shape of the quarantine log.

    Every call reports all rejects of its input; see ``incremental.new_rejects`` to log once.
    """
    return rows.filter(any_broken(rules)).select(
        "city_id",
        "city_name",
        "date",
        issue_text(rules).alias("quality_issue"),
        "payload_source",
        "extraction_timestamp_utc",
        (F.current_timestamp() if rejected_at is None else rejected_at).alias("rejected_at_utc"),
    )


def not_comparable(columns: Sequence[str]) -> Column:
    """True where any of the double columns is NaN."""
    return reduce(or_, [F.isnan(column) for column in columns])
