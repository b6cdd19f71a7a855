"""Casts that yield NULL instead of failing, accepting only canonical text.

``try_cast`` alone is too generous: it takes '1.5d' as a double and '2024-01' as a date. Each
helper first checks the text with one short pattern, then casts. Ordinary values meet one pattern
only, as every value of every payload passes here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cast itself rejects what is made of these characters and still is no number.
_DECIMAL_CHARACTERS = r"^[0-9.eE+\-\s]+$"
_INFINITY_TEXT = r"(?i)^\s*[+-]?inf(inity)?\s*$"
_NAN_TEXT = r"(?i)^\s*[+-]?nan\s*$"
_INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
_DAY_ONLY = r"^\d{4}-\d{2}-\d{2}$"
_NO_SECONDS = r"^(.{10}[T ]\d{2}:\d{2})(?=$|Z|[+-])"
_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"
_STAMP_TEXT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
_DATE_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}$"


def safe_double(text: Column) -> Column:
    """Text to double; decimal, exponent, infinity and NaN spellings, anything else NULL."""
    number = text.try_cast("double")
    return (
        F.when(text.rlike(_DECIMAL_CHARACTERS), number)
        .when(text.rlike(_INFINITY_TEXT), number)
        .when(text.rlike(_NAN_TEXT), F.lit(float("nan")))
    )


def safe_long(text: Column) -> Column:
    """Text to bigint; '95.0' is not an integer and out-of-range values are NULL."""
    return F.when(text.rlike(_INTEGER_TEXT), text.try_cast("bigint"))


def safe_date(text: Column) -> Column:
    """Text to date; only year-month-day, with one or two digits for month and day."""
    return F.when(text.rlike(_DATE_TEXT) & ~text.startswith("0000"), text.try_cast("date"))


def safe_timestamp(text: Column) -> Column:
    """ISO text to timestamp, NULL when it does not parse. Without an offset it is in UTC."""
    stamp = F.when(text.rlike(_DAY_ONLY), F.concat(text, F.lit("T00:00:00"))).otherwise(
        F.regexp_replace(text, _NO_SECONDS, "$1:00")
    )
    zoned = F.when(stamp.rlike(_OFFSET), stamp).otherwise(F.concat(stamp, F.lit("Z")))
    return F.when(text.rlike(_STAMP_TEXT), zoned.try_cast("timestamp"))
