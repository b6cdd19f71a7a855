"""Payload documents to typed daily rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.casts import safe_date, safe_double, safe_long
from skyledger.functions.jsontext import evaluated, needs_tree, nested_elements, scalar_array, scalar_only
from skyledger.functions.labels import city_key, season_en
from skyledger.operators.quality import PAYLOAD_SOURCE
from skyledger.sources.schemas import DAILY_VARIABLES, LONG_VARIABLES, PAYLOAD_JSON


def parse_daily(raw: DataFrame) -> DataFrame:
    """One row per element of ``data.daily.time``, with the variables at the same position.

    The document is parsed once. A variable that is missing, too short or not castable gives
    NULL; a document without a ``time`` array gives no rows. The city key comes from
    ``meta.city_name``, not from the staged ``city_id``.
    """
    read = evaluated(
        raw.select("extraction_timestamp_utc", "payload"), doc=F.from_json("payload", PAYLOAD_JSON)
    )
    city, time = F.col("doc.meta.city_name"), F.col("doc.data.daily.time")
    variables = [F.col(f"doc.data.daily.{name}") for name in DAILY_VARIABLES]
    # Types matter to values that look like containers only; few documents have a second parse.
    typed = F.when(needs_tree([city], [time, *variables]), F.try_parse_json("payload"))
    tree = F.col("tree")
    parsed = evaluated(read, tree=typed).select(
        "extraction_timestamp_utc",
        scalar_only(city, tree, "$.meta.city_name").alias("city_name"),
        F.zip_with(
            time,
            nested_elements(time, tree, "$.data.daily.time"),
            lambda day, nested: F.when(~F.coalesce(nested, F.lit(False)), day),
        ).alias("time"),
        *[
            scalar_array(items, tree, f"$.data.daily.{name}").alias(name)
            for name, items in zip(DAILY_VARIABLES, variables, strict=True)
        ],
    )
    # An inner explode makes the optimizer filter on the array below the parse, which parses again.
    days = parsed.select("*", F.posexplode_outer("time").alias("position", "day")).filter("position IS NOT NULL")
    return days.select(
        city_key(F.col("city_name")).alias("city_id"),
        "city_name",
        safe_date(F.col("day")).alias("date"),
        *[_value(name).alias(name) for name in DAILY_VARIABLES],
        "extraction_timestamp_utc",
        F.lit(PAYLOAD_SOURCE).alias("payload_source"),
    )


def _value(name: str) -> Column:
    text = F.get(F.col(name), F.col("position"))
    return safe_long(text) if name in LONG_VARIABLES else safe_double(text)


def typed_daily(parsed: DataFrame) -> DataFrame:
    """Add year, month and the English season of the date."""
    month = F.month("date")
    return parsed.select(
        "city_id",
        "city_name",
        "date",
        *DAILY_VARIABLES,
        F.year("date").cast("bigint").alias("year"),
        month.cast("bigint").alias("month"),
        season_en(month).alias("season"),
        "extraction_timestamp_utc",
        "payload_source",
    )
