"""Weather observations derived from the ``orders`` table, and payload documents made of them.

``OBS_SQL`` is plain SQL that Spark and the checking engine both run, so both see the same rows.
Every obs row is one order, which makes the work grow with the given table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.labels import city_key, season_en
from skyledger.functions.numeric import round2
from skyledger.operators.envelope import build_envelopes
from skyledger.operators.quality import PAYLOAD_SOURCE
from skyledger.sources.bronze import landing_path
from skyledger.sources.schemas import DAILY_VARIABLES, DOUBLE_VARIABLES, LONG_VARIABLES

OBS_SQL = """
SELECT k AS obs_id,
  CASE k % 9 WHEN 0 THEN 'Santa Cruz de la Sierra' WHEN 1 THEN 'La Paz' WHEN 2 THEN 'Cochabamba' WHEN 3 THEN 'Sucre'
    WHEN 4 THEN 'ORURO' WHEN 5 THEN 'Tarija' WHEN 6 THEN 'La Paz' WHEN 7 THEN 'Villa Montes'
    ELSE CASE WHEN k % 27 = 8 THEN NULL ELSE 'Tarija' END END AS city_name,
  CASE WHEN k % 50 = 0 THEN 'solo_' || CAST(k AS VARCHAR(20)) ELSE 'st_' || CAST(k % 20 AS VARCHAR(20)) END AS station_id,
  CASE WHEN k % 5 = 0 THEN 'forecast' ELSE 'historical' END AS source_type,
  CASE WHEN k % 211 = 5 OR (k % 9 IN (3, 6) AND month(d) IN (2, 3)) OR (k % 9 = 3 AND month(d) = 8 AND k % 16 <> 0) THEN NULL ELSE d END AS date,
  CASE WHEN k % 97 = 1 THEN NULL ELSE CAST(p % 610 AS DOUBLE) / 10 - 15 END AS temperature_2m_max,
  CASE WHEN k % 89 = 2 THEN NULL ELSE CAST(p % 610 AS DOUBLE) / 10 - 15 - (CAST(floor(p / 610) AS BIGINT) % 200 - 10) / CAST(10 AS DOUBLE) END AS temperature_2m_min,
  CASE WHEN k % 5 = 0 OR k % 3 = 0 THEN NULL ELSE CAST(p % 610 AS DOUBLE) / 10 - 20 END AS temperature_2m_mean,
  CASE WHEN k % 83 = 3 THEN NULL ELSE CAST((p * 7) % 1250 AS DOUBLE) / 10 - 2 END AS precipitation_sum,
  CASE WHEN k % 31 = 4 THEN NULL ELSE CAST((p * 11) % 1040 AS DOUBLE) / 10 - 1 END AS windspeed_10m_max,
  CASE WHEN k % 41 = 6 THEN NULL ELSE CAST(CASE p % 6 WHEN 0 THEN 0 WHEN 1 THEN 61 WHEN 2 THEN 95 WHEN 3 THEN 96 WHEN 4 THEN 99 ELSE 3 END AS BIGINT) END AS weathercode,
  CASE WHEN k % 5 = 0 OR k % 37 = 7 THEN NULL ELSE CAST(p % 90 AS DOUBLE) / 10 END AS et0_fao_evapotranspiration,
  CAST(floor(k / 512) AS BIGINT) AS chunk
FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS p FROM {orders}) o
"""

# Rows of one payload share a chunk, so a payload holds at most 512 rows at any scale.
DOCUMENT_KEY = ("chunk", "city_name", "source_type")
STORE_URI = "store://bronze"
FIRST_EXTRACTION = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(OBS_SQL, orders=table(spark, sf_dir, "orders"))


def typed_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations in the shape of parsed daily rows, with the ids of the fixture."""
    month = F.month("date")
    return observations(spark, sf_dir).select(
        "obs_id",
        "station_id",
        city_key(F.col("city_name")).alias("city_id"),
        "city_name",
        "date",
        *DAILY_VARIABLES,
        F.year("date").cast("bigint").alias("year"),
        month.cast("bigint").alias("month"),
        season_en(month).alias("season"),
        F.lit(None).cast("timestamp").alias("extraction_timestamp_utc"),
        F.lit(PAYLOAD_SOURCE).alias("payload_source"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One API response per chunk, city and source. ``doc_id`` is its first observation.

    Measures are printed with two decimals, as an API does; engines print longer doubles apart.
    """
    measures = [round2(F.col(name)).alias(name) for name in DOUBLE_VARIABLES]
    day = F.struct("obs_id", "date", *measures, *LONG_VARIABLES)
    days = F.sort_array(F.collect_list(day))
    grouped = observations(spark, sf_dir).groupBy(*DOCUMENT_KEY).agg(days.alias("days"))

    def values(name: str) -> Column:
        return F.transform("days", lambda d: d[name])

    def arrays(names: tuple[str, ...]) -> list[Column]:
        time = F.transform("days", lambda d: F.date_format(d["date"], "yyyy-MM-dd"))
        return [time.alias("time"), *[values(name).alias(name) for name in names]]

    forecast_only = tuple(
        name for name in DAILY_VARIABLES if name not in ("temperature_2m_mean", "et0_fao_evapotranspiration")
    )
    doc_id = F.element_at("days", 1)["obs_id"]
    latitude = (F.lit(-100) - doc_id % 90).cast("double") / 10
    longitude = (F.lit(-600) - doc_id % 90).cast("double") / 10

    def body(names: tuple[str, ...]) -> Column:
        daily = F.struct(*arrays(names)).alias("daily")
        return F.to_json(F.struct(latitude.alias("latitude"), longitude.alias("longitude"), daily))

    extraction_date = F.date_add(F.lit(FIRST_EXTRACTION).cast("date"), (F.col("chunk") % 7).cast("int"))
    return grouped.select(
        *DOCUMENT_KEY,
        doc_id.alias("doc_id"),
        city_key(F.col("city_name")).alias("city_id"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        (F.col("chunk") * 10).alias("elevation_m"),
        F.concat(F.lit("https://weather.example/"), F.col("source_type")).alias("source_url"),
        extraction_date.alias("extraction_date"),
        F.concat(F.date_format(extraction_date, "yyyy-MM-dd"), F.lit("T06:00:00+00:00")).alias(
            "extraction_timestamp_utc"
        ),
        F.size("days").cast("bigint").alias("days"),
        F.when(F.col("source_type") == "forecast", body(forecast_only))
        .otherwise(body(DAILY_VARIABLES))
        .alias("response"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_envelopes(
        responses(spark, sf_dir),
        project="skyledger",
        source_system="derived",
        timezone="America/La_Paz",
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes as the reader of landed files returns them."""
    folder = F.coalesce("city_id", F.lit("None"))
    path = landing_path(folder, F.col("extraction_date"), F.col("source_type"))
    name = F.concat(F.element_at(F.split(path, "/"), -1), F.lit("."), F.lpad(F.col("chunk").cast("string"), 12, "0"))
    return envelopes(spark, sf_dir).select(
        "chunk",
        "doc_id",
        path.alias("path"),
        name.alias("source_file_name"),
        F.sha2(F.col("document"), 256).alias("payload_sha256"),
        "document",
    )


def spoiled_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with a defect that depends on the document id."""
    text, defect = F.col("response"), F.col("doc_id") % 7
    spoiled = (
        F.when(defect == 0, F.concat(F.lit("["), text, F.lit("]")))
        .when(defect == 1, F.replace(text, F.lit('"latitude":'), F.lit('"lat":')))
        .when(defect == 2, F.lit('{"latitude":1,"longitude":2,"daily":"none"}'))
        .when(defect == 3, F.lit('{"latitude":1,"longitude":2,"daily":{"time":[]}}'))
        .when(defect == 4, F.lit('{"latitude":1,"longitude":2,"daily":{"time":"2024-01-01"}}'))
        .otherwise(text)
    )
    return responses(spark, sf_dir).withColumn("response", spoiled)


def spoiled_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes with a defect that depends on the document id."""
    text, defect = F.col("document"), F.col("doc_id") % 11
    spoiled = (
        F.when(defect == 0, F.concat(F.lit("["), text, F.lit("]")))
        .when(defect == 1, F.replace(text, F.lit('"meta":{'), F.lit('"head":{')))
        .when(defect == 2, F.replace(text, F.lit('"data":{'), F.lit('"body":{')))
        .when(defect == 3, F.replace(text, F.lit('"city_id":'), F.lit('"town":')))
        .when(defect == 4, F.regexp_replace(text, '"record_count":\\d+', '"record_count":"many"'))
        .when(defect == 5, F.regexp_replace(text, '"extraction_date":"[^"]*"', '"extraction_date":"2024-02-30"'))
        .when(
            defect == 6,
            F.regexp_replace(text, '"extraction_timestamp_utc":"[^"]*"', '"extraction_timestamp_utc":"soon"'),
        )
        .otherwise(text)
    )
    return envelopes(spark, sf_dir).withColumn("document", spoiled)


def loosely_written_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes that a lenient reader takes for something else, by document id."""
    text, defect = F.col("document"), F.col("doc_id") % 8
    spoiled = (
        F.when(defect == 0, F.concat(text, F.lit(" oops")))
        .when(defect == 1, F.concat(text, text))
        .when(defect == 2, F.replace(text, F.lit('"meta":'), F.lit("'meta':")))
        .when(defect == 3, F.regexp_replace(text, '"record_count":(\\d+)', '"record_count":$1.0'))
        .when(defect == 4, F.regexp_replace(text, '"extraction_timestamp_utc":"[^"]*"', '"extraction_timestamp_utc":"2024-05"'))
        .when(defect == 5, F.replace(text, F.lit('"meta":{'), F.lit('"meta":{"city_id":"x",')))
        .when(defect == 6, F.concat(text, F.lit("]")))
        .otherwise(F.concat(F.lit(" \n"), F.replace(text, F.lit('":'), F.lit('" : ')), F.lit("\t ")))
    )
    return envelopes(spark, sf_dir).withColumn("document", spoiled)
