"""The city dimension of a configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.labels import city_key
from skyledger.sources.dimensions import CITY_COLUMNS, cities_dim


def configured_cities(configured: DataFrame) -> DataFrame:
    """Rows of ``load_cities`` in the shape of the dimension, one for each city key.

    The key is the one that daily rows have, which comes from the name. Department and region are
    known of the built-in cities only. Of names with one key the first in id order counts.
    """
    keyed = configured.withColumn("key", city_key(F.col("city_name")))
    known = cities_dim(configured.sparkSession).select(F.col("city_id").alias("key"), "department", "region")
    one = keyed.groupBy("key").agg(
        F.min_by(F.struct("city_name", "latitude", "longitude", "elevation_m"), "city_id").alias("city")
    )
    return one.join(F.broadcast(known), "key", "left").select(
        F.col("key").alias("city_id"),
        "city.city_name",
        "city.latitude",
        "city.longitude",
        F.round("city.elevation_m").cast("bigint").alias("elevation_m"),
        "department",
        "region",
    ).select(*CITY_COLUMNS)
