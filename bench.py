"""Time the headline queries on ``$BENCH_SF_DIR`` and print one JSON line.

Each query is built, planned and fully computed into the no-op sink. The value per query is the
median of ``$BENCH_RUNS`` runs after one warm-up run. Queries of the registry derive their weather
rows from ``orders`` and so time that too; those named ``stored_`` read a Silver table of several
files instead, ``insert_into_history`` adds one day to it, and ``files_to_gold`` runs the whole
batch from landed files.
"""

from __future__ import annotations

import json
import os
import statistics
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.climate import climate_monthly
from skyledger.operators.events import extreme_events
from skyledger.operators.incremental import unseen, within
from skyledger.operators.quality import accept
from skyledger.operators.risk import daily_risk
from skyledger.plans import fixture
from skyledger.plans.medallion import Layers, run_all
from skyledger.plans.workload import QUERIES
from skyledger.session import build_session, shared_dir
from skyledger.sources.bronze import write_landing
from skyledger.sources.dimensions import cities_dim

HEADLINE = (
    "daily_risk",
    "temp_ladder",
    "climate_monthly",
    "extreme_events",
    "silver_accept",
    "quarantine",
    "silver_incremental",
    "parse_daily",
    "raw_stage",
    "raw_dedup",
    "dq_invariants",
    "json_scalar",
    "round2",
    "payload_sha",
    "stored_daily_risk",
    "stored_climate",
    "stored_events",
    "insert_into_history",
    "files_to_gold",
)


def stored_queries(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """Runs over stored tables: Silver foldered by year in several files, and landed files."""
    root = f"{shared_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex}"
    rows = accept(fixture.typed_observations(spark, folder)).withColumn("day", F.col("date"))
    rows.repartition(8).write.partitionBy("year").parquet(f"{root}/silver")
    write_landing(fixture.envelopes(spark, folder), f"{root}/landing")
    clean = spark.read.parquet(f"{root}/silver")
    one_day = clean.filter(F.col("date") == clean.agg(F.max("date")).first()[0])

    def insert() -> DataFrame:
        return unseen(one_day, within(clean, one_day, "year", "date"), ("city_id", "date", "obs_id"))

    def batch() -> DataFrame:
        tag = uuid.uuid4().hex[:8]
        layers = Layers(f"silver_{tag}", f"gold_{tag}")
        run_all(spark, f"{root}/landing", "store://bronze", layers)
        return spark.table(layers.risk)

    return {
        "stored_daily_risk": lambda: daily_risk(clean, cities_dim(spark)),
        "stored_climate": lambda: climate_monthly(clean, cities_dim(spark)),
        "stored_events": lambda: extreme_events(clean),
        "insert_into_history": insert,
        "files_to_gold": batch,
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session("skyledger-bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    stored = stored_queries(spark, folder) if set(keys) - set(QUERIES) else {}
    seconds = {}
    for key in keys:
        times = []
        for _ in range(1 + (1 if key == "files_to_gold" else runs)):
            start = time.perf_counter()
            rows = stored[key]() if key in stored else QUERIES[key](spark, folder)
            rows.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[key] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
                "runs": runs,
                "cores": spark.sparkContext.defaultParallelism,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
