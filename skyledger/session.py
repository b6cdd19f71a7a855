"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "skyledger", cores: int | str = "*", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster pass your own session instead."""
    threads = 8 if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(threads))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, readable from every executor.

    Only a local session that names none gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="skyledger-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def keep(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and cut its lineage there.

    For small results of a wide scan, such as one row per entity, that are both counted and
    joined: a lost executor then costs a re-read, not a second pass over the facts.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
