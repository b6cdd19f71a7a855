"""Landed files to Silver as a stream: each run reads only files that no earlier run read.

The batch refresh parses all staged payloads every time. Here the checkpoint remembers the files
seen. A micro-batch may be replayed after a failure; all its appends are one batch, and the inserts
consult their targets, so a replay adds what is missing and nothing else. Gold needs whole-history baselines and stays a batch rebuild.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators.daily import parse_daily, typed_daily
from skyledger.operators.envelope import dedup_staging, envelope_fields, rejected, staging_rows, valid
from skyledger.operators.incremental import within
from skyledger.plans.medallion import Layers, create_silver, insert_parsed, log_new
from skyledger.sources.bronze import (
    FILE_OPTIONS,
    FILE_SCHEMA,
    LINE_OPTIONS,
    LINE_SCHEMA,
    file_columns,
    line_columns,
    require_directory,
)
from skyledger.sources.commits import Batch
from skyledger.sources.tables import written_once


def landing_stream(
    spark: SparkSession,
    root: str,
    store_uri: str,
    checkpoint: str,
    layers: Layers = Layers(),
    *,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start a query that stages and inserts all new files, then stops.

    It reads what ``read_landing`` reads: ``*.json`` files and lines of ``part-*.txt`` files, at most
    ``max_files`` of either in a micro-batch. A checkpoint from before the lines were read has one
    source and does not resume; with a new one, files that are staged already add nothing. It writes in a session of its own: refresh the tables before reading them in yours.
    """
    require_directory(spark, root)
    create_silver(spark, layers)
    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).options(**FILE_OPTIONS)
    lines = spark.readStream.format("text").schema(LINE_SCHEMA).options(**LINE_OPTIONS)
    if max_files is not None:
        files = files.option("maxFilesPerTrigger", max_files)
        lines = lines.option("maxFilesPerTrigger", max_files)
    landed = file_columns(files.load(root)).unionByName(line_columns(lines.load(root)))
    checked = envelope_fields(landed)

    def insert(landed: DataFrame, _: int) -> None:
        session = landed.sparkSession
        with written_once(landed) as files, Batch(session, layers.batches) as batch:
            # A bad file is logged, and those behind it go on.
            log_new(rejected(files), layers.landing_rejects, ("path", "payload_sha256"), batch)
            documents = staging_rows(valid(files), store_uri)
            staged = within(batch.visible(layers.raw), documents, "extraction_date", "extraction_date")
            new = batch.add(dedup_staging(documents, staged), layers.raw, ("extraction_date",))
            insert_parsed(typed_daily(parse_daily(new)), layers, batch, log_once=True)

    return (
        checked.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
