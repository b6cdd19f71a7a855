"""Helpers that the operators share: narrow inputs, scratch tables, Arrow batches."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.session import shared_dir

#: A-Z to a-z on UTF-8 bytes; bytes of other letters are above 0x7F and stay.
LOWER_ASCII = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

#: Rows that one step of an Arrow loop holds as Python objects.
SLICE = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Python workers of a local session find this package as well."""
    paths = spark.sparkContext.environment.setdefault("PYTHONPATH", "").split(os.pathsep)
    if (root := str(Path(__file__).parents[2])) not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns ``doc_id`` and ``text`` alone, so that no other column can clash."""
    return docs.select(
        quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text")
    )


def row_key() -> Column:
    """Tells rows apart that share a doc_id. Equal rows have equal keys and equal verdicts."""
    return F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")), F.col("text").isNull())


def keyed_rows(docs: DataFrame) -> DataFrame:
    """``row_key`` and the whole ``row`` as a struct, so that no column of it can clash."""
    return docs.select(
        row_key().alias("row_key"), F.struct(*(quoted(c) for c in docs.columns)).alias("row")
    )


def with_text(rows: DataFrame, columns: list[str], text: Column, changed: Column) -> DataFrame:
    """The columns of ``row`` with ``text`` where it changed; ``n_chars``, if there, follows it."""
    fresh = {"text": text, "n_chars": F.length(text).cast("long")}
    old = F.col("row")
    return rows.select(
        *(
            (F.when(changed, fresh[c]).otherwise(old[c]) if c in fresh else old[c]).alias(c)
            for c in columns
        )
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, grouped by application so that it can be dropped."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/llm-{app}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file system client."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(spark: SparkSession) -> None:
    """Drop all scratch tables of this application, once its results have been written."""
    app = spark.sparkContext.applicationId
    drop_folder(spark, f"{shared_dir(spark).rstrip('/')}/llm-{app}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once into a scratch table; a lost executor costs a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now, not at some later collection.

    Spark drops a shuffle once nothing in the driver refers to it any more.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def map_slices(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: StructType | str
) -> DataFrame:
    """Apply ``work`` to every slice of at most ``SLICE`` rows of the Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                out = work(batch.slice(at, SLICE))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of a column as UTF-8 bytes; None where null."""
    return column.cast(pa.binary()).to_pylist()


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
