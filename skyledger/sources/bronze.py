"""Landed JSON files: reading, city configuration, Bronze layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.casts import safe_double
from skyledger.functions.jsontext import compact, without_bom
from skyledger.sources.schemas import REQUIRED_CITY

FILE_OPTIONS = {"recursiveFileLookup": "true", "pathGlobFilter": "*.json"}
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
LINE_OPTIONS = {"recursiveFileLookup": "true", "pathGlobFilter": "part-*.txt"}
LINE_SCHEMA = "value string"


def require_directory(spark: SparkSession, root: str) -> None:
    """Fail if ``root`` is missing or is a file."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        raise FileNotFoundError(f"no folder to read: {root}")
    if not system.getFileStatus(path).isDirectory():
        raise NotADirectoryError(f"a folder is needed, this is a file: {root}")


def file_columns(files: DataFrame) -> DataFrame:
    """Path, name, checksum and text of each file of a binary scan.

    The checksum covers the bytes as landed. Text that is not valid UTF-8 is NULL.
    """
    text = F.try_validate_utf8(F.col("content").cast("string"))
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("source_file_name"),
        F.sha2("content", 256).alias("payload_sha256"),
        without_bom(text).alias("document"),
    )


def line_columns(lines: DataFrame) -> DataFrame:
    """The same columns of each line of a text scan that is not blank.

    A line's path is that of its file and its checksum.
    """
    sha = F.sha2(F.col("value").cast("binary"), 256)
    return lines.filter(F.trim("value") != "").select(
        F.concat_ws("#", "_metadata.file_path", sha).alias("path"),
        F.concat(F.substring(sha, 1, 16), F.lit(".json")).alias("source_file_name"),
        sha.alias("payload_sha256"),
        without_bom(F.try_validate_utf8("value")).alias("document"),
    )


def landed_bytes(spark: SparkSession, root: str) -> DataFrame:
    """``path`` and ``content`` of every landed document, as ``read_landing`` names them."""
    files = spark.read.format("binaryFile").options(**FILE_OPTIONS).load(root).select("path", "content")
    lines = spark.read.options(**LINE_OPTIONS).text(root)
    content = F.col("value").cast("binary")
    path = F.concat_ws("#", "_metadata.file_path", F.sha2(content, 256))
    return files.unionByName(lines.select(path.alias("path"), content.alias("content")))


def read_landing(spark: SparkSession, root: str) -> DataFrame:
    """All documents below ``root``: whole ``*.json`` files, and lines of ``part-*.txt`` files.

    The latter are what ``write_landing`` makes; blank lines hold no document.
    """
    require_directory(spark, root)
    files = file_columns(spark.read.format("binaryFile").options(**FILE_OPTIONS).load(root))
    return files.unionByName(line_columns(spark.read.options(**LINE_OPTIONS).text(root)))


def load_cities(spark: SparkSession, path: str) -> DataFrame:
    """City configuration rows; raises on a missing list, field or coordinate.

    Extra fields are ignored and ``elevation_m`` may be absent.
    """
    text = without_bom(F.col("value"))
    config = spark.read.text(path, wholetext=True).select(
        F.from_json(text, "cities array<string>").getField("cities").alias("cities")
    )
    if config.filter(F.size("cities") > 0).isEmpty():
        raise ValueError(f"{path}: 'cities' is not a list with entries")
    records = config.select(F.posexplode("cities").alias("position", "record")).select(
        (F.col("position") + 1).alias("position"),
        F.from_json("record", "map<string, string>").alias("city"),
    )
    keys = F.map_keys("city")
    missing = F.array_except(F.array(*[F.lit(name) for name in REQUIRED_CITY]), keys)
    latitude, longitude = safe_double(F.col("city.lat")), safe_double(F.col("city.lon"))
    problem = (
        F.when(F.col("city").isNull(), "is no object")
        .when(F.size(missing) > 0, F.concat(F.lit("lacks "), F.concat_ws(", ", missing)))
        .when(latitude.isNull() | longitude.isNull(), "lies at no place: lat or lon is no number")
    )
    bad = records.select("position", problem.alias("problem")).filter("problem IS NOT NULL")
    first = bad.orderBy("position").first()
    if first is not None:
        raise ValueError(f"{path}: entry {first.position} {first.problem}")
    return records.select(
        F.col("city.id").alias("city_id"),
        F.col("city.name").alias("city_name"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        safe_double(F.col("city.elevation_m")).alias("elevation_m"),
    )


def bronze_path(
    source_type: Column, city_id: Column, extraction_date: Column, file_name: Column, prefix: str = ""
) -> Column:
    """``[prefix/]source_type/city_id/YYYY/MM/DD/file``; the date is taken as text, part by part."""
    parts = [source_type, city_id, F.replace(extraction_date, F.lit("-"), F.lit("/")), file_name]
    head = prefix.strip("/")
    return F.concat_ws("/", *([F.lit(head)] if head else []), *parts)


def landing_path(city_id: Column, extraction_date: Column, source_type: Column) -> Column:
    """``city_id/YYYY/MM/DD/source_YYYYMMDD.json``, where extraction lands a document."""
    return F.concat_ws(
        "/",
        city_id,
        F.date_format(extraction_date, "yyyy/MM/dd"),
        F.concat(source_type, F.lit("_"), F.date_format(extraction_date, "yyyyMMdd"), F.lit(".json")),
    )


def write_partitioned(documents: DataFrame, root: str, columns: tuple[str, ...], mode: str = "append") -> None:
    """Documents as parquet folders by ``columns``.

    The rebalance hint sends each folder to few tasks and splits a folder that is too large for
    one, so neither many small files nor one overlong task results.
    """
    documents.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(root)


def write_landing(envelopes: DataFrame, root: str, mode: str = "append") -> None:
    """Usable envelopes as text under city, year, month and day of extraction, one a line.

    JSON text has no line ends outside white space, so a document is compacted to fit its line.
    """
    lines = envelopes.filter("document IS NOT NULL").select(
        compact(F.col("document")).alias("value"), "city_id", *_date_parts()
    )
    folders = ("city_id", "extraction_year", "extraction_month", "extraction_day")
    lines.hint("rebalance", *folders).write.mode(mode).partitionBy(*folders).text(root)


def write_bronze(files: DataFrame, root: str) -> None:
    """Landed bytes with their checksum under source type, city, year, month and day.

    ``files`` has gcs_uri, payload_sha256, content, source_type, city_id and extraction_date. The
    files of a folder hold many documents; ``read_bronze`` finds one by its uri, once.
    """
    dated = files.select("gcs_uri", "payload_sha256", "content", "source_type", "city_id", *_date_parts())
    folders = ("source_type", "city_id", "extraction_year", "extraction_month", "extraction_day")
    write_partitioned(dated, root, folders)


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Stored documents, one per uri and checksum however often a rerun stored them."""
    stored = spark.read.option("recursiveFileLookup", "true").schema(BRONZE_SCHEMA).parquet(root)
    return stored.dropDuplicates(["gcs_uri", "payload_sha256"])


BRONZE_SCHEMA = "gcs_uri string, payload_sha256 string, content binary"


def _date_parts() -> list[Column]:
    return [
        F.date_format("extraction_date", pattern).alias(f"extraction_{part}")
        for part, pattern in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))
    ]
