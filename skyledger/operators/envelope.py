"""Payload envelopes: build, validate, and turn into staging rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.casts import safe_date, safe_long, safe_timestamp
from skyledger.functions.jsontext import STRICT, compact, evaluated, member, once, sealed, unsealed
from skyledger.operators.incremental import unseen
from skyledger.sources.bronze import bronze_path
from skyledger.sources.schemas import ENVELOPE_JSON, REQUIRED_META, REQUIRED_RESPONSE

INSERT_ID = ("city_id", "source_type", "extraction_date")


def _response_parts(response: Column) -> Column:
    """Top-level keys of a response with the JSON text of their values; NULL if not an object."""
    read = F.from_json(sealed(response), "array<map<string, string>>", STRICT)
    return once(read, lambda listed: unsealed(listed, response))


def _daily_time(daily: Column) -> Column:
    return F.from_json(daily, "time array<string>").getField("time")


def _time_count(parts: Column) -> Column:
    time = _daily_time(member(parts, "daily"))
    return F.greatest(F.coalesce(F.size(time), F.lit(0)), F.lit(0)).cast("bigint")


def _missing(fields: Column, required: tuple[str, ...]) -> Column:
    """Required keys that are absent. A key that holds null is present."""
    return F.array_except(F.array(*[F.lit(name) for name in required]), F.map_keys(fields))


def _missing_text(label: str, fields: Column, required: tuple[str, ...]) -> Column:
    absent = _missing(fields, required)
    return F.when(F.size(absent) > 0, F.concat(F.lit(f"{label}: "), F.concat_ws(", ", absent)))


def record_count(response: Column) -> Column:
    """Length of ``daily.time``; 0 if it is absent or not an array."""
    return _time_count(_response_parts(response))


def response_error(response: Column) -> Column:
    """First problem of an API response, NULL if it is usable."""
    return once(_response_parts(response), lambda parts: _parts_error(parts, _time_count(parts)))


def _parts_error(parts: Column, records: Column) -> Column:
    return F.coalesce(
        F.when(parts.isNull(), "response is not an object"),
        _missing_text("missing root fields", parts, REQUIRED_RESPONSE),
        F.when(F.coalesce(~member(parts, "daily").startswith("{"), F.lit(True)), "daily is not an object"),
        F.when(records <= 0, "daily.time is not a non-empty array"),
    )


def build_envelopes(
    responses: DataFrame,
    *,
    project: str,
    source_system: str,
    timezone: str,
) -> DataFrame:
    """Wrap each response text with its metadata, leaving the response as it came.

    Adds ``document`` and ``response_error``. A response that cannot be used has an error and no
    document.

    Input columns: city_id, city_name, latitude, longitude, elevation_m, source_type, source_url,
    extraction_date (date), extraction_timestamp_utc (text), response (JSON text).
    """
    read = evaluated(responses, response_parts=_response_parts(F.col("response")))
    read = evaluated(read, response_records=_time_count(F.col("response_parts")))
    meta = F.struct(
        F.lit(project).alias("project"),
        F.lit(source_system).alias("source_system"),
        "source_type",
        F.date_format("extraction_date", "yyyy-MM-dd").alias("extraction_date"),
        "extraction_timestamp_utc",
        "city_id",
        "city_name",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        "elevation_m",
        F.lit(timezone).alias("timezone"),
        "source_url",
        F.col("response_records").alias("record_count"),
    )
    document = F.concat(
        F.lit('{"meta":'),
        F.to_json(meta, {"ignoreNullFields": "false"}),
        F.lit(',"data":'),
        F.col("response"),
        F.lit("}"),
    )
    error = _parts_error(F.col("response_parts"), F.col("response_records"))
    checked = read.withColumn("response_error", error)
    made = checked.withColumn("document", F.when(F.col("response_error").isNull(), document))
    return made.drop("response_parts", "response_records")


def envelope_fields(files: DataFrame) -> DataFrame:
    """Add ``meta`` (key to text) and the first ``error`` of each document, NULL if it is valid.

    A document is parsed once. Only a record count that is no integer text is read again, as a
    number: 12.0 counts, "12.0" does not.
    """
    document = F.col("document")
    listed = F.from_json(sealed(document), ENVELOPE_JSON, STRICT)
    read = evaluated(files, envelope=once(listed, lambda items: unsealed(items, document)))
    count = member(F.col("envelope.meta"), "record_count")
    number = F.from_json(document, "meta struct<record_count: double>")["meta"]["record_count"]
    whole = safe_long(count)
    counted = evaluated(read, records=F.when(whole.isNull() & count.isNotNull(), F.floor(number)).otherwise(whole))
    return counted.select(
        *files.columns,
        F.col("envelope.meta").alias("meta"),
        "records",
        F.col("envelope").isNotNull().alias("whole"),
        F.col("envelope.data").isNotNull().alias("has_data"),
    ).select(*files.columns, "meta", "records", envelope_error().alias("error"))


def envelope_error() -> Column:
    """First problem of a document from what was read of it."""
    meta = F.col("meta")
    return F.coalesce(
        F.when(~F.col("whole") | ~F.coalesce(F.col("document").rlike(r"^\s*\{"), F.lit(False)), "document is not an object"),
        F.when(meta.isNull(), "no object under meta"),
        F.when(~F.col("has_data"), "no object under data"),
        _missing_text("absent from meta", meta, REQUIRED_META),
        F.when(F.col("records").isNull(), "record_count is not an integer"),
        F.when(safe_date(member(meta, "extraction_date")).isNull(), "extraction_date is not a date"),
        F.when(
            safe_timestamp(member(meta, "extraction_timestamp_utc")).isNull(),
            "extraction_timestamp_utc is not a timestamp",
        ),
    )


def valid(checked: DataFrame) -> DataFrame:
    """The valid documents."""
    return checked.filter("error IS NULL")


def rejected(checked: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    """One log row per invalid document."""
    moment = F.current_timestamp() if rejected_at is None else rejected_at
    return checked.filter("error IS NOT NULL").select(
        "path", "source_file_name", "payload_sha256", "error", moment.alias("rejected_at_utc")
    )


def require_valid(checked: DataFrame) -> DataFrame:
    """Fail the job on the first invalid document, whatever columns the job needs.

    The check is a filter: no projection can prune it away.
    """
    stop = F.raise_error(F.concat_ws(": ", F.col("path"), F.col("error"))).cast("boolean")
    return checked.filter(F.when(F.col("error").isNull(), F.lit(True)).otherwise(stop))


def staging_rows(
    checked: DataFrame,
    store_uri: str,
    prefix: str = "",
    uploaded_at: Column | None = None,
    with_path: bool = False,
) -> DataFrame:
    """Rows of the raw staging table from valid documents.

    Metadata is staged as text, so a null name becomes the text 'None'; Silver reads the name
    from the payload, where it is still null.
    """
    meta = F.col("meta")

    def text(name: str) -> Column:
        return F.coalesce(member(meta, name), F.lit("None"))

    path = bronze_path(
        text("source_type"), text("city_id"), text("extraction_date"), F.col("source_file_name"), prefix
    )
    return checked.select(
        text("source_type").alias("source_type"),
        text("city_id").alias("city_id"),
        text("city_name").alias("city_name"),
        safe_date(member(meta, "extraction_date")).alias("extraction_date"),
        safe_timestamp(member(meta, "extraction_timestamp_utc")).alias("extraction_timestamp_utc"),
        F.col("records").alias("record_count"),
        F.concat_ws("/", F.lit(store_uri.rstrip("/")), path).alias("gcs_uri"),
        "source_file_name",
        "payload_sha256",
        compact(F.col("document")).alias("payload"),
        (F.current_timestamp() if uploaded_at is None else uploaded_at).alias("uploaded_at_utc"),
        *(["path"] if with_path else []),
    )


def dedup_staging(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per insert id (city, source type, extraction date), and none already staged.

    The first document by Bronze path wins. That is decided from the id, path and checksum alone;
    the documents are then taken by their path, so a payload moves once at most, and not at all
    while Spark finds the decisions small enough to broadcast. Ids with nulls are never equal to
    staged ones, like any keys. Give a written batch: it is read twice.
    """
    kept = _first_by_path(batch.select(*_DECIDES))
    if existing is not None:
        kept = unseen(kept, existing, INSERT_ID)
    taken = _matching(batch, kept.select(*_DECIDES), "left_semi")
    # A listing gives each path once. A document that came twice all the same is taken once.
    again = batch.groupBy(*_DECIDES).count().filter("count > 1").select(*_DECIDES)
    return _matching(taken, again, "left_anti").unionByName(_first_by_path(_matching(taken, again, "left_semi")))


_DECIDES = (*INSERT_ID, "gcs_uri", "payload_sha256")


def _matching(documents: DataFrame, decided: DataFrame, how: str) -> DataFrame:
    left, right = documents.alias("documents"), decided.alias("decided")
    same = [F.col(f"documents.{c}").eqNullSafe(F.col(f"decided.{c}")) for c in _DECIDES]
    return left.join(right, same, how)


def dropped_documents(batch: DataFrame, logged_at: Column | None = None) -> DataFrame:
    """Documents that share an insert id with the one that is kept, with both checksums."""
    narrow = batch.select(*_DECIDES).distinct()
    order = Window.partitionBy(*INSERT_ID).orderBy("gcs_uri", "payload_sha256")
    ranked = narrow.select(
        *narrow.columns,
        F.row_number().over(order).alias("rank"),
        F.first("gcs_uri").over(order).alias("kept_uri"),
        F.first("payload_sha256").over(order).alias("kept_sha256"),
    )
    moment = F.current_timestamp() if logged_at is None else logged_at
    return ranked.filter("rank > 1").drop("rank").withColumn("logged_at_utc", moment)


def _first_by_path(documents: DataFrame) -> DataFrame:
    order = Window.partitionBy(*INSERT_ID).orderBy("gcs_uri", "payload_sha256")
    return documents.withColumn("rank", F.row_number().over(order)).filter("rank = 1").drop("rank")
