"""Every registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.functions.location import bucket_name
from isotherm.operators.detect import detect_format, format_by_content, format_by_name
from isotherm.operators.lookup import missing_objects, read_objects
from isotherm.operators.notifications import dead_letter_counts, dead_letters, parse_notifications, route_events
from isotherm.operators.observations import parse_files, valid_observations
from isotherm.operators.outcomes import split_file_outcomes, split_file_rows, summary_rows
from isotherm.operators.payloads import number_payloads, payload_files
from isotherm.operators.summarize import daily_extremes
from isotherm.plans.adhoc import run_sql
from isotherm.plans.ingest import (
    ingest_files,
    ingest_notifications,
    ingest_payloads,
    notification_misses,
    notification_outcomes,
)
from isotherm.queries import tables as t
from isotherm.schemas import SUMMARY_COLUMNS
from isotherm.session import scratch_path
from isotherm.sinks.table import APPEND, CREATE_AND_DEDUPE, create_table, write_outcomes
from isotherm.sources.files import read_object_files, scan_delimited
from isotherm.sources.json_splits import scan_json
from isotherm.sources.splits import few_tasks
from isotherm.sources.xml_splits import scan_xml
from isotherm.streaming.jobs import TRIM_HORIZON, stream_files, stream_notifications, stream_payloads

OUTCOME_COLUMNS = ["status", "records_processed", "records_written"]


# --- summaries --------------------------------------------------------------


def daily_extremes_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_extremes(t.observations(spark, sf_dir))


def daily_extremes_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_extremes(t.observations(spark, sf_dir), ["user_id"])


# --- files of each format ---------------------------------------------------


def _rows(files: DataFrame) -> DataFrame:
    return summary_rows(ingest_files(files), "object_name")


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(t.csv_files(t.observations(spark, sf_dir)))


def tsv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(t.tsv_files(t.observations(spark, sf_dir)))


def json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(t.json_files(t.observations(spark, sf_dir)))


def xml_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(t.xml_files(t.observations(spark, sf_dir)))


def xml_ingest_other_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(t.xml_files(t.observations(spark, sf_dir), "Reading"))


def mixed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary_rows(ingest_files(t.mixed_files(t.observations(spark, sf_dir))), "object_name", "format")


def csv_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_observations(parse_files(t.csv_files(t.observations(spark, sf_dir))))


# --- format detection -------------------------------------------------------


def detect_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    def detected(name: str, key: str, text: str) -> DataFrame:
        source = t.table(spark, sf_dir, name)
        return source.select(F.lit(name).alias("source"), F.expr(key).alias("key"), format_by_content(F.col(text)).alias("format"))

    return (
        detected("documents", "CAST(doc_id AS STRING)", "text")
        .unionByName(detected("pages", "CAST(page_id AS STRING)", "html"))
        .unionByName(detected("events", "CAST(event_id AS STRING)", "props"))
        .unionByName(detected("conversations", "concat(conv_id, '-', turn)", "text"))
    )


NAMES = "array('.csv', '.CSV', '.tsv', '.Tab', '.json', '.JSONL', '.ndjson', '.xml', '.txt', '.csv.gz')"


def detect_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = t.table(spark, sf_dir, "documents").selectExpr(
        "doc_id", f"concat('in/doc-', doc_id, get({NAMES}, CAST(doc_id % 10 AS INT))) AS object_name", "text"
    )
    return named.select(
        "doc_id",
        "object_name",
        format_by_name(F.col("object_name")).alias("named_format"),
        detect_format(F.col("object_name"), F.col("text")).alias("format"),
    )


# --- outcomes ---------------------------------------------------------------


def file_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = ingest_files(t.flawed_csv_files(t.observations(spark, sf_dir)))
    return outcomes.select("object_name", "format", *OUTCOME_COLUMNS, "error_message", F.size("records").alias("row_count"))


def document_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = t.table(spark, sf_dir, "documents").selectExpr("doc_id AS file_id", "text")
    return ingest_files(files).select(
        F.col("file_id").alias("doc_id"), "format", *OUTCOME_COLUMNS, "error_message"
    )


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = t.table(spark, sf_dir, "pages").selectExpr("page_id AS file_id", "html AS text")
    return ingest_files(files).select(F.col("file_id").alias("page_id"), "format", *OUTCOME_COLUMNS)


def props_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = t.table(spark, sf_dir, "events").selectExpr("event_id AS file_id", "props AS text")
    return ingest_files(files).select(F.col("file_id").alias("event_id"), "format", *OUTCOME_COLUMNS)


def _shapes(spark: SparkSession, sf_dir: str, text: str, extension: str) -> DataFrame:
    """Outcomes of a file per event; each row, or the lack of any, beside its file."""
    outcomes = ingest_files(t.event_files(t.observations(spark, sf_dir), text, extension))
    return outcomes.select("object_name", "format", "status", F.expr("inline_outer(records)"))


def json_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shapes(spark, sf_dir, t.JSON_SHAPES, ".json")


def xml_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shapes(spark, sf_dir, t.XML_SHAPES, ".xml")


def csv_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shapes(spark, sf_dir, t.CSV_SHAPES, ".csv")


# --- notifications ----------------------------------------------------------


def parse_notifications_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    notifications = parse_notifications(t.order_messages(spark, sf_dir))
    return notifications.withColumn("bucket", bucket_name(F.col("bucket_url")))


def dead_letters_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letters(t.order_messages(spark, sf_dir)).select("o_orderkey", "dead_reason")


def dead_letter_counts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letter_counts(t.order_messages(spark, sf_dir))


def dead_letter_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text that goes to the log, for messages of several lines."""
    messages = t.table(spark, sf_dir, "orders").selectExpr("o_orderkey", "concat('order\\r\\n', o_orderkey, '\\n') AS value")
    return dead_letters(messages)


def route_events_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_events(t.order_messages(spark, sf_dir), "drops-o").select("o_orderkey")


def read_objects_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_objects(t.customer_notifications(spark, sf_dir), t.document_contents(spark, sf_dir))
    return found.select(
        "o_orderkey", "object_name", F.length("text").alias("chars"), format_by_content(F.col("text")).alias("format")
    )


def missing_objects_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = missing_objects(t.customer_notifications(spark, sf_dir), t.document_contents(spark, sf_dir))
    return missing.select("o_orderkey", "object_name")


def notification_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to outcomes. Each event notifies of its user's file, so files are named many times."""
    rows = t.observations(spark, sf_dir)
    messages = rows.selectExpr(
        "pos AS event_id",
        "to_json(named_struct('source', 'aws.s3', 'detail', named_struct('bucket', named_struct('name', 'drops'), "
        "'object', named_struct('key', concat('user-', user_id, '%2Fpart-', part, '.csv'))))) AS value",
    )
    outcomes = ingest_notifications(messages, t.csv_files(rows).drop("file_id", "user_id"))
    return outcomes.select("event_id", "object_name", "format", "event_source", *OUTCOME_COLUMNS)


# --- payloads ---------------------------------------------------------------


def payload_files_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = t.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("value"))
    numbered = number_payloads(payloads, ["conv_id", "turn"])
    files = payload_files(numbered, "talk")
    return files.select(
        F.col("file_id").alias("sequence"), "bucket_url", "object_name", "event_source", "format", F.length("text").alias("chars")
    )


def payload_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of four formats as payloads without a name, in order of user and part."""
    files = t.mixed_files(t.observations(spark, sf_dir)).select("object_name", F.col("text").alias("value"))
    outcomes = ingest_payloads(files, "weather", ["object_name"])
    return summary_rows(outcomes, "object_name", "format")


# --- tables -----------------------------------------------------------------


def _new_table(spark: SparkSession) -> str:
    """An empty result table with its files in the shared folder."""
    place = scratch_path(spark, "tables")
    namespace = f"isotherm_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {namespace} LOCATION '{place}'")
    return create_table(spark, f"{namespace}.temperature_summary")


def _two_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All files in two batches: those of even users, then those of odd users."""
    files = t.csv_files(t.observations(spark, sf_dir))
    return [ingest_files(files.where(F.col("user_id") % 2 == rest)) for rest in (0, 1)]


def append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _new_table(spark)
    for batch in _two_batches(spark, sf_dir):
        write_outcomes(batch, name, APPEND)
    return spark.table(name)


def dedupe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _new_table(spark)
    for batch in _two_batches(spark, sf_dir):
        write_outcomes(batch, name, CREATE_AND_DEDUPE, order=("file_id",))
    return spark.table(name)


def outcomes_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of which some have failed and write nothing."""
    name = _new_table(spark)
    write_outcomes(ingest_files(t.flawed_csv_files(t.observations(spark, sf_dir))), name, APPEND)
    return spark.table(name)


def existing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return append_table(spark, sf_dir).select("date")


def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = daily_extremes_per_file(spark, sf_dir)
    return run_sql(spark, "SELECT * FROM {summary} ORDER BY date, user_id LIMIT 20", summary=summary)


def rows_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = daily_extremes_per_file(spark, sf_dir)
    return run_sql(spark, "SELECT * FROM {summary} ORDER BY date", summary=summary)


# --- files on storage and streams -------------------------------------------


def _write_csv_files(spark: SparkSession, sf_dir: str) -> str:
    """Write each CSV text as a file of its own; returns the folder."""
    return t.stored(t.csv_files(t.observations(spark, sf_dir)))


def delimited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_file_rows(scan_delimited(spark, _write_csv_files(spark, sf_dir)))
    return rows.select(t.drop_name("file_id").alias("file_name"), *SUMMARY_COLUMNS)


def delimited_scan_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = split_file_outcomes(scan_delimited(spark, _write_csv_files(spark, sf_dir)))
    return outcomes.select(t.drop_name("file_id").alias("file_name"), *OUTCOME_COLUMNS)


def _json_readings(spark: SparkSession, sf_dir: str, flawed: bool = False) -> DataFrame:
    """JSON files of both shapes, their records found by ranges of 64 KiB; with flaws, those of every fifth user are cut short."""
    files = t.json_list_files(t.observations(spark, sf_dir))
    if flawed:
        files = files.withColumn("text", F.expr("CASE WHEN user_id % 5 = 0 THEN left(text, length(text) - 1) ELSE text END"))
    return scan_json(spark, t.stored(files), split_bytes=1 << 16)


def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_file_rows(_json_readings(spark, sf_dir))
    return rows.select(t.drop_name("file_id").alias("file_name"), *SUMMARY_COLUMNS)


def json_scan_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = split_file_outcomes(_json_readings(spark, sf_dir, flawed=True))
    return outcomes.select(t.drop_name("file_id").alias("file_name"), *OUTCOME_COLUMNS, "error_message")


def _xml_readings(spark: SparkSession, sf_dir: str, flawed: bool = False) -> DataFrame:
    """XML files, their records found by ranges of 64 KiB, with a tag that is not the expected one; with flaws, those of every fifth user are cut short."""
    files = t.xml_files(t.observations(spark, sf_dir), tag="Reading")
    if flawed:
        files = files.withColumn("text", F.expr("CASE WHEN user_id % 5 = 0 THEN left(text, length(text) - 1) ELSE text END"))
    return scan_xml(spark, t.stored(files, " "), split_bytes=1 << 16)


def xml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_file_rows(_xml_readings(spark, sf_dir))
    return rows.select(t.drop_name("file_id").alias("file_name"), *SUMMARY_COLUMNS)


def xml_scan_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = split_file_outcomes(_xml_readings(spark, sf_dir, flawed=True))
    message = F.substring("error_message", 1, 22).alias("message_start")
    return outcomes.select(t.drop_name("file_id").alias("file_name"), *OUTCOME_COLUMNS, message)


def _fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of notifications of stored files, which the tasks open by name, and of as many that are not there."""
    root = _write_csv_files(spark, sf_dir)
    stored = few_tasks(read_object_files(spark, root, t.BUCKET, closed=True, pathGlobFilter="part-*").select("object_name"))
    messages = stored.selectExpr(
        "to_json(named_struct('source', 'aws.s3', 'detail', named_struct('bucket', named_struct('name', 'drops'), "
        "'object', named_struct('key', url_encode(object_name))))) AS value"
    )
    store = root if "://" in root else f"file://{root}"
    # The files are listed once for both messages.
    named = messages.selectExpr("explode(array(value, replace(value, 'part-', 'gone-'))) AS value")
    return notification_outcomes(named, location=store)


def fetch_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Text files have no telling name here, so that their content decides.
    outcomes = _fetch(spark, sf_dir).where("read_error IS NULL")
    return summary_rows(outcomes, "object_name").select(t.drop_name("object_name").alias("file_name"), *SUMMARY_COLUMNS)


def fetch_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    misses = notification_misses(_fetch(spark, sf_dir))
    return misses.select(t.drop_name("object_name").alias("file_name"), "event_source", "read_error")


def stream_payload_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, name = _write_csv_files(spark, sf_dir), _new_table(spark)
    query = stream_payloads(
        spark, root, name, scratch_path(spark, "stream"), "weather", mode=APPEND, available_now=True
    )
    query.awaitTermination()
    return spark.table(name)


def stream_payload_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the default mode; which file came first is the file system's matter, so dates alone are compared."""
    root, name = _write_csv_files(spark, sf_dir), _new_table(spark)
    stream_payloads(spark, root, name, scratch_path(spark, "stream"), "weather", available_now=True).awaitTermination()
    return spark.table(name).select("date")


def stream_file_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, name = _write_csv_files(spark, sf_dir), _new_table(spark)
    query = stream_files(
        spark, root, t.BUCKET, name, scratch_path(spark, "stream"), mode=APPEND, available_now=True, pathGlobFilter="part-*"
    )
    query.awaitTermination()
    return spark.table(name)


def stream_notification_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = t.csv_files(t.observations(spark, sf_dir))
    messages = scratch_path(spark, "messages")
    files.selectExpr(
        "to_json(named_struct('source', 'aws.s3', 'detail', named_struct('bucket', named_struct('name', 'drops'), "
        "'object', named_struct('key', object_name)))) AS value"
    ).write.text(messages)
    name = _new_table(spark)
    query = stream_notifications(
        spark,
        messages,
        name,
        scratch_path(spark, "stream"),
        contents=lambda: files.drop("file_id", "user_id"),
        position=TRIM_HORIZON,
        available_now=True,
    )
    query.awaitTermination()
    return spark.table(name)


QUERIES = {
    "daily_extremes": daily_extremes_all,
    "daily_extremes_per_file": daily_extremes_per_file,
    "csv_ingest": csv_ingest,
    "tsv_ingest": tsv_ingest,
    "json_ingest": json_ingest,
    "xml_ingest": xml_ingest,
    "xml_ingest_other_tag": xml_ingest_other_tag,
    "mixed_ingest": mixed_ingest,
    "csv_observations": csv_observations,
    "detect_by_content": detect_by_content,
    "detect_by_name": detect_by_name,
    "file_outcomes": file_outcomes,
    "document_outcomes": document_outcomes,
    "page_outcomes": page_outcomes,
    "props_outcomes": props_outcomes,
    "json_shapes": json_shapes,
    "xml_shapes": xml_shapes,
    "csv_shapes": csv_shapes,
    "parse_notifications": parse_notifications_all,
    "dead_letters": dead_letters_all,
    "dead_letter_counts": dead_letter_counts_all,
    "dead_letter_messages": dead_letter_messages,
    "route_events": route_events_all,
    "read_objects": read_objects_all,
    "missing_objects": missing_objects_all,
    "notification_ingest": notification_ingest,
    "payload_files": payload_files_all,
    "payload_ingest": payload_ingest,
    "append_table": append_table,
    "dedupe_table": dedupe_table,
    "outcomes_table": outcomes_table,
    "existing_dates": existing_dates,
    "latest_rows": latest_rows,
    "rows_by_date": rows_by_date,
    "delimited_scan": delimited_scan,
    "delimited_scan_outcomes": delimited_scan_outcomes,
    "json_scan": json_scan,
    "json_scan_outcomes": json_scan_outcomes,
    "xml_scan": xml_scan,
    "xml_scan_outcomes": xml_scan_outcomes,
    "fetch_ingest": fetch_ingest,
    "fetch_misses": fetch_misses,
    "stream_files": stream_file_arrivals,
    "stream_payload_dates": stream_payload_dates,
    "stream_payloads": stream_payload_files,
    "stream_notifications": stream_notification_messages,
}
