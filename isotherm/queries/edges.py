"""Queries about the edges: bad bytes, broken files, empty results, order, retries, and parts a caller puts in."""

from __future__ import annotations

import datetime
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.operators.dedupe import anti_join_existing
from isotherm.operators.observations import default_parsers
from isotherm.operators.outcomes import FAILURE, PARTIAL, summary_rows
from isotherm.operators.parser import Parser, read_records, with_expressions
from isotherm.plans.adhoc import list_tables, write_csv
from isotherm.plans.ingest import ingest_files, ingest_payloads
from isotherm.queries import tables as t
from isotherm.queries.catalog import OUTCOME_COLUMNS, _new_table
from isotherm.session import cut_lineage, scratch_path
from isotherm.sinks.table import APPEND, MissingTable, append_rows, create_table, write_outcomes
from isotherm.streaming.jobs import LATEST, stream_notifications


def _csv_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_files(t.csv_files(t.observations(spark, sf_dir)))


# --- content ------------------------------------------------------------------

# A byte that starts nothing, a character cut short, and a whole one, in front of the city.
BYTES = "CASE pos % 3 WHEN 0 THEN X'FF' WHEN 1 THEN X'E282' ELSE X'C3A9' END"


def bad_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = f"CAST(concat('date,city,temperature\\n', date, ',') AS BINARY) || {BYTES} || CAST(concat(city, ',', temperature) AS BINARY)"
    files = t.event_files(t.observations(spark, sf_dir), content, ".csv").withColumnRenamed("text", "content")
    return summary_rows(ingest_files(files), "object_name")


# Cut short, without a value, with a comma too many, not quoted, empty; every sixth is whole.
BROKEN_JSON = """
CASE pos % 6
WHEN 0 THEN concat('[{"date":"', date, '","city":"', city, '","temperature":', temperature, '}')
WHEN 1 THEN concat('{"date":"', date, '","city":,"temperature":', temperature, '}')
WHEN 2 THEN concat('{"records":[{"date":"', date, '","city":"', city, '","temperature":', temperature, ',}]}')
WHEN 3 THEN concat('{date:', date, '}')
WHEN 4 THEN ''
ELSE concat('{"date":"', date, '","city":"', city, '","temperature":', temperature, '}') END
"""


def json_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = ingest_files(t.event_files(t.observations(spark, sf_dir), BROKEN_JSON, ".json"))
    return outcomes.select("object_name", *OUTCOME_COLUMNS, F.col("error_message").isNotNull().alias("has_message"), F.size("records").alias("row_count"))


def record_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each row within its file's outcome."""
    return _csv_outcomes(spark, sf_dir).select("object_name", F.posexplode("records").alias("place", "record")).select("object_name", "place", "record.date")


def processing_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether outcomes of payloads bear the time of this run."""
    started = F.lit(datetime.datetime.now(datetime.UTC) - datetime.timedelta(seconds=1))
    payloads = t.csv_files(t.observations(spark, sf_dir)).select("object_name", F.col("text").alias("value"))
    outcomes = ingest_payloads(payloads, "weather", ["object_name"])
    arrived = F.to_timestamp("event_time")
    return outcomes.select(
        "object_name", (arrived >= started).alias("event_is_new"), F.col("processing_time").between(started, F.current_timestamp()).alias("processed_now")
    )


# --- tables -------------------------------------------------------------------


def empties_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per event, many of them without a row, written to a table."""
    name = _new_table(spark)
    write_outcomes(ingest_files(t.event_files(t.observations(spark, sf_dir), t.CSV_SHAPES, ".csv")), name, APPEND)
    return spark.table(name)


def partial_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of which some are partial; these are written, failed ones are not."""
    name = _new_table(spark)
    outcomes = ingest_files(t.flawed_csv_files(t.observations(spark, sf_dir)))
    partly = (F.col("status") != FAILURE) & (F.pmod(F.xxhash64("object_name"), F.lit(2)) == 0)
    write_outcomes(outcomes.withColumn("status", F.when(partly, F.lit(PARTIAL)).otherwise(F.col("status"))), name, APPEND)
    return spark.table(name)


def tables_by_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table per format in one namespace, as listed, with its number of rows."""
    namespace = _new_table(spark).rsplit(".", 1)[0]
    outcomes = ingest_files(t.mixed_files(t.observations(spark, sf_dir)))
    for found in ("CSV", "TSV", "JSON", "XML"):
        name = create_table(spark, f"{namespace}.rows_{found.lower()}")
        write_outcomes(outcomes.where(F.col("format") == found), name, APPEND)
    counted = [
        spark.table(f"{namespace}.{row.tableName}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(row.tableName).alias("table_name"), "n_rows")
        for row in list_tables(spark, namespace).where("NOT isTemporary").collect()
    ]
    result = counted[0]
    for more in counted[1:]:
        result = result.unionByName(more)
    return result


def rows_of_new_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of files whose date the table does not hold; it holds the first ten days of each month."""
    name = _new_table(spark)
    rows = t.observations(spark, sf_dir)
    write_outcomes(ingest_files(t.csv_files(rows.where("substring(date, 9, 2) <= '10'"))), name, APPEND)
    return anti_join_existing(cut_lineage(summary_rows(ingest_files(t.csv_files(rows)), "object_name")), spark.table(name))


def csv_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all files as written to CSV with a header, read back as text."""
    path = f"{scratch_path(spark, 'result')}/rows"
    write_csv(summary_rows(_csv_outcomes(spark, sf_dir), "object_name"), path)
    return spark.read.option("header", True).csv(path)


def write_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a writer of the caller's own stores at the third try; how often it was tried, how long was waited between."""
    name, tries, waits = _new_table(spark), [], []

    def fails_twice(rows: DataFrame, table: str) -> None:
        tries.append(table)
        if len(tries) < 3:
            raise OSError("the store is away")
        append_rows(rows, table)

    write_outcomes(_csv_outcomes(spark, sf_dir), name, APPEND, writer=fails_twice, sleep=waits.append)
    return spark.table(name).withColumns({"tries": F.lit(len(tries)), "waited": F.lit(float(sum(waits)))})


def missing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose rows had no table to go to: how often that was tried, and whether the error names the table."""
    name, tries = f"{_new_table(spark)}_of_another_name", []

    def counted(rows: DataFrame, table: str) -> None:
        tries.append(table)
        append_rows(rows, table)

    outcomes, named = _csv_outcomes(spark, sf_dir), False
    try:
        write_outcomes(outcomes, name, APPEND, writer=counted)
    except MissingTable as error:
        named = name in str(error)
    return outcomes.select("object_name", F.lit(len(tries)).alias("tries"), F.lit(named).alias("names_table"))


# --- parts of the caller's own --------------------------------------------------

PIPE_UNIT = "named_struct('date', get(split(l, '[|]'), 0), 'city', get(split(l, '[|]'), 1), 'temperature', get(split(l, '[|]'), 2))"


def custom_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a format that only the caller knows, among CSV files."""

    def open_files(files: DataFrame) -> DataFrame:
        units = f"transform(split(text, '\\n'), l -> {PIPE_UNIT})"
        return with_expressions(files, pipe_units=f"CASE WHEN format = 'PIPE' THEN {units} ELSE array() END")

    parser = Parser("pipe", ("PIPE",), open_files, read_records("pipe"), True, "No ", None)
    rows = t.observations(spark, sf_dir)
    lines = t.by_file(rows.where("user_id % 2 = 0"), "concat_ws('|', date, city, temperature)")
    own = t._named(lines, "array_join(records, '\\n')", "'.pipe'").withColumn("format", F.lit("PIPE"))
    others = t.csv_files(rows.where("user_id % 2 = 1")).withColumn("format", F.lit("CSV"))
    return summary_rows(ingest_files(own.unionByName(others), [*default_parsers(), parser]), "object_name", "format")


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages about files of even users are there before the stream's first start, those of odd users come after it."""
    files = t.csv_files(t.observations(spark, sf_dir))
    messages, checkpoint, name = scratch_path(spark, "messages"), scratch_path(spark, "stream"), _new_table(spark)
    for rest in (0, 1):
        files.where(F.col("user_id") % 2 == rest).selectExpr(
            "to_json(named_struct('source', 'aws.s3', 'detail', named_struct('bucket', named_struct('name', 'drops'), "
            "'object', named_struct('key', object_name)))) AS value"
        ).write.mode("append").text(messages)
        time.sleep(1.1)  # a file's time has whole seconds in some stores
        query = stream_notifications(
            spark, messages, name, checkpoint, contents=lambda: files.drop("file_id", "user_id"), position=LATEST, available_now=True
        )
        query.awaitTermination()
    return spark.table(name)


EDGES = {
    f.__name__: f
    for f in (
        bad_bytes,
        json_malformed,
        record_order,
        processing_times,
        empties_table,
        partial_table,
        tables_by_format,
        rows_of_new_dates,
        csv_output,
        write_retry,
        missing_table,
        custom_parser,
        stream_latest,
    )
}
