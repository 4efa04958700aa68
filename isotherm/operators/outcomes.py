"""One outcome per file: SUCCESS with its summary rows, or FAILURE with a message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isotherm.operators.observations import METADATA, READ_ERROR
from isotherm.operators.summarize import extreme_columns
from isotherm.schemas import SUMMARY_COLUMNS

# --- fixed values ---------------------------------------------------------
SUCCESS = "SUCCESS"
FAILURE = "FAILURE"
PARTIAL = "PARTIAL"
# --------------------------------------------------------------------------


def file_outcomes(readings: DataFrame) -> DataFrame:
    """Readings of ``parse_files`` to one row per file.

    One bad record fails the whole file; the message is that of the first bad
    record. Two aggregations: per (file, date), which reduces each task's rows
    to the dates of its files before anything is shuffled, then per file over
    those few rows. The input is not read a second time, and files without any
    record keep their row.
    """
    by_date = readings.groupBy("file_id", "date").agg(
        *extreme_columns(),
        F.min(F.when(F.col("error").isNotNull(), F.struct("pos", "error"))).alias("first_error"),
        F.max("meta").alias("meta"),
    )
    summary = F.when(F.col("max_temp").isNotNull(), F.struct(*SUMMARY_COLUMNS))
    by_file = by_date.groupBy("file_id").agg(
        F.array_sort(F.collect_list(summary)).alias("all_records"),
        F.min("first_error")["error"].alias("error_message"),
        F.max("meta").alias("meta"),
    )
    failed = F.col("error_message").isNotNull()
    present = [f.name for f in readings.schema["meta"].dataType.fields if f.name in (*METADATA, READ_ERROR)]
    records = F.when(failed, F.array()).otherwise(F.col("all_records"))
    return by_file.select(
        "file_id",
        *[F.col("meta")[name].alias(name) for name in present],
        F.col("meta")["format"].alias("format"),
        F.when(failed, F.lit(FAILURE)).otherwise(F.lit(SUCCESS)).alias("status"),
        records.alias("records"),
        _count(failed).alias("records_processed"),
        _count(failed).alias("records_written"),
        "error_message",
        F.current_timestamp().alias("processing_time"),
    )


def _count(failed: Column) -> Column:
    return F.when(failed, F.lit(0)).otherwise(F.size("all_records")).cast("long")


def _split_by_date(readings: DataFrame) -> DataFrame:
    error = F.when(F.col("error").isNotNull(), F.struct("at", "error"))
    return readings.groupBy("file_id", "date").agg(
        *extreme_columns(("at",)), F.min(error).alias("first_error")
    )


def split_file_rows(readings: DataFrame) -> DataFrame:
    """Summary rows of files read by ``scan_delimited``, without failed files.

    Nothing is collected per file: a file may have any number of dates. Whether
    it failed is decided over its rows per date, without a second read.
    """
    failed = F.max(F.col("first_error").isNotNull()).over(Window.partitionBy("file_id"))
    by_date = _split_by_date(readings).withColumn("failed", failed)
    rows = by_date.where("date IS NOT NULL AND max_temp IS NOT NULL AND NOT failed")
    return rows.select("file_id", *SUMMARY_COLUMNS)


def split_file_outcomes(readings: DataFrame) -> DataFrame:
    """One row per file read by ``scan_delimited``: status, counts and message."""
    by_file = _split_by_date(readings).groupBy("file_id").agg(
        F.min("first_error")["error"].alias("error_message"),
        F.count("max_temp").alias("dates"),
    )
    failed = F.col("error_message").isNotNull()
    written = F.when(failed, F.lit(0)).otherwise(F.col("dates")).cast("long")
    return by_file.select(
        "file_id",
        F.when(failed, F.lit(FAILURE)).otherwise(F.lit(SUCCESS)).alias("status"),
        written.alias("records_processed"),
        written.alias("records_written"),
        "error_message",
    )


def summary_rows(outcomes: DataFrame, *carry: str) -> DataFrame:
    """Rows to store: those of all outcomes but failures. Empty outcomes vanish."""
    written = outcomes.where(F.col("status") != FAILURE)
    return written.select(*carry, F.inline("records"))
