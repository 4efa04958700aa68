"""Row types. ``date`` stays text from end to end and sorts as text."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values ---------------------------------------------------------
FORMATS = ("CSV", "TSV", "JSON", "XML", "UNKNOWN")
STATUSES = ("SUCCESS", "FAILURE", "PARTIAL")
# --------------------------------------------------------------------------


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


NOTIFICATION = _struct(
    ("bucket_url", T.StringType(), True),
    ("object_name", T.StringType(), True),
    ("event_time", T.StringType(), True),
    ("event_source", T.StringType(), True),
)

# One file, ready to parse. ``file_id`` is unique per row.
FILE_CONTENT = T.StructType(
    [
        T.StructField("file_id", T.StringType(), False),
        *NOTIFICATION.fields,
        T.StructField("content", T.BinaryType(), False),
        T.StructField("format", T.StringType(), False),
    ]
)

OBSERVATION = _struct(
    ("date", T.StringType(), False),
    ("city", T.StringType(), False),
    ("temperature", T.IntegerType(), False),
)

SUMMARY = _struct(
    ("date", T.StringType(), False),
    ("max_temp", T.IntegerType(), False),
    ("max_temp_city", T.StringType(), False),
    ("min_temp", T.IntegerType(), False),
    ("min_temp_city", T.StringType(), False),
)
SUMMARY_COLUMNS = SUMMARY.fieldNames()

OUTCOME = T.StructType(
    [
        *NOTIFICATION.fields,
        T.StructField("format", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("records", T.ArrayType(SUMMARY), False),
        T.StructField("records_processed", T.LongType(), False),
        T.StructField("records_written", T.LongType(), False),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("processing_time", T.TimestampType(), False),
    ]
)
