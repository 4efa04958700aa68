"""Dropped or streamed data files to a queryable daily-extremes table, on Spark.

The package is a set of functions over DataFrames. Nothing runs until an action
is called; batch and streaming share the same operators.
"""

from isotherm.operators.dedupe import anti_join_existing, first_per_date
from isotherm.operators.detect import detect_format
from isotherm.operators.lookup import missing_objects, read_objects
from isotherm.operators.notifications import (
    dead_letter_counts,
    dead_letters,
    parse_notifications,
    read_envelopes,
    route_events,
)
from isotherm.operators.observations import default_parsers, parse_files, valid_observations
from isotherm.operators.outcomes import file_outcomes, summary_rows
from isotherm.operators.payloads import number_payloads, payload_files
from isotherm.operators.summarize import daily_extremes
from isotherm.plans.adhoc import list_tables, run_sql, write_csv
from isotherm.plans.ingest import (
    ingest_files,
    ingest_notifications,
    ingest_payloads,
    notification_misses,
    notification_outcomes,
)
from isotherm.session import configure
from isotherm.sinks.table import append_rows, create_table, dedupe_rows, write_outcomes
from isotherm.streaming.jobs import stream_files, stream_notifications, stream_payloads

__all__ = [
    "anti_join_existing",
    "append_rows",
    "configure",
    "create_table",
    "daily_extremes",
    "dead_letter_counts",
    "dead_letters",
    "dedupe_rows",
    "default_parsers",
    "detect_format",
    "file_outcomes",
    "first_per_date",
    "ingest_files",
    "ingest_notifications",
    "ingest_payloads",
    "list_tables",
    "missing_objects",
    "notification_misses",
    "notification_outcomes",
    "number_payloads",
    "parse_files",
    "parse_notifications",
    "payload_files",
    "read_envelopes",
    "read_objects",
    "route_events",
    "run_sql",
    "stream_files",
    "stream_notifications",
    "stream_payloads",
    "summary_rows",
    "valid_observations",
    "write_csv",
    "write_outcomes",
]
