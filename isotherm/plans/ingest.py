"""Whole jobs over DataFrames; streaming runs the same ones per micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions.location import object_id
from isotherm.operators.lookup import notified_objects
from isotherm.operators.notifications import parse_notifications
from isotherm.operators.observations import METADATA, READ_ERROR, parse_files
from isotherm.operators.outcomes import file_outcomes
from isotherm.operators.parser import Parser
from isotherm.operators.payloads import number_payloads, payload_files
from isotherm.session import cut_lineage, for_parsers
from isotherm.sources.objects import NOT_FOUND, fetch_objects

OUTCOME = ("format", "status", "records", "records_processed", "records_written", "error_message", "processing_time")


def ingest_files(files: DataFrame, parsers: Sequence[Parser] | None = None) -> DataFrame:
    """Files (see ``parse_files``) to one outcome per file."""
    for_parsers(files.sparkSession)
    return file_outcomes(parse_files(files, parsers))


def ingest_notifications(
    messages: DataFrame,
    contents: DataFrame | None = None,
    location: str = "s3://{bucket}",
    parsers: Sequence[Parser] | None = None,
    value: str = "value",
) -> DataFrame:
    """Object-created messages to one outcome per notification.

    Each notified object is read and parsed once, even if many messages name
    it; only its outcome is joined back to the notifications. ``contents``
    supplies the objects as a DataFrame; without it the tasks open the objects
    at ``location``. Notifications of objects that could not be read are left
    out; ``notification_outcomes`` has them too.
    """
    found = notification_outcomes(messages, contents, location, parsers, value)
    return found.where(F.col(READ_ERROR).isNull()).drop(READ_ERROR)


def notification_misses(outcomes: DataFrame) -> DataFrame:
    """The notifications of ``notification_outcomes`` whose object could not be read, with the reason."""
    missed = outcomes.where(F.col(READ_ERROR).isNotNull())
    return missed.select(*[c for c in outcomes.columns if c not in OUTCOME])


def notification_outcomes(
    messages: DataFrame,
    contents: DataFrame | None = None,
    location: str = "s3://{bucket}",
    parsers: Sequence[Parser] | None = None,
    value: str = "value",
) -> DataFrame:
    """All notifications: with the outcome of their object, or with ``read_error``.

    The messages are parsed once and the outcomes are computed once; both are
    checkpointed, small as they are next to the objects. The join between them
    then shuffles either side for itself, so that adaptive execution can split
    an object that most messages name.
    """
    notifications = parse_notifications(messages, value).withColumn(
        "file_id", object_id(F.col("bucket_url"), F.col("object_name"))
    )
    notifications = cut_lineage(notifications)
    if contents is None:
        objects = fetch_objects(notifications, location)
    else:
        objects = notified_objects(notifications, contents).withColumn(READ_ERROR, F.lit(None).cast("string"))
    files = objects.withColumn("file_id", object_id(F.col("bucket_url"), F.col("object_name")))
    outcomes = cut_lineage(ingest_files(files, parsers).drop(*METADATA))
    joined = notifications.join(outcomes.withColumn("_read", F.lit(True)), "file_id", "left")
    reason = F.when(F.col("_read").isNull(), F.lit(NOT_FOUND)).otherwise(F.col(READ_ERROR))
    return joined.withColumn(READ_ERROR, reason).drop("_read")


def ingest_payloads(
    payloads: DataFrame,
    stream_name: str,
    order: Sequence[str],
    value: str = "value",
    start: int = 0,
    parsers: Sequence[Parser] | None = None,
) -> DataFrame:
    """Whole-file messages to one outcome per payload of a known format."""
    numbered = number_payloads(payloads, order, value, start)
    return ingest_files(payload_files(numbered, stream_name, value), parsers)
