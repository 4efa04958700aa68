"""Object-created messages to notifications, and the messages that are not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions.location import bucket_url
from isotherm.functions.text import form_decoded, one_line
from isotherm.operators.observations import METADATA
from isotherm.operators.parser import evaluated_once, with_expressions

# --- fixed values ---------------------------------------------------------
OBJECT_EVENT_SOURCE = "aws.s3"
OBJECT_EVENT_TYPE = "Object Created"
BUCKET_PATH = "$.detail.bucket.name"
KEY_PATH = "$.detail.object.key"
TIME_PATH = "$.time"
SOURCE_PATH = "$.source"
# --------------------------------------------------------------------------

NOT_JSON = "not_json"
MISSING_FIELD = "missing_field"
BAD_ESCAPE = "bad_escape"


def route_events(messages: DataFrame, bucket: str, value: str = "value") -> DataFrame:
    """Messages about a new object in ``bucket``; the rule in front of the job."""
    text = F.col(value)
    return messages.where(
        (F.get_json_object(text, SOURCE_PATH) == OBJECT_EVENT_SOURCE)
        & (F.get_json_object(text, "$.detail-type") == OBJECT_EVENT_TYPE)
        & (F.get_json_object(text, BUCKET_PATH) == bucket)
    )


def _field_text(path: str, plain: str) -> str:
    """SQL for a scalar's text; an object or array counts as empty text."""
    kind = f"schema_of_variant(try_variant_get(_document, '{path}', 'variant'))"
    container = f"ascii({plain}) IN (91, 123) AND ({kind} LIKE 'OBJECT%' OR {kind} LIKE 'ARRAY%')"
    return f"CASE WHEN {container} THEN '' ELSE {plain} END"


def read_envelopes(messages: DataFrame, value: str = "value") -> DataFrame:
    """All messages with the notification columns and ``dead_reason``.

    ``dead_reason`` is NULL for a usable message. One pass over the messages
    gives both the notifications and the dead letters. Other input columns
    are kept.
    """
    paths = {"bucket": BUCKET_PATH, "key": KEY_PATH, "time": TIME_PATH, "source": SOURCE_PATH}
    parsed = messages.withColumn("_document", F.try_parse_json(F.col(value)))
    plain = with_expressions(
        parsed, **{f"_{name}_plain": f"try_variant_get(_document, '{path}', 'string')" for name, path in paths.items()}
    )
    texts = with_expressions(
        plain, **{f"_{name}_text": _field_text(path, f"_{name}_plain") for name, path in paths.items()}
    )
    decoded = texts.withColumn("object_name", form_decoded(F.col("_key_text")))
    reason = (
        f"CASE WHEN _document IS NULL THEN '{NOT_JSON}' "
        "WHEN coalesce(_bucket_text, '') = '' OR coalesce(_key_text, '') = '' "
        f"THEN '{MISSING_FIELD}' WHEN object_name IS NULL THEN '{BAD_ESCAPE}' END"
    )
    envelopes = decoded.select(
        *messages.columns,
        bucket_url(F.col("_bucket_text")).alias("bucket_url"),
        "object_name",
        F.col("_time_text").alias("event_time"),
        F.col("_source_text").alias("event_source"),
        F.expr(reason).alias("dead_reason"),
    )
    return evaluated_once(envelopes, messages.columns, [*METADATA, "dead_reason"])


def parse_notifications(messages: DataFrame, value: str = "value") -> DataFrame:
    """Usable messages as notifications; the message text itself is dropped."""
    return read_envelopes(messages, value).where("dead_reason IS NULL").drop(value, "dead_reason")


def dead_letters(messages: DataFrame, value: str = "value") -> DataFrame:
    """The messages that were dropped, each on one line, with the reason."""
    dead = read_envelopes(messages, value).where("dead_reason IS NOT NULL")
    kept = [name for name in messages.columns if name != value]
    return dead.select(*kept, one_line(F.col(value)).alias("message"), "dead_reason")


def dead_letter_counts(messages: DataFrame, value: str = "value") -> DataFrame:
    return dead_letters(messages, value).groupBy("dead_reason").agg(F.count(F.lit(1)).alias("messages"))
