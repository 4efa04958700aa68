"""Notifications and the objects they name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions.location import bucket_name

KEYS = ["_bucket", "object_name"]


def _by_key(df: DataFrame) -> DataFrame:
    return df.withColumn("_bucket", bucket_name(F.col("bucket_url")))


def read_objects(notifications: DataFrame, contents: DataFrame) -> DataFrame:
    """Each notification with its object; those without one give no row.

    ``contents`` has ``bucket_url, object_name`` and the payload columns. A
    repeated notification gives a repeated row. Spark brings the notifications
    to the objects if their bytes are few; else both meet in a sort merge join,
    where adaptive execution splits a skewed key.
    """
    found = _by_key(contents).drop("bucket_url")
    return _by_key(notifications).join(found, KEYS, "inner").drop("_bucket")


def missing_objects(notifications: DataFrame, contents: DataFrame) -> DataFrame:
    """Notifications whose object does not exist. Payloads are not read."""
    names = _by_key(contents).select(*KEYS)
    return _by_key(notifications).join(names, KEYS, "left_anti").drop("_bucket")


def notified_objects(notifications: DataFrame, contents: DataFrame) -> DataFrame:
    """The objects that at least one notification names, each once.

    The names are made distinct first (combined on the map side, so an object
    notified a million times travels once per task) and only then meet the
    payloads, as a semi-join.
    """
    names = _by_key(notifications).select(*KEYS).distinct()
    return _by_key(contents).join(names, KEYS, "left_semi").drop("_bucket")
