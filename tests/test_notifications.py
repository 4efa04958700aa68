import json

import pytest

from isotherm import dead_letter_counts, dead_letters, parse_notifications, read_envelopes, route_events
from isotherm.functions.location import bucket_name, resolve_table
from pyspark.sql import functions as F


def envelope(bucket="in", key="a+b%2Fc.csv", source="aws.s3", time="2024-01-15T10:00:00Z", kind="Object Created"):
    detail = {"bucket": {"name": bucket}, "object": {"key": key}}
    return json.dumps({"source": source, "detail-type": kind, "time": time, "detail": detail})


CASES = [
    (envelope(), ("s3://in", "a b/c.csv", "2024-01-15T10:00:00Z", "aws.s3")),
    (envelope(key="%zz"), "bad_escape"),
    (envelope(key="a%2"), "bad_escape"),
    (envelope(key=""), "missing_field"),
    (envelope(key=None), "missing_field"),
    (envelope(bucket=None), "missing_field"),
    (envelope(bucket={"x": 1}), "missing_field"),
    (envelope(key=["x"]), "missing_field"),
    (envelope(bucket=5, key=7), ("s3://5", "7", "2024-01-15T10:00:00Z", "aws.s3")),
    (envelope(key="{a.csv"), ("s3://in", "{a.csv", "2024-01-15T10:00:00Z", "aws.s3")),
    (envelope(key="v1.2E.csv"), ("s3://in", "v1.2E.csv", "2024-01-15T10:00:00Z", "aws.s3")),
    ('{"detail":{"bucket":{"name":"in"},"object":{"key":"k"}}}', ("s3://in", "k", None, None)),
    ("[1]", "missing_field"),
    ("{}", "missing_field"),
    ("not json", "not_json"),
    ("", "not_json"),
    (None, "not_json"),
    (envelope() + " trailing", ("s3://in", "a b/c.csv", "2024-01-15T10:00:00Z", "aws.s3")),
    (envelope(kind="Object Deleted"), ("s3://in", "a b/c.csv", "2024-01-15T10:00:00Z", "aws.s3")),
    (envelope(key="%C3%A9"), ("s3://in", "é", "2024-01-15T10:00:00Z", "aws.s3")),
    (envelope(time={"x": 1}), ("s3://in", "a b/c.csv", "", "aws.s3")),
]


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame([(i, m) for i, (m, _) in enumerate(CASES)], "i int, value string")


def test_envelopes(messages):
    got = sorted(read_envelopes(messages).collect(), key=lambda r: r.i)
    shown = [r.dead_reason or (r.bucket_url, r.object_name, r.event_time, r.event_source) for r in got]
    assert shown == [expected for _, expected in CASES]


def test_notifications_and_dead_letters_share_the_messages(messages):
    good = {r.i for r in parse_notifications(messages).collect()}
    bad = {r.i for r in dead_letters(messages).collect()}
    assert good | bad == set(range(len(CASES))) and not good & bad
    counts = {r.dead_reason: r.messages for r in dead_letter_counts(messages).collect()}
    assert counts == {"bad_escape": 2, "missing_field": 7, "not_json": 3}


def test_dead_letters_stay_on_one_line(spark):
    df = spark.createDataFrame([("a\r\nb",), (None,)], "value string")
    assert sorted(r.message for r in dead_letters(df).collect()) == ["a\\r\\nb", "null"]


def test_route(spark):
    texts = [envelope(), envelope(source="x"), envelope(kind="x"), envelope(bucket="other"), "junk", envelope(key="")]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(texts)], "i int, value string")
    assert sorted(r.i for r in route_events(df, "in").collect()) == [0, 5]


def test_bucket_names(spark):
    urls = ["s3://my-bucket", "s3://my-bucket/", "my-bucket", "s3://s3://x//", "my-bucket\n"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r.b for r in df.select(bucket_name(F.col("u")).alias("b")).collect()] == [
        "my-bucket", "my-bucket", "my-bucket", "s3://x/", "my-bucket\n",
    ]
    with pytest.raises(Exception, match="no bucket_url"):
        spark.range(1).select(bucket_name(F.lit(None).cast("string"))).collect()


def test_table_names():
    assert resolve_table("t") == "default.t"
    assert resolve_table("a.t") == "a.t"
