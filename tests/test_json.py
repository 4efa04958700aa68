import pytest
from pyspark.sql import functions as F

from isotherm import ingest_files
from isotherm.operators.json_records import TOO_LARGE, json_parser
from tests.helpers import results

OK = [("d", 84, "c", 84, "c")]
ZERO = [("d", 0, "c", 0, "c")]
FAIL = None


def rec(temperature):
    return '{"date":"d","city":"c","temperature":%s}' % temperature


CASES = [
    ("array", "[" + rec(84) + "]", OK),
    ("records", '{"records":[' + rec(84) + "]}", OK),
    ("records is not an array", '{"records":5,"date":"d","city":"c","temperature":84}', OK),
    ("records is null", '{"records":null,"date":"d","city":"c","temperature":84}', OK),
    ("single object", rec(84), OK),
    ("empty array", "[]", []),
    ("empty records", '{"records":[]}', []),
    ("only the first value counts", rec(84) + "\n" + rec(99), OK),
    ("text after the first value", rec(84) + " junk", OK),
    ("unknown fields", '{"date":"d","city":"c","temperature":84,"x":[1]}', OK),
    ("names are case sensitive", '{"Date":"d","city":"c","temperature":84}', FAIL),
    ("missing date", '{"city":"c","temperature":84}', FAIL),
    ("null city", '{"date":"d","city":null,"temperature":84}', FAIL),
    ("empty city is fine", '{"date":"d","city":"","temperature":84}', [("d", 84, "", 84, "")]),
    ("number as date", '{"date":20240701,"city":"c","temperature":84}', [("20240701", 84, "c", 84, "c")]),
    ("boolean as city", '{"date":"d","city":true,"temperature":84}', [("d", 84, "true", 84, "true")]),
    ("fraction as city", '{"date":"d","city":1.50,"temperature":84}', [("d", 84, "1.5", 84, "1.5")]),
    ("object as city", '{"date":"d","city":{},"temperature":84}', FAIL),
    ("array as date", '{"date":["d"],"city":"c","temperature":84}', FAIL),
    ("temperature missing", '{"date":"d","city":"c"}', ZERO),
    ("temperature null", rec("null"), ZERO),
    ("temperature fraction", rec("84.7"), OK),
    ("temperature negative fraction", rec("-84.7"), [("d", -84, "c", -84, "c")]),
    ("temperature exponent", rec("8.4e1"), OK),
    ("temperature out of range", rec("2147483648"), FAIL),
    ("temperature just out of range", rec("2147483647.5"), FAIL),
    ("temperature far out of range", rec("123456789012345678901234567890123456789012"), FAIL),
    ("temperature text", rec('"84"'), OK),
    ("temperature text with space", rec('" 84 "'), OK),
    ("temperature text with sign", rec('"+84"'), OK),
    ("temperature empty text", rec('""'), ZERO),
    ("temperature blank text", rec('"  "'), ZERO),
    ("temperature text null", rec('"null"'), ZERO),
    ("temperature text fraction", rec('"84.5"'), FAIL),
    ("temperature word", rec('"hot"'), FAIL),
    ("temperature true", rec("true"), FAIL),
    ("temperature object", rec("{}"), FAIL),
    ("temperature array", rec("[84]"), FAIL),
    ("null element", "[" + rec(84) + ",null]", FAIL),
    ("number element", "[" + rec(84) + ",5]", FAIL),
    ("array element", "[[" + rec(84) + "]]", FAIL),
    ("text root", '"abc"', FAIL),
    ("null root", "null", FAIL),
    ("malformed", "[" + rec(84), FAIL),
    ("malformed behind the records", '{"records":[' + rec(84) + '],"x":', FAIL),
    ("malformed element", "[" + rec(84) + ",{]", FAIL),
    ("single quotes", "[{'date':'d','city':'c','temperature':84}]", FAIL),
    ("not a number", '[{"date":"d","city":"c","temperature":NaN}]', FAIL),
    ("white space before the array", " \r\n\t[" + rec(84) + "]", OK),
    ("records of two keys: last", '{"records":[],"records":[' + rec(84) + "]}", OK),
    ("record of arrays", "[[]]", FAIL),
    ("records in an array of one", '[{"records":[' + rec(84) + "]}]", FAIL),
    ("empty", "", FAIL),
    ("repeated key: last", '{"date":"x","date":"d","city":"c","temperature":1,"temperature":84}', OK),
    ("byte order mark", "﻿" + rec(84), OK),
    ("not UTF-8", b'{"date":"d","city":"\xff","temperature":84}', FAIL),
    ("escapes", '{"date":"d","city":"\\u0063","temperature":84}', OK),
    ("ties and order", "[%s]" % ",".join('{"date":"%s","city":"%s","temperature":%d}' % t for t in
        [("b", "x", 1), ("a", "p", 7), ("a", "q", 7), ("a", "r", 2), ("a", "s", 2)]),
        [("a", 7, "p", 2, "r"), ("b", 1, "x", 1, "x")]),
]


@pytest.fixture(scope="module")
def json_results(spark):
    return results(spark, [("f.json", text) for _, text, _ in CASES])


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] for c in CASES])
def test_json(json_results, i):
    expected = CASES[i][2]
    status, got = json_results[i]
    if expected is FAIL:
        assert status == "FAILURE" and got
    else:
        assert (status, got) == ("SUCCESS", expected)


def test_a_file_larger_than_a_variant(spark):
    """As a whole beyond the 128 MiB of a VARIANT, its records not."""
    record = "concat(repeat(concat('{\"date\":\"d\",\"city\":\"', repeat('x', 2000), '\",\"temperature\":84},'), 70000), '{\"date\":\"e\",\"city\":\"c\",\"temperature\":1}')"
    files = spark.range(1).selectExpr("id AS file_id", "'JSON' AS format", f"concat('[', {record}, ']') AS text")
    assert files.select(F.octet_length("text").alias("n")).first().n > 140_000_000
    row = ingest_files(files, [json_parser()]).select("status", "records.date", "records.max_temp").first()
    assert (row.status, row.date, row.max_temp) == ("SUCCESS", ["d", "e"], [84, 1])


def test_a_large_object_without_records_has_its_own_message(spark):
    text = "concat('{\"date\":\"', repeat('x', 140000000), '\"}')"
    files = spark.range(1).selectExpr("id AS file_id", "'JSON' AS format", f"{text} AS text")
    row = ingest_files(files, [json_parser()]).select("status", "error_message").first()
    assert (row.status, row.error_message) == ("FAILURE", TOO_LARGE)
