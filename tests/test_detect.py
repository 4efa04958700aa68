from pyspark.sql import functions as F

from isotherm import detect_format

CASES = [
    ("a.csv", "{", "CSV"), ("a.CSV", "<", "CSV"), ("a.tsv", "", "TSV"), ("a.TAB", "", "TSV"), ("a.json", "", "JSON"),
    ("a.jsonl", "", "JSON"), ("a.NDJSON", "", "JSON"), ("a.xml", "{", "XML"), ("a.csv.gz", "x", "UNKNOWN"),
    ("csv", "x", "UNKNOWN"), (None, "  [", "JSON"), ("unknown.dat", '[{"name":"Alice"}]', "JSON"), ("x", "\n\t {", "JSON"),
    ("x", " <a", "XML"), ("x", "a,b\tc", "TSV"), ("x", "\ta,b", "CSV"), ("x", "\ta", "UNKNOWN"), ("x", "a\n\nb,c", "CSV"),
    ("x", "plain", "UNKNOWN"), ("x", "", "UNKNOWN"), ("x", " \t\n", "UNKNOWN"), ("x", "﻿{", "UNKNOWN"),
    ("x", " {", "JSON"), ("x", " {", "UNKNOWN"), ("x", " \t", "TSV"), ("x", "\x1c[", "JSON"), ("x", "a|b", "UNKNOWN"),
]


def test_formats(spark):
    df = spark.createDataFrame([(i, n, t) for i, (n, t, _) in enumerate(CASES)], "i int, n string, t string")
    got = df.select("i", detect_format(F.col("n"), F.col("t")).alias("f")).orderBy("i").collect()
    assert [(CASES[r.i][:2], r.f) for r in got] == [((n, t), f) for n, t, f in CASES]


def test_unknown_format_fails(spark):
    from tests.helpers import results

    assert results(spark, [("x", "plain")]) == [("FAILURE", "Unsupported file format: UNKNOWN")]
