"""Generated delimited texts against a plain reading of the rules; plan shape checks."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from isotherm import daily_extremes, ingest_files, parse_files
from isotherm.operators.observations import default_parsers
from isotherm.operators.parser import Parser, read_records, with_expressions
from tests.helpers import files_frame, results

TRIM = "".join(chr(c) for c in range(33))
FIELDS = ("date", "city", "temperature")


def expected(text):
    """The rules for a delimited file, line by line."""
    lines = [line for line in re.split("\r\n|\r|\n", text) if line.strip()]
    if not lines:
        return ("SUCCESS", [])
    header = [cell.strip(TRIM) for cell in lines[0].split(",")]
    days = {}
    for line in lines[1:]:
        cells = [cell.strip(TRIM) for cell in line.split(",")]
        row = {}
        for i, name in enumerate(header):
            row[name] = cells[i] if i < len(cells) else ""
        found = {}
        for field in FIELDS:
            names = [name for name in row if name.lower() == field]
            if not names:
                return ("FAILURE", f"Missing required column: {field}")
            found[field] = row[names[0]]
            if not found[field].strip():
                return ("FAILURE", f"Blank required column: {field}")
        number = found["temperature"]
        if not re.fullmatch("[+-]?[0-9]+", number) or not -(2**31) <= int(number) < 2**31:
            return ("FAILURE", f'For input string: "{number}"')
        days.setdefault(found["date"], []).append((int(number), found["city"]))
    rows = []
    for date in sorted(days):
        hot = max(days[date], key=lambda o: o[0])
        cold = min(days[date], key=lambda o: o[0])
        rows.append((date, hot[0], "" if hot[0] == -(2**31) else hot[1], cold[0], "" if cold[0] == 2**31 - 1 else cold[1]))
    return ("SUCCESS", rows)


name = st.sampled_from(["date", "city", "temperature", "Date", "CITY", " temperature ", "x", ""])
cell = st.one_of(
    st.sampled_from(["d1", "d2", "a", "b", "5", "-3", "+7", "5.5", "", " ", " 8 ", "2147483647", "-2147483648", "99999999999", "\x7f5", "5\x7f", "\x1f4", "é"]),
    st.integers(-5, 5).map(str),
)
good_line = st.tuples(st.sampled_from(["d1", "d2", "d3"]), st.sampled_from("abc"), st.integers(-3, 3).map(str)).map(",".join)
any_line = st.lists(cell, min_size=1, max_size=5).map(",".join)
header = st.one_of(st.just("date,city,temperature"), st.lists(name, min_size=1, max_size=5).map(",".join))
text = st.builds(
    lambda before, head, lines, end: end.join([*before, head, *lines]),
    st.lists(st.sampled_from(["", " ", "\t"]), max_size=2),
    header,
    st.one_of(st.lists(good_line, max_size=8), st.lists(st.one_of(good_line, any_line, st.just(" ")), max_size=6)),
    st.sampled_from(["\n", "\r\n", "\r"]),
)


@settings(max_examples=4, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(text, min_size=150, max_size=150))
def test_delimited_rules(spark, texts):
    got = results(spark, [("f.csv", t) for t in texts])
    for t, outcome in zip(texts, got):
        assert outcome == expected(t), repr(t)


def test_a_date_with_most_of_the_rows(spark):
    rows = spark.range(0, 60000, 1, 16).selectExpr(
        "id AS pos", "CASE WHEN id % 10 < 9 THEN 'hot' ELSE concat('d', id % 7) END AS date",
        "concat('c', id % 100) AS city", "CAST((id * 37) % 1001 AS INT) AS temperature",
    )
    got = {r.date: tuple(r)[1:] for r in daily_extremes(rows).collect()}
    days = {}
    for r in rows.collect():
        days.setdefault(r.date, []).append((r.temperature, r.pos, r.city))
    for date, found in days.items():
        hot, cold = max(found, key=lambda o: (o[0], -o[1])), min(found)
        assert got[date] == (hot[0], hot[2], cold[0], cold[2])
    plan = daily_extremes(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") >= 1 and plan.count("Exchange") == 1


def test_custom_parser(spark):
    """A format of the user's own: fixed-width lines in a Python function."""
    import pandas as pd

    record = "array<struct<date string, city string, temperature string>>"

    @F.pandas_udf(record)
    def fixed_width(texts: pd.Series) -> pd.Series:
        def records(text):
            lines = (text or "").splitlines()
            return [{"date": s[:4], "city": s[4:8].strip(), "temperature": s[8:]} for s in lines]

        return texts.map(records)

    def open_files(files):
        own = F.expr("CASE WHEN format = 'FIXED' THEN text END")
        return with_expressions(files.withColumn("_own", fixed_width(own)), fixed_units="coalesce(_own, array())").drop("_own")

    parser = Parser("fixed", ("FIXED",), open_files, read_records("fixed"), True, "No ", "Blank ")
    files = spark.createDataFrame(
        [(1, "FIXED", "d001abc 5\nd001x   9"), (2, "CSV", "date,city,temperature\nd,c,1"), (3, "FIXED", "d001    5")],
        "file_id long, format string, text string",
    )
    got = {r.file_id: (r.status, [tuple(x) for x in r.records], r.error_message)
           for r in ingest_files(files, [*default_parsers(), parser]).collect()}
    assert got == {
        1: ("SUCCESS", [("d001", 9, "x", 5, "abc")], None),
        2: ("SUCCESS", [("d", 1, "c", 1, "c")], None),
        3: ("FAILURE", [], "Blank city"),
    }


@pytest.fixture(scope="module")
def stored_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("files"))
    files_frame(spark, [("a.csv", "date,city,temperature\nd,c,5\n"), ("b.dat", "{}")]).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_one_scan_two_exchanges(stored_files):
    plan = ingest_files(stored_files)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_max" in plan


def test_generated_methods_are_small_enough_to_be_compiled(stored_files):
    """The JVM leaves methods above 8000 bytes to its interpreter."""
    stages = parse_files(stored_files)._jdf.queryExecution().debug().codegenToSeq()
    sizes = [int(re.search(r"\((\d+)", stages.apply(i)._3().toString()).group(1)) for i in range(stages.size())]
    assert sizes and max(sizes) < 8000
