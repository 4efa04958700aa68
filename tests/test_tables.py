import uuid

import pytest

from isotherm import append_rows, create_table, ingest_files, list_tables, run_sql, write_csv, write_outcomes
from isotherm.schemas import OUTCOME
from isotherm.sinks.table import CREATE_AND_DEDUPE, MissingTable
from isotherm.sources.objects import retry
from tests.helpers import files_frame

HEAD = "date,city,temperature\n"


def new_name():
    return f"db_{uuid.uuid4().hex[:8]}.summary"


def day(i):
    return (f"1999-1{i}-30", 3 * i + 9, "Lima" * (i + 1), -5 * i, f"{i} Oslo")


def outcome_frame(spark, *states):
    """Outcomes with a given status and number of rows."""
    rows = []
    for i, (status, n) in enumerate(states):
        rows.append((i, status, [day(d) for d in range(n)]))
    record = OUTCOME["records"].dataType.elementType.simpleString()
    return spark.createDataFrame(rows, f"file_id long, status string, records array<{record}>")


def content(spark, name):
    return sorted(tuple(r) for r in spark.table(name).collect())


def test_only_outcomes_with_rows_are_written(spark):
    name = create_table(spark, new_name())
    write_outcomes(outcome_frame(spark, ("FAILURE", 0), ("SUCCESS", 0), ("FAILURE", 2)), name)
    assert content(spark, name) == []
    write_outcomes(outcome_frame(spark, ("SUCCESS", 2), ("PARTIAL", 1)), name)
    assert content(spark, name) == sorted([day(0), day(1), day(0)])


def test_append_repeats_dates(spark):
    name = create_table(spark, new_name())
    for _ in range(2):
        write_outcomes(outcome_frame(spark, ("SUCCESS", 1)), name)
    assert content(spark, name) == [day(0), day(0)]


def test_missing_table_is_not_retried(spark):
    waits = []
    with pytest.raises(MissingTable, match="db_none.summary.*does not exist"):
        write_outcomes(outcome_frame(spark, ("SUCCESS", 1)), "db_none.summary", sleep=waits.append)
    assert waits == []


def test_writes_are_tried_three_times(spark):
    calls, waits = [], []

    def failing(rows, table):
        calls.append(table)
        raise OSError("down")

    with pytest.raises(OSError):
        write_outcomes(outcome_frame(spark, ("SUCCESS", 1)), "t", writer=failing, sleep=waits.append)
    assert (calls, waits) == (["default.t"] * 3, [1.0, 2.0])

    def second_time(rows, table):
        calls.append(table)
        if len(calls) < 5:
            raise OSError("down")

    write_outcomes(outcome_frame(spark, ("SUCCESS", 1)), "t", writer=second_time, sleep=waits.append)
    assert len(calls) == 5 and waits == [1.0, 2.0, 1.0]


def test_retry_stops_at_final_errors():
    calls = []

    def action():
        calls.append(1)
        raise FileNotFoundError

    with pytest.raises(FileNotFoundError):
        retry(action, final=(FileNotFoundError,), sleep=lambda s: None)
    assert len(calls) == 1


def test_dedupe_within_and_across_writes(spark):
    name = new_name()
    first = ingest_files(files_frame(spark, [("a.csv", HEAD + "d1,a,1\nd2,a,2\n"), ("b.csv", HEAD + "d2,b,9\nd3,b,3\n")]))
    write_outcomes(first, name, CREATE_AND_DEDUPE)
    expected = [("d1", 1, "a", 1, "a"), ("d2", 2, "a", 2, "a"), ("d3", 3, "b", 3, "b")]
    assert content(spark, name) == expected
    again = ingest_files(files_frame(spark, [("c.csv", HEAD + "d3,c,7\nd2,c,7\n")]))
    write_outcomes(again, name, CREATE_AND_DEDUPE)
    assert content(spark, name) == expected
    more = ingest_files(files_frame(spark, [("c.csv", HEAD + "d4,c,7\nd2,c,7\n"), ("e.csv", HEAD + "d4,e,8\n")]))
    write_outcomes(more, name, CREATE_AND_DEDUPE)
    assert content(spark, name) == [*expected, ("d4", 7, "c", 7, "c")]


def test_created_table_is_plain(spark):
    name = create_table(spark, new_name())
    create_table(spark, name)
    assert [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema] == [
        ("date", "string"), ("max_temp", "int"), ("max_temp_city", "string"), ("min_temp", "int"), ("min_temp_city", "string"),
    ]
    assert not any(c.isPartition for c in spark.catalog.listColumns(name))


def test_columns_go_by_name_and_must_not_be_null(spark):
    name = create_table(spark, new_name())
    turned = spark.createDataFrame([("MinCity", 1, "MaxCity", 2, "d")], "min_temp_city string, min_temp int, max_temp_city string, max_temp int, date string")
    append_rows(turned, name)
    assert content(spark, name) == [("d", 2, "MaxCity", 1, "MinCity")]
    with pytest.raises(Exception, match="NULL in required column date"):
        append_rows(turned.selectExpr("* except (date)", "CAST(NULL AS STRING) AS date"), name)
    assert len(content(spark, name)) == 1


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        write_outcomes(outcome_frame(spark, ("SUCCESS", 1)), "t", "upsert")


def test_adhoc(spark, tmp):
    name = create_table(spark, new_name())
    rows = [(f"d{i:02}", i, "a", i, 'b,"c"') for i in range(30)]
    append_rows(spark.createDataFrame(rows, "date string, max_temp int, max_temp_city string, min_temp int, min_temp_city string"), name)
    assert [r.date for r in run_sql(spark, table=name).collect()] == [f"d{i:02}" for i in range(20)]
    assert run_sql(spark, f"SELECT count(*) AS n FROM {name}").first().n == 30
    assert [r.tableName for r in list_tables(spark, name.split(".")[0]).collect()] == ["summary"]
    write_csv(run_sql(spark, f"SELECT date, min_temp_city FROM {name} WHERE date = 'd01'").coalesce(1), f"{tmp}/out")
    assert spark.read.csv(f"{tmp}/out", header=True, escape="\\").first().asDict() == {"date": "d01", "min_temp_city": 'b,"c"'}
    import glob

    text = open(glob.glob(f"{tmp}/out/part-*")[0]).read()
    assert text.splitlines()[0] == '"date","min_temp_city"'
