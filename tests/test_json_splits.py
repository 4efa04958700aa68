"""JSON files cut into chunks anywhere must give what the whole files give."""

import json
import random

import pytest

from isotherm import ingest_files
from isotherm.operators.outcomes import split_file_outcomes, split_file_rows
from isotherm.schemas import SUMMARY_COLUMNS
from isotherm.sources import json_splits
from isotherm.sources.json_splits import Marks, scan_json


def record(pick):
    city = pick.choice(["a", 'q"uo[te', "back\\slash\\", "}]{,", "é日", "\\\"records\\\": ["])
    return {"date": f"2024-0{pick.randint(1, 3)}", "city": city, "temperature": pick.randint(-9, 9), "x": [[1, {"records": [2]}], "]"]}


def texts():
    pick = random.Random(3)
    rows = [record(pick) for _ in range(40)]
    plain, spaced = json.dumps(rows, ensure_ascii=False), json.dumps(rows, indent=3)
    one = json.dumps(rows[0])
    return {
        "plain": plain,
        "spaced": "\n " + spaced + "\n trailing ] text [",
        "records": json.dumps({"a": {"records": [1]}, "b": "\"records\":[", "records": rows, "z": [1, "]"]}, indent=1),
        "records_twice": '{"records": [1], "records" \n:\t ' + plain + "}",
        "records_null": '{"records": null, "date": "d", "city": "c", "temperature": 4}',
        "records_object": '{"date": "d", "city": "c", "temperature": 4, "records": {"a": 1}}',
        "records_empty": '{"records": [ ], "x": 1}',
        "single": one,
        "two_lines": one + "\n" + one,
        "empty_array": " [ \n ] ",
        "bom": "\ufeff" + plain,
        "scalar": "5",
        "word": "nonsense",
        "blank": " \n ",
        "unclosed": plain[:-1],
        "unclosed_object": '{"records": ' + plain,
        "wrong_close": plain[:-1] + "}",
        "extra_comma": plain[:-1] + ",]",
        "missing_comma": "[" + one + " " + one + "]",
        "bad_record": "[" + one + ", {\"date\": }," + one + "]",
        "bad_frame": '{"a": , "records": [' + one + "]}",
        "missing_city": "[" + one + ', {"date": "d", "temperature": 4}, {"city": "c"}]',
        "null_element": "[" + one + ", null]",
        "open_string": '["abc',
    }


@pytest.mark.parametrize("split_bytes", [151, 1 << 20])
def test_same_as_whole_files(spark, tmp, split_bytes):
    files = texts()
    for name, text in files.items():
        with open(f"{tmp}/{name}.json", "w", newline="") as out:
            out.write(text)
    with open(f"{tmp}/bad_utf8.json", "wb") as out:
        out.write(b'[{"date":"d","city":"\xff","temperature":1}]' + b" " * 300)
    content = {name: text.encode() for name, text in files.items()} | {"bad_utf8": b'[{"date":"d","city":"\xff","temperature":1}]'}
    whole = ingest_files(spark.createDataFrame([(k, bytearray(v), "JSON") for k, v in content.items()], "file_id string, content binary, format string"))
    expected = {r.file_id: r for r in whole.collect()}
    readings = scan_json(spark, tmp, split_bytes)

    def short(path):
        return path.rsplit("/", 1)[1].removesuffix(".json")

    got = {short(r.file_id): (r.status, r.records_processed, r.error_message) for r in split_file_outcomes(readings).collect()}
    assert got == {name: (r.status, r.records_processed, r.error_message) for name, r in expected.items()}
    rows = sorted((short(r.file_id), *[r[c] for c in SUMMARY_COLUMNS]) for r in split_file_rows(readings).collect())
    assert rows == sorted((name, *r) for name, outcome in expected.items() for r in outcome.records)


def test_states_compose(tmp):
    """Wherever a text is cut, the second part starts in the state in which the first one ends."""
    import numpy as np

    pick = random.Random(8)
    for _ in range(200):
        data = np.frombuffer(json.dumps([record(pick), "\\\\", "a\\\""]).encode(), np.uint8)
        whole, cut = Marks(data, 0, 0, 0), pick.randrange(len(data) + 1)
        a = Marks(data[:cut], 0, 0, 0)
        b = Marks(data[cut:], a.in_string, a.escaped, a.end_depth)
        assert [*a.at, *(b.at + cut)] == list(whole.at) and [*a.depth, *b.depth] == list(whole.depth)
        assert (b.in_string, b.end_depth) == (0, 0)


def test_no_task_reads_a_large_file(spark, tmp, monkeypatch):
    """The records of one file come from as many tasks as it has ranges."""
    with open(f"{tmp}/a.json", "w") as out:
        out.write(json.dumps([{"date": f"d{i % 7}", "city": "c", "temperature": i % 90} for i in range(20_000)]))
    readings = scan_json(spark, tmp, 100_000)
    assert split_file_outcomes(readings).first()["records_processed"] == 7
    assert readings.where("date IS NOT NULL").count() == 20_000
    read = []
    row = {"start": 0, "stop": 40, "size": 1 << 30, "in_string": 0, "escaped": 0, "depth": 0}
    text = b"[" + b'{"a":12345},' * 9
    found = list(json_splits.elements(lambda a, b: read.append(b - a) or text[a:b], row, 1, 0, None))
    assert [x[1] for x in found] == [b'{"a":12345}'] * 4 and sum(read) < 1 << 18
