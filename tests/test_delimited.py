import pytest

from isotherm.operators.delimited import delimited_parser
from tests.helpers import outcomes, results

HEAD = "date,city,temperature\n"
ONE = ("SUCCESS", [("d", 5, "c", 5, "c")])

CASES = [
    ("wrong columns", "station,city,level\nq7,Oslo,12\nq8,Turin,9\n", "Missing required column: date"),
    ("empty file", "", []),
    ("only blank lines", " \n\t\n\n", []),
    ("header only, wrong columns", "p,q\n", []),
    ("blank lines", HEAD + "\n\n1999-12-31,Oslo,-3\n \n1999-12-31,Turin,8\n\n", [("1999-12-31", 8, "Turin", -3, "Oslo")]),
    ("missing cell", HEAD + "1999-12-31,Oslo,-3\n1999-12-31,Turin\n", "Blank required column: temperature"),
    ("blank lines before header", "\n \t \r\n\r" + HEAD + "d,c,5", [("d", 5, "c", 5, "c")]),
    ("CR line ends", "date,city,temperature\rd,c,5\rd,e,7\r", [("d", 7, "e", 5, "c")]),
    ("CRLF line ends", "date,city,temperature\r\nd,c,5\r\n\r\nd,e,7", [("d", 7, "e", 5, "c")]),
    ("no quoting", HEAD + '"d,x",c,5\n', 'For input string: "c"'),
    ("no quoting, cells kept", HEAD + '"d",c,5\n', [('"d"', 5, "c", 5, "c")]),
    ("header in any case and order", "x,TEMPERATURE, City ,Date\n0,5,c,d\n", [("d", 5, "c", 5, "c")]),
    ("extra cells", HEAD + "d,c,5,6,7\n", [("d", 5, "c", 5, "c")]),
    ("same header twice: last cell", "date,date,city,temperature\na,d,c,5\n", [("d", 5, "c", 5, "c")]),
    ("headers that differ by case: first", "Date,date,city,temperature\nd,a,c,5\n", [("d", 5, "c", 5, "c")]),
    ("case first, its own duplicate last", "Date,date,Date,city,temperature\nx,a,d,c,5\n", [("d", 5, "c", 5, "c")]),
    ("order of checks", "date,city,temperature\n,,\n", "Blank required column: date"),
    ("order of checks 2", "date,city,temperature\nd, ,x\n", "Blank required column: city"),
    ("missing city before blank temperature", "date,temperature\nd,\n", "Missing required column: city"),
    ("missing temperature", "date,city\nd,c\n", "Missing required column: temperature"),
    ("plus sign", HEAD + "d,c,+5\n", [("d", 5, "c", 5, "c")]),
    ("negative", HEAD + "d,c,-5\nd,e,0", [("d", 0, "e", -5, "c")]),
    ("fraction", HEAD + "d,c,5.5\n", 'For input string: "5.5"'),
    ("exponent", HEAD + "d,c,1e2\n", 'For input string: "1e2"'),
    ("overflow", HEAD + "d,c,2147483648\n", 'For input string: "2147483648"'),
    ("bare sign", HEAD + "d,c,-\n", 'For input string: "-"'),
    ("inner space", HEAD + "d,c,1 2\n", 'For input string: "1 2"'),
    ("blank temperature", HEAD + "d,c,  \n", "Blank required column: temperature"),
    ("control characters are trimmed", HEAD + "\x01d\x1f,\x00c ,\t5\x0b\n", [("d", 5, "c", 5, "c")]),
    ("em space is blank but not trimmed", HEAD + "d, ,5\n", "Blank required column: city"),
    ("no-break space is a value", HEAD + "d, ,5\n", [("d", 5, " ", 5, " ")]),
    ("em space line is blank", HEAD + "  \nd,c,5\n", [("d", 5, "c", 5, "c")]),
    ("byte order mark hides the first column", "﻿" + HEAD + "d,c,5\n", "Missing required column: date"),
    ("bad last row fails all", HEAD + "d,c,5\nd,c,6\nd,c,x\n", 'For input string: "x"'),
    ("first bad row is reported", HEAD + "d,c,5\nd,c,x1\n,c,6\nd,c,x2\n", 'For input string: "x1"'),
    ("dates sort as text", HEAD + "b,c,5\na,c,5\n10,c,5\n9,c,5\n", [(d, 5, "c", 5, "c") for d in ("10", "9", "a", "b")]),
    ("ties keep the first", HEAD + "d,a,5\nd,b,5\nd,c,4\nd,e,4\nd,f,5\n", [("d", 5, "a", 4, "c")]),
    ("all equal", HEAD + "d,z,5\nd,a,5\n", [("d", 5, "z", 5, "z")]),
    ("smallest number has no hottest city", HEAD + "d,a,-2147483648\n", [("d", -2147483648, "", -2147483648, "a")]),
    ("largest number has no coldest city", HEAD + "d,a,2147483647\n", [("d", 2147483647, "a", 2147483647, "")]),
    ("dotless i equals i ignoring case", "date,cıty,temperature\nd,c,5\n", [("d", 5, "c", 5, "c")]),
    ("leading tab is an empty column in TSV only", "\tdate,city,temperature\nd,c,5\n", [("d", 5, "c", 5, "c")]),
]


@pytest.fixture(scope="module")
def csv_results(spark):
    return results(spark, [("f.csv", text) for _, text, _ in CASES])


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] for c in CASES])
def test_csv(csv_results, i):
    expected = CASES[i][2]
    assert csv_results[i] == ("FAILURE" if isinstance(expected, str) else "SUCCESS", expected)


def test_tsv(spark):
    got = outcomes(
        spark,
        [
            ("k.tsv", "date\tcity\ttemperature\nfeb\tLa Paz\t11\nfeb\tLima\t24\n"),
            ("k.TAB", "\tdate\tcity\ttemperature\nx\td\tc\t5\n"),
            ("k.tsv", "date\tcity\ttemperature\nd\tc\t5\t\t\n"),
        ],
    )
    assert [row.format for row in got] == ["TSV"] * 3
    assert [tuple(r) for r in got[0].records] == [("feb", 24, "Lima", 11, "La Paz")]
    assert [tuple(r) for r in got[1].records] == [("d", 5, "c", 5, "c")]
    assert [tuple(r) for r in got[2].records] == [("d", 5, "c", 5, "c")]


def test_other_delimiters(spark):
    for delimiter in ("|", ";", "||", "."):
        text = delimiter.join(["date", "city", "temperature"]) + "\n" + delimiter.join(["d", "c", "5"]) + "\n"
        assert results(spark, [("f.csv", text)], [delimited_parser({"CSV": delimiter})]) == [ONE]


def test_bytes_that_are_not_utf8_are_replaced(spark):
    got = results(spark, [("f.csv", b"date,city,temperature\nd,a\xffb,5\n")])
    assert got == [("SUCCESS", [("d", 5, "a�b", 5, "a�b")])]


def test_metadata_and_counts(spark):
    good, bad = outcomes(spark, [("a.csv", HEAD + "d,c,5\nd,e,6\nf,c,5\n"), ("h.csv", "h\nv\n")])
    assert (good.bucket_url, good.object_name, good.event_time, good.event_source) == (
        "s3://in", "a.csv", "2024-01-15T00:00:00Z", "aws:s3",
    )
    assert (good.records_processed, good.records_written, good.error_message) == (2, 2, None)
    assert good.processing_time is not None and bad.processing_time is not None
    assert (bad.status, bad.records, bad.records_processed, bad.records_written) == ("FAILURE", [], 0, 0)
    assert bad.object_name == "h.csv"
