import pytest

from tests.helpers import results

OK = [("d", 5, "c", 5, "c")]
FAIL = None
DATE = "Missing required XML element: date"
REC = "<Date>d</Date><City>c</City><Temperature>5</Temperature>"
DECL = '<?xml version="1.0" encoding="UTF-8"?>\n'

CASES = [
    ("records", f"<W><Observation>{REC}</Observation></W>", OK),
    ("declaration and space", f"{DECL}<W>\n <Observation>\n {REC}\n </Observation>\n</W>\n", OK),
    ("attributes", "<W a='1'><Observation id='2'><Date>d</Date><City>c</City><Temperature unit=\"F\"> 5 </Temperature></Observation></W>", OK),
    ("empty root", "<W/>", []),
    ("empty root with attribute", "<W x='1' />", []),
    ("root with text only", "<W>text</W>", []),
    ("unknown tags only", "<W><Foo>1</Foo></W>", DATE),
    ("single record", f"<W>{REC}</W>", OK),
    ("single record with another tag", f"<W><Foo>1</Foo>{REC}</W>", OK),
    ("other record tag", f"<W><Row>{REC}</Row></W>", OK),
    ("mixed record tags", f"<W><Row>{REC}</Row><Observation><Date>d</Date><City>e</City><Temperature>7</Temperature></Observation></W>",
     [("d", 7, "e", 5, "c")]),
    ("childless sibling", f"<W><Observation>{REC}</Observation><Observation/></W>", DATE),
    ("childless sibling of another tag", f"<W><Observation>{REC}</Observation><Note>x</Note></W>", DATE),
    ("all records childless", "<W><Observation/><Observation>t</Observation></W>", DATE),
    ("tags in any case", "<W><OBSERVATION><DATE>d</DATE><city>c</city><temperature>5</temperature></OBSERVATION></W>", OK),
    ("last duplicate wins", f"<W><Observation><Date>x</Date>{REC}</Observation></W>", OK),
    ("last duplicate in other case wins", f"<W><Observation><date>x</date>{REC}</Observation></W>", OK),
    ("nested markup", "<W><Observation><Date>d</Date><City>a<b>z</b>q</City><Temperature>5</Temperature></Observation></W>",
     [("d", 5, "azq", 5, "azq")]),
    ("CDATA", "<W><Observation><Date>d</Date><City><![CDATA[a<b>&amp;]]></City><Temperature>5</Temperature></Observation></W>",
     [("d", 5, "a<b>&amp;", 5, "a<b>&amp;")]),
    ("escapes", "<W><Observation><Date>d</Date><City>a &amp; b</City><Temperature>5</Temperature></Observation></W>",
     [("d", 5, "a & b", 5, "a & b")]),
    ("escaped bracket", "<W><Observation><Date>d</Date><City>a&lt;b</City><Temperature>5</Temperature></Observation></W>",
     [("d", 5, "a<b", 5, "a<b")]),
    ("comment in value", "<W><Observation><Date>d</Date><City>a<!-- x -->b</City><Temperature>5</Temperature></Observation></W>",
     [("d", 5, "ab", 5, "ab")]),
    ("comment before root", f"<!-- hello --><W><Observation>{REC}</Observation></W>", OK),
    ("comment after root", f"<W><Observation>{REC}</Observation></W><!-- </W> -->", OK),
    ("city null stays text", "<W><Observation><Date>d</Date><City>null</City><Temperature>5</Temperature></Observation></W>",
     [("d", 5, "null", 5, "null")]),
    ("leading zeros", "<W><Observation><Date>d</Date><City>007</City><Temperature>005</Temperature></Observation></W>",
     [("d", 5, "007", 5, "007")]),
    ("missing city", "<W><Observation><Date>d</Date><Temperature>5</Temperature></Observation></W>", "Missing required XML element: city"),
    ("blank temperature", "<W><Observation><Date>d</Date><City>c</City><Temperature> </Temperature></Observation></W>",
     "Missing required XML element: temperature"),
    ("bad temperature", "<W><Observation><Date>d</Date><City>c</City><Temperature>5.5</Temperature></Observation></W>",
     'For input string: "5.5"'),
    ("date as attribute", "<W><Observation Date='d'><City>c</City><Temperature>5</Temperature></Observation></W>", DATE),
    ("fields nested deeper", f"<W><Observation><Inner>{REC}</Inner></Observation></W>", DATE),
    ("three levels, deeper fields ignored", f"<W><Observation>{REC}<X><City>zz</City></X></Observation></W>", OK),
    ("prefixed field", "<W><Observation><w:Date>d</w:Date><City>c</City><Temperature>5</Temperature></Observation></W>", DATE),
    ("prefixed record", f"<w:W><w:Observation>{REC}</w:Observation></w:W>", OK),
    ("DOCTYPE", f"<!DOCTYPE W><W><Observation>{REC}</Observation></W>", FAIL),
    ("DOCTYPE with entity", f'<!DOCTYPE W [<!ENTITY e "x">]><W><Observation>{REC}</Observation></W>', FAIL),
    ("unknown entity", "<W><Observation><Date>&e;</Date><City>c</City><Temperature>5</Temperature></Observation></W>", FAIL),
    ("not closed", f"<W><Observation>{REC}</Observation>", FAIL),
    ("wrongly closed", "<W><a></W>", FAIL),
    ("text after root", f"<W><Observation>{REC}</Observation></W>junk", FAIL),
    ("second root", f"<W><Observation>{REC}</Observation></W><W/>", FAIL),
    ("second root closed alike", f"<W><Observation>{REC}</Observation></W><W></W>", FAIL),
    ("empty root, then more", "<W/><X></X></W>", FAIL),
    ("empty root with bracket, then more", "<W a='>'/><X></X></W>", FAIL),
    ("unquoted attribute", "<W a=1><a/></W>", FAIL),
    ("not XML", "plain text", FAIL),
    ("empty", "", FAIL),
    ("space before declaration", f" {DECL}<W><Observation>{REC}</Observation></W>", FAIL),
    ("byte order mark", f"﻿{DECL}<W><Observation>{REC}</Observation></W>", OK),
    ("declared Latin-1", '<?xml version="1.0" encoding="ISO-8859-1"?><W><Observation><Date>d</Date><City>é</City><Temperature>5</Temperature></Observation></W>'.encode("latin-1"),
     [("d", 5, "é", 5, "é")]),
    ("not UTF-8", b"<W><Observation><Date>d</Date><City>\xff</City><Temperature>5</Temperature></Observation></W>", FAIL),
    ("em space city is blank", "<W><Observation><Date>d</Date><City> </City><Temperature>5</Temperature></Observation></W>",
     "Missing required XML element: city"),
    ("root tag as inner tag prefix", f"<W><Wx>{REC}</Wx></W>", OK),
    ("ties", "<W>" + "".join(f"<Observation><Date>d</Date><City>{c}</City><Temperature>{t}</Temperature></Observation>"
        for c, t in [("a", 3), ("b", 9), ("c", 9), ("e", 3)]) + "</W>", [("d", 9, "b", 3, "a")]),
]


@pytest.fixture(scope="module")
def xml_results(spark):
    return results(spark, [("f.xml", text) for _, text, _ in CASES])


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] for c in CASES])
def test_xml(xml_results, i):
    expected = CASES[i][2]
    status, got = xml_results[i]
    if isinstance(expected, list):
        assert (status, got) == ("SUCCESS", expected)
    else:
        assert status == "FAILURE"
        if expected:
            assert got == expected
