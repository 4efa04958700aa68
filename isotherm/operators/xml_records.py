"""XML files: one record at the root, or one record per child of the root.

Plain files, whose records all carry the expected tag, are read by the built-in
``from_xml``. Whatever that reading cannot settle beyond doubt (other record
tags, markup inside a value, a DOCTYPE, an encoding other than UTF-8, text that
is not well formed) goes in Arrow batches to a small reader on the standard
library; those files are the exception, all others send it a NULL.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.functions.text import TRIMMED, sql_text
from isotherm.operators.parser import FIELDS, Parser, read_records, with_expressions

# --- fixed values ---------------------------------------------------------
MISSING = "Missing required XML element: "
DEFAULT_RECORD_TAG = "Observation"
# --------------------------------------------------------------------------

RECORD = T.StructType([T.StructField(field, T.StringType()) for field in FIELDS])
PARSED = T.StructType([T.StructField("records", T.ArrayType(RECORD)), T.StructField("error", T.StringType())])
CORRUPT = "_corrupt_record"
OTHER_TAGS = "xs_any"

# Start of a plain file: an optional byte order mark, an optional declaration
# that names no encoding but UTF-8, then the root element's tag.
PLAIN_START = (
    r"^\uFEFF?(?:<\?xml\s+version=[\"'][0-9.]+[\"'](?:\s+encoding=[\"'](?i:utf-?8)[\"'])?"
    r"(?:\s+standalone=[\"']\w+[\"'])?\s*\?>)?\s*<([^\s/>!?]+)"
)
ATTRIBUTES = r"(?:\s+[^\s=<>\"'/]+\s*=\s*(?:\"[^\"<]*\"|'[^'<]*'))*\s*"
EMPTY_END = r"/>\s*\z"


def _schema(record_tag: str) -> T.StructType:
    return T.StructType(
        [
            *RECORD.fields,
            T.StructField(record_tag, T.ArrayType(RECORD)),
            T.StructField(OTHER_TAGS, T.ArrayType(T.StringType())),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )


def _ends_plainly() -> str:
    """SQL: the first closing tag of the root is also the end of the text.

    An empty root (``<Root/>``) ends where it starts.
    """
    tail = "substring(text, instr(text, concat('</', _root)) + length(_root) + 2)"
    closed = f"_root <> '' AND instr(text, concat('</', _root)) > 0 AND {tail} RLIKE r'^\\s*>\\s*\\z'"
    empty = f"text RLIKE {sql_text(PLAIN_START + ATTRIBUTES + EMPTY_END)}"
    return f"({closed} OR {empty})"


def _native(files: DataFrame, record_tag: str) -> DataFrame:
    """Add ``_records`` by ``from_xml`` and whether they settle the matter.

    Every field value that holds a ``<`` may be markup or escaped text, every
    tag besides the expected ones may be a record: neither is settled here.
    """
    own = F.when(F.col("format") == "XML", F.col("text"))
    document = files.withColumns(
        {
            "_document": F.from_xml(own, _schema(record_tag), {"mode": "PERMISSIVE"}),
            "_root": F.regexp_extract(own, f"{PLAIN_START}{ATTRIBUTES}>", 1),
        }
    )
    many, fields = f"_document.`{record_tag}`", ", ".join(f"'{f}', _document.{f}" for f in FIELDS)
    single = f"named_struct({fields})"
    flat = "coalesce(_document.date, _document.city, _document.temperature) IS NOT NULL"
    read = with_expressions(
        document,
        _records=f"CASE WHEN {many} IS NOT NULL THEN {many} WHEN {flat} THEN array({single}) ELSE array() END",
        _one_shape=f"NOT ({many} IS NOT NULL AND {flat})",
    )
    marked_up = "exists(_records, r -> contains(concat_ws(' ', r.date, r.city, r.temperature), '<'))"
    settled = (
        f"_document.{CORRUPT} IS NULL AND _document.{OTHER_TAGS} IS NULL AND _one_shape AND NOT {marked_up} "
        f"AND NOT contains(text, '<!DOCTYPE') AND is_valid_utf8(CAST(content AS STRING)) AND {_ends_plainly()}"
    )
    return with_expressions(read, _settled=f"CASE WHEN format = 'XML' THEN coalesce({settled}, false) END")


def element_children(element) -> list:
    return [node for node in element.childNodes if node.nodeType == node.ELEMENT_NODE]


def element_text(element) -> str:
    """All text below an element, in document order."""
    parts, pending = [], [element]
    while pending:
        node = pending.pop()
        if node.nodeType in (node.TEXT_NODE, node.CDATA_SECTION_NODE):
            parts.append(node.data)
        elif node.nodeType == node.ELEMENT_NODE:
            pending.extend(reversed(node.childNodes))
    return "".join(parts)


def parse_root(content: bytes):
    """Root element of one XML document; raises if it is not well formed."""
    from xml.dom import expatbuilder

    class Builder(expatbuilder.ExpatBuilder):
        def start_doctype_decl_handler(self, *_):
            raise ValueError("DOCTYPE is not allowed")

    return Builder().parseString(content).documentElement


def read_document(content: bytes) -> list[dict]:
    """Records of one XML document; raises if it is not well formed."""
    root = parse_root(content)
    children = element_children(root)
    if not children:
        return []
    record_elements = children if any(element_children(child) for child in children) else [root]
    records = []
    for element in record_elements:
        found = {node.tagName.lower(): element_text(node).strip(TRIMMED) for node in element_children(element)}
        records.append({field: found.get(field) for field in FIELDS})
    return records


# Executors get the reader by value; they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.pandas_udf(PARSED)
def read_odd_documents(contents: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in contents:
        records, errors = [], []
        for content in batch:
            rows, error = None, None
            if content is not None:
                try:
                    rows = read_document(bytes(content))
                except Exception as failure:  # any unreadable document is that file's failure
                    error = f"Malformed XML document: {failure}"
            records.append(rows)
            errors.append(error)
        yield pd.DataFrame({"records": records, "error": errors}, dtype=object)


def xml_parser(record_tag: str = DEFAULT_RECORD_TAG) -> Parser:
    """A parser for any XML file; ``record_tag`` only says which are plain."""

    def open_files(files: DataFrame) -> DataFrame:
        native = _native(files, record_tag)
        odd = native.withColumn("_odd", read_odd_documents(F.expr("CASE WHEN NOT _settled THEN content END")))
        units = "CASE WHEN _settled THEN _records ELSE coalesce(_odd.records, array()) END"
        return with_expressions(odd, xml_units=units, xml_failure="CASE WHEN NOT _settled THEN _odd.error END").drop(
            "_document", "_root", "_records", "_one_shape", "_settled", "_odd"
        )

    return Parser("xml", ("XML",), open_files, read_records("xml"), True, MISSING, MISSING)
