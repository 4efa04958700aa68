"""JSON files: an array, an object with a ``records`` array, or one object."""

from __future__ import annotations

from pyspark.sql import DataFrame

from isotherm.functions.text import sql_visible
from isotherm.operators.parser import FIELDS, Parser, read_records, with_expressions

# --- fixed values ---------------------------------------------------------
MIN_INT = -2147483648
MAX_INT = 2147483647
# A text temperature with this content counts as absent, and absent as zero.
NULL_TEXT = "null"
ABSENT_TEMPERATURE = "0"
# --------------------------------------------------------------------------

MISSING = "No text or number for: "
MALFORMED = "Malformed JSON document"
#: A single value has to fit Spark's VARIANT; records of an array are values of their own.
MOST_VALUE_BYTES = 128 << 20
TOO_LARGE = "JSON object that is malformed or has no records and more than 128 MiB"
STRICT = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"


def scalar_text(value: str, text: str, container: str) -> str:
    """SQL for a scalar's text, where ``text`` is its plain text; ``container`` if it is no scalar.

    Fractional numbers print as doubles. The kind of the value is looked at
    only if the text can be that of a container or of a fraction.
    """
    kind = f"schema_of_variant({value})"
    unsure = f"ascii({text}) IN (91, 123) OR contains({text}, '.') OR contains({text}, 'E')"
    fractional = f"({kind} = 'DOUBLE' OR (startswith({kind}, 'DECIMAL') AND NOT endswith({kind}, ',0)')))"
    return (
        f"CASE WHEN NOT ({unsure}) THEN {text} "
        f"WHEN startswith({kind}, 'OBJECT') OR startswith({kind}, 'ARRAY') THEN {container} "
        f"WHEN {fractional} THEN CAST(try_variant_get({value}, '$', 'double') AS STRING) ELSE {text} END"
    )


def temperature_text(value: str, text: str, kind: str) -> str:
    """SQL for the temperature as the text of an integer where it counts as one.

    Absent and blank count as 0; a number loses its fraction. Any other text
    is left for the integer check to refuse: true, {}, 84.5 as text, and
    numbers that do not fit 32 bits.
    """
    number = f"try_variant_get({value}, '$', 'double')"
    numeric = f"({kind} = 'DOUBLE' OR startswith({kind}, 'DECIMAL'))"
    empty = f"{kind} = 'STRING' AND (NOT {sql_visible(text)} OR trim({text}) = '{NULL_TEXT}')"
    return (
        f"CASE WHEN {kind} = 'BIGINT' THEN {text} "
        f"WHEN {kind} IS NULL OR {kind} = 'VOID' OR ({empty}) THEN '{ABSENT_TEMPERATURE}' "
        f"WHEN {numeric} AND {number} BETWEEN {MIN_INT} AND {MAX_INT} THEN CAST(CAST({number} AS INT) AS STRING) "
        f"ELSE {text} END"
    )


def open_files(files: DataFrame) -> DataFrame:
    """Only the first JSON value of a file counts; text after it is ignored."""
    body = "CASE WHEN startswith(text, '\\ufeff') THEN substring(text, 2) ELSE text END"
    # The records are read one by one, so that only each of them has to fit a VARIANT, not the file.
    rooted = with_expressions(
        files,
        _root=(
            "CASE WHEN format = 'JSON' AND is_valid_utf8(CAST(content AS STRING)) THEN "
            f"CASE WHEN ascii({body}) IN (91, 123) THEN ascii({body}) ELSE ascii(ltrim(' \\t\\r\\n', {body})) END END"
        ),
    )
    listed = with_expressions(
        rooted,
        _listed=(
            f"CASE WHEN _root = 91 THEN from_json({body}, 'array<variant>', {STRICT}) "
            f"WHEN _root = 123 THEN from_json({body}, 'records array<variant>', {STRICT}).records END"
        ),
    )
    parsed = with_expressions(
        listed, _document=f"CASE WHEN _root <> 91 AND _listed IS NULL THEN try_parse_json({body}) END"
    )
    nodes = with_expressions(
        parsed, _nodes="CASE WHEN _listed IS NOT NULL THEN _listed WHEN _document IS NULL THEN array() ELSE array(_document) END"
    )
    # The node goes along: fields whose text leaves a doubt are looked at again.
    values = ", ".join(f"'{f}_text', try_variant_get(n, '$.{f}', 'string')" for f in FIELDS)
    node = {f: f"try_variant_get(v.n, '$.{f}', 'variant')" for f in FIELDS}
    kind = "schema_of_variant(try_variant_get(n, '$.temperature', 'variant'))"
    texts = ", ".join(
        [
            *[f"'{f}', {scalar_text(node[f], f'v.{f}_text', 'NULL')}" for f in ("date", "city")],
            f"'temperature', {temperature_text(node['temperature'], 'v.temperature_text', 'v.kind')}",
        ]
    )
    return with_expressions(
        nodes,
        json_units=(
            f"transform(transform(_nodes, n -> named_struct('n', n, {values}, 'kind', {kind})), v -> named_struct({texts}))"
        ),
        json_failure=(
            "CASE WHEN format = 'JSON' AND _document IS NULL AND _listed IS NULL THEN "
            f"CASE WHEN _root = 123 AND octet_length(text) > {MOST_VALUE_BYTES} THEN '{TOO_LARGE}' ELSE '{MALFORMED}' END END"
        ),
    ).drop("_document", "_nodes", "_listed", "_root")


def json_parser() -> Parser:
    return Parser("json", ("JSON",), open_files, read_records("json"), False, MISSING, None)
