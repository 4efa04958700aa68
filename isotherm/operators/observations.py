"""Files to observations, all formats in one scan.

Each format's parser turns the text into an array of units. The arrays of all
formats are zipped (a file fills exactly one of them) and exploded once, so a
mixed input is read once, without a union of one branch per format.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions.text import sql_int, sql_list, sql_text, sql_trimmed, sql_visible, utf8
from isotherm.operators.delimited import delimited_parser
from isotherm.operators.detect import detect_format
from isotherm.operators.json_records import json_parser
from isotherm.operators.parser import FIELDS, Parser, evaluated_once, with_expressions
from isotherm.operators.xml_records import DEFAULT_RECORD_TAG, xml_parser

# --- fixed values ---------------------------------------------------------
UNSUPPORTED = "Unsupported file format: "
BAD_NUMBER = 'For input string: "'
METADATA = ("bucket_url", "object_name", "event_time", "event_source")
#: Kept with a file's outcome where the input has it: why the object could not be read.
READ_ERROR = "read_error"
# --------------------------------------------------------------------------


def default_parsers(record_tag: str = DEFAULT_RECORD_TAG) -> list[Parser]:
    # XML comes first: its Python stage then sees no other parser's arrays.
    return [xml_parser(record_tag), delimited_parser(), json_parser()]


def with_text(files: DataFrame) -> DataFrame:
    """Both forms of the content; either may be missing from the input."""
    if "text" not in files.columns:
        files = files.withColumn("text", utf8(F.col("content")))
    if "content" not in files.columns:
        files = files.withColumn("content", F.col("text").cast("binary"))
    return files


def with_format(files: DataFrame) -> DataFrame:
    """Add ``format`` unless the input brings it."""
    if "format" in files.columns:
        return files
    name = F.col("object_name") if "object_name" in files.columns else F.lit(None).cast("string")
    return files.withColumn("format", detect_format(name, F.col("text")))


def parse_files(files: DataFrame, parsers: Sequence[Parser] | None = None) -> DataFrame:
    """Units of all files as readings.

    ``files`` has a unique ``file_id``, ``content`` or ``text``, and may have
    ``format`` and the notification columns. The result has at least one row
    per file::

        file_id, pos, date, city, temperature, error, meta

    A row is an observation, or an error, or neither. ``meta`` (format and
    notification) stands on a file's first row only, so that long names are
    not repeated on each line.
    """
    parsers = default_parsers() if parsers is None else list(parsers)
    files = with_format(with_text(files))
    metadata = [name for name in (*METADATA, READ_ERROR) if name in files.columns]

    # Per file: the units as each format's parser sees them.
    opened = files.select("file_id", F.struct("format", *metadata).alias("meta"), "format", "text", "content")
    for parser in parsers:
        opened = parser.open(opened)
    known = [name for parser in parsers for name in parser.formats]
    failures = [f"CASE WHEN format NOT IN {sql_list(known)} THEN concat('{UNSUPPORTED}', format) END"]
    failures += [f"{p.name}_failure" for p in parsers if f"{p.name}_failure" in opened.columns]
    contexts = [f"{p.name}_context" for p in parsers if f"{p.name}_context" in opened.columns]
    arrays = ", ".join(f"{p.name}_units" for p in parsers)
    units = opened.selectExpr(
        "file_id",
        "meta",
        "format",
        *contexts,
        f"coalesce({', '.join(failures)}, NULL) AS failure",
        f"posexplode_outer(arrays_zip({arrays})) AS (at, unit)",
    ).selectExpr(
        "file_id",
        "CASE WHEN coalesce(at, 0) = 0 THEN meta END AS meta",
        "format",
        *contexts,
        "failure",
        "CAST(coalesce(at, 0) AS BIGINT) AS pos",
        "unit",
    )

    # Per unit: the texts of a record, then one check for all formats.
    for parser in parsers:
        units = parser.read(units)
    read = units.selectExpr(
        "file_id",
        "pos",
        "meta",
        "format",
        "failure",
        f"coalesce({' OR '.join(f'{p.name}_present' for p in parsers)}, false) AS is_record",
        *[f"coalesce({', '.join(f'{p.name}_{field}' for p in parsers)}, NULL) AS {field}" for field in FIELDS],
    )
    return check_fields(read, parsers, ("file_id", "pos", "meta"))


def check_fields(read: DataFrame, parsers: Sequence[Parser], carry: Sequence[str]) -> DataFrame:
    """Texts to observation or error; fields are checked in their order.

    ``read`` has ``format``, ``failure``, ``is_record`` and the three texts.
    """

    def choose(values: dict[str, str | None]) -> str:
        """SQL that picks a text by format."""
        cases = [f"WHEN {sql_text(fmt)} THEN {sql_text(v)}" for fmt, v in values.items() if v is not None]
        return f"CASE format {' '.join(cases)} END" if cases else "CAST(NULL AS STRING)"

    as_is = [fmt for p in parsers if not p.trims for fmt in p.formats]
    trim = {f: sql_trimmed(f) for f in FIELDS}
    if as_is:
        for field in ("date", "city"):
            trim[field] = f"CASE WHEN format IN {sql_list(as_is)} THEN {field} ELSE {trim[field]} END"
    trimmed = with_expressions(read, **trim)

    # Which field is at fault, and whether it is absent or blank; the words follow.
    may_be_blank = f"format IN {sql_list([fmt for p in parsers if p.blank is None for fmt in p.formats] or [''])}"
    faults = " ".join(
        f"WHEN {f} IS NULL THEN '-{f}' WHEN NOT {sql_visible(f)} AND NOT {may_be_blank} THEN '+{f}'" for f in FIELDS
    )
    checked = with_expressions(
        trimmed, number=sql_int("temperature"), fault=f"CASE WHEN is_record AND failure IS NULL THEN CASE {faults} END END"
    )
    absent = choose({fmt: p.missing for p in parsers for fmt in p.formats})
    blank = choose({fmt: p.blank for p in parsers for fmt in p.formats})
    judged = with_expressions(
        checked,
        error=(
            "CASE WHEN failure IS NOT NULL THEN failure "
            f"WHEN startswith(fault, '-') THEN concat({absent}, substring(fault, 2)) "
            f"WHEN fault IS NOT NULL THEN concat({blank}, substring(fault, 2)) "
            f"WHEN is_record AND number IS NULL THEN concat('{BAD_NUMBER}', temperature, '\"') END"
        ),
    )
    good = "is_record AND error IS NULL"
    return judged.selectExpr(
        *carry,
        f"CASE WHEN {good} THEN date END AS date",
        f"CASE WHEN {good} THEN city END AS city",
        f"CASE WHEN {good} THEN number END AS temperature",
        "error",
    )


def valid_observations(readings: DataFrame) -> DataFrame:
    """The observations among the readings of ``parse_files``.

    Rows of files that fail elsewhere are still among them; use
    ``file_outcomes`` for the whole-file rule.
    """
    settled = evaluated_once(readings, ["file_id", "pos"], FIELDS)
    return settled.where("date IS NOT NULL")
