"""Delimited files: a header line, then one observation per line.

There is no quoting. Columns are found by name in any case and order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from isotherm.functions.text import (
    LEADING_BLANK,
    LINE_BREAK,
    TRIMMED,
    delimiter_pattern,
    sql_list,
    sql_text,
    sql_visible,
)
from isotherm.operators.parser import FIELDS, Parser, with_expressions

# --- fixed values ---------------------------------------------------------
DELIMITERS = {"CSV": ",", "TSV": "\t"}
MISSING = "Missing required column: "
BLANK = "Blank required column: "
# --------------------------------------------------------------------------


def split_cells(line: str, delimiters: Mapping[str, str]) -> str:
    """SQL for the cells of a line; empty cells at the end are kept."""
    cases = [
        f"WHEN {sql_text(fmt)} THEN split({line}, {sql_text(delimiter_pattern(delimiter))}, -1)"
        for fmt, delimiter in delimiters.items()
    ]
    return f"CASE format {' '.join(cases)} END"


def with_positions(df: DataFrame, header: str, delimiters: Mapping[str, str], positions: str) -> DataFrame:
    """Add a struct with the index of each field's cell, NULL if there is none.

    The first header that equals the field ignoring case names the column; if
    that very header is repeated, its last cell is the one.
    """
    trim = sql_text(TRIMMED)
    cells = with_expressions(df, _header=f"transform({split_cells(header, delimiters)}, x -> btrim(x, {trim}))")
    named = with_expressions(
        cells, **{f"_{f}": f"get(filter(_header, x -> x RLIKE r'(?iu)\\A{f}\\z'), 0)" for f in FIELDS}
    )
    last = ", ".join(
        f"'{f}', CAST(size(_header) - array_position(reverse(_header), _{f}) AS INT)" for f in FIELDS
    )
    placed = with_expressions(named, **{positions: f"named_struct({last})"})
    return placed.drop("_header", *[f"_{f}" for f in FIELDS])


def cell_text(cells: str, position: str) -> str:
    """SQL for a cell; a line that is too short has empty cells."""
    return f"CASE WHEN {cells} IS NOT NULL AND {position} IS NOT NULL THEN coalesce(get({cells}, {position}), '') END"


def delimited_parser(delimiters: Mapping[str, str] = DELIMITERS) -> Parser:
    line_break = sql_text(LINE_BREAK)

    def open_files(files: DataFrame) -> DataFrame:
        lines = (
            f"CASE WHEN format IN {sql_list(delimiters)} THEN "
            f"CASE WHEN contains(text, '\\r') THEN split(text, {line_break}) ELSE split(text, '\\n') END "
            "ELSE array() END"
        )
        # White space up to the header's first visible character; the line
        # breaks inside it are the blank lines in front of the header.
        before = f"regexp_extract(text, {sql_text(LEADING_BLANK)}, 0)"
        cut = with_expressions(
            files, delimited_units=lines, delimited_header_at=f"size(split({before}, {line_break})) - 1"
        )
        headed = with_expressions(cut, _line="get(delimited_units, delimited_header_at)")
        placed = with_positions(headed, "_line", delimiters, "_positions")
        context = "named_struct('header_at', delimited_header_at, 'at', _positions)"
        return with_expressions(placed, delimited_context=context).drop(
            "_line", "_positions", "delimited_header_at"
        )

    def read(units: DataFrame) -> DataFrame:
        line = "unit.delimited_units"
        present = f"pos > delimited_context.header_at AND {sql_visible(line)}"
        cut = with_expressions(
            units,
            delimited_cells=f"CASE WHEN {present} THEN {split_cells(line, delimiters)} END",
        )
        return with_expressions(
            cut,
            delimited_present="delimited_cells IS NOT NULL",
            **{f"delimited_{f}": cell_text("delimited_cells", f"delimited_context.at.{f}") for f in FIELDS},
        )

    return Parser("delimited", tuple(delimiters), open_files, read, True, MISSING, BLANK)
