"""File format from the name, else from the content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isotherm.functions.text import LEADING_BLANK, NON_BLANK

# --- fixed values ---------------------------------------------------------
EXTENSIONS = {
    "CSV": (".csv",),
    "TSV": (".tsv", ".tab"),
    "JSON": (".json", ".jsonl", ".ndjson"),
    "XML": (".xml",),
}
# --------------------------------------------------------------------------


def format_by_name(name: Column) -> Column:
    """Format by extension in any case, NULL if the name tells nothing."""
    lowered = F.lower(name)
    found = F.lit(None).cast("string")
    for kind, endings in EXTENSIONS.items():
        matches = F.lit(False)
        for ending in endings:
            matches = matches | lowered.endswith(ending)
        found = F.coalesce(found, F.when(matches, F.lit(kind)))
    return found


def format_by_content(text: Column) -> Column:
    """Format by the first visible character, then by a tab, then by a comma."""
    first = F.regexp_extract(text, NON_BLANK, 0)
    inner_tab = text.rlike(rf"{LEADING_BLANK}{NON_BLANK}[^\t]*\t")
    return (
        F.when(first.isin("{", "["), F.lit("JSON"))
        .when(first == "<", F.lit("XML"))
        .when(inner_tab, F.lit("TSV"))
        .when(F.contains(text, F.lit(",")), F.lit("CSV"))
        .otherwise(F.lit("UNKNOWN"))
    )


def detect_format(name: Column, text: Column) -> Column:
    return F.coalesce(format_by_name(name), format_by_content(text))
