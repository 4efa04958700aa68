"""What a file parser is: two DataFrame functions around one shared explode.

``open`` adds to each file an array with one element per possible record. The
arrays of all parsers are exploded together, once, so the input is scanned once
however many formats it mixes, and a large file leaves its row as a stream of
small rows. ``read`` then adds the texts of the three fields to each of those.

Steps that several expressions build on are columns of their own: Catalyst
evaluates a column once, but repeats an expression inside each branch of a CASE.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
FIELDS = ("date", "city", "temperature")
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Parser:
    """How to read the files of some formats.

    formats        the formats it reads
    open(files)    sees ``format, text, content``; adds ``<name>_units``, an array that
                   is empty for files of other formats; may add ``<name>_context``, kept
                   with each unit, and ``<name>_failure``, a message if the file as a
                   whole is unreadable
    read(units)    sees ``format, pos, unit.<name>_units`` and the context; adds
                   ``<name>_present`` (is there a record here) and ``<name>_date``,
                   ``<name>_city``, ``<name>_temperature``, NULL where absent
    trims          are date and city trimmed (the temperature always is)
    missing        start of the message about an absent field
    blank          the same about a blank one; None if blanks are fine
    """

    name: str
    formats: tuple[str, ...]
    open: Callable[[DataFrame], DataFrame]
    read: Callable[[DataFrame], DataFrame]
    trims: bool
    missing: str
    blank: str | None


def with_expressions(df: DataFrame, **expressions: str) -> DataFrame:
    """Add SQL expressions as columns, all over the columns of ``df``."""
    return df.withColumns({name: F.expr(text) for name, text in expressions.items()})


def evaluated_once(df: DataFrame, keep: Sequence[str], settle: Sequence[str]) -> DataFrame:
    """Columns ``keep`` and ``settle``, the latter safe to filter on.

    A filter sinks below the projections that compute its columns and takes a
    copy of their expressions along, so that each row would be parsed over and
    over. It does not sink below a generator: this one gives one row for one.
    """
    pairs = ", ".join(f"'{name}', {name}" for name in settle)
    return df.selectExpr(*keep, f"inline_outer(array(named_struct({pairs})))")


def read_records(name: str) -> Callable[[DataFrame], DataFrame]:
    """``read`` for a parser whose units are structs of the three texts."""

    def read(units: DataFrame) -> DataFrame:
        unit = f"unit.{name}_units"
        texts = {f"{name}_{field}": f"{unit}.{field}" for field in FIELDS}
        return with_expressions(units, **{f"{name}_present": f"{unit} IS NOT NULL"}, **texts)

    return read
