"""Text rules as Column functions; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
# What a trim removes: every character up to and including the space.
TRIMMED = "".join(chr(code) for code in range(33))
# A character that is not white space. Regex class of the JVM.
NON_BLANK = r"\P{javaWhitespace}"
LEADING_BLANK = r"^\p{javaWhitespace}*"
LINE_BREAK = "\r\n|\r|\n"
DELETE = "\\u007f"
# --------------------------------------------------------------------------


def utf8(content: Column) -> Column:
    """Bytes as text; bytes that are not UTF-8 turn into U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def blank(text: Column) -> Column:
    """True if the text has no character other than white space."""
    return ~text.rlike(NON_BLANK)


def delimiter_pattern(delimiter: str) -> str:
    """The delimiter as a pattern that matches just it.

    One plain character stays as it is: the JVM splits on it without a regex.
    """
    plain = len(delimiter) == 1 and delimiter not in r".$|()[{^?*+\\"
    return delimiter if plain else rf"\Q{delimiter}\E"


def sql_text(value: str) -> str:
    """A SQL string literal."""
    plain = {"\\": "\\\\", "'": "\\'"}
    shown = [plain.get(c) or (c if c.isprintable() else f"\\u{ord(c):04x}") for c in value]
    return "'" + "".join(shown) + "'"


def sql_list(values) -> str:
    return "(" + ", ".join(sql_text(value) for value in values) + ")"


def sql_visible(value: str) -> str:
    """SQL: the text has a character other than white space.

    Nearly all texts start with a visible ASCII character; only the others pay
    for the pattern.
    """
    return f"(ascii({value}) BETWEEN 33 AND 126 OR {value} RLIKE {sql_text(NON_BLANK)})"


def sql_trimmed(value: str) -> str:
    """SQL for the trimmed text; the search for what to trim is skipped if both ends are clean."""
    clean = f"ascii({value}) > 32 AND ascii(substring({value}, -1)) > 32"
    return f"CASE WHEN {clean} THEN {value} ELSE btrim({value}, {sql_text(TRIMMED)}) END"


def sql_int(value: str) -> str:
    """SQL for a trimmed text as a 32-bit integer with an optional sign, else NULL.

    The cast takes digits and a sign only, but ignores a DEL at the ends.
    """
    padded = f"startswith({value}, '{DELETE}') OR endswith({value}, '{DELETE}')"
    return f"CASE WHEN NOT ({padded}) THEN TRY_CAST({value} AS INT) END"


def one_line(text: Column) -> Column:
    """Text safe to put on one log line."""
    shown = F.replace(F.replace(text, F.lit("\r"), F.lit("\\r")), F.lit("\n"), F.lit("\\n"))
    return F.coalesce(shown, F.lit("null"))


def form_decoded(text: Column) -> Column:
    """``+`` is a space and ``%XX`` a byte; NULL if an escape is malformed."""
    return F.try_url_decode(text)
