"""SQL text helpers: quoting, missing-value tokens, charsets, date patterns.

An extract can have tens of thousands of columns, and building one `Column`
object per cell expression costs several JVM round trips each. The casts are
therefore written as SQL text and handed to a single `selectExpr`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import CP1252_BYTES, CP1252_TEXT, NA_TOKENS, STRPTIME_TO_SPARK


def quote_name(name: str) -> str:
    """Back-quoted column name; UDIs hold dots and dashes."""
    return "`" + name.replace("`", "``") + "`"


def quote_text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_list(values) -> str:
    return ", ".join(quote_text(v) for v in values)


def present(cell: str) -> str:
    """Condition: the cell is not missing."""
    return f"NOT {cell} IN ({text_list(NA_TOKENS)})"


def missing_to_null(cell: str, value: str | None = None) -> str:
    """The cell (or a value made from it), NULL when it is a missing-value token."""
    return f"CASE WHEN {present(cell)} THEN {value or cell} END"


def cp1252_from_latin1(expression: str) -> str:
    """Text read as ISO-8859-1, corrected to windows-1252.

    The two charsets differ only in 0x80-0x9F, and Spark's CSV reader accepts
    ISO-8859-1 without a legacy setting.
    """
    return f"translate({expression}, {quote_text(CP1252_BYTES)}, {quote_text(CP1252_TEXT)})"


def latin1_from_cp1252(text: Column) -> Column:
    """The inverse, for writing windows-1252 bytes through ISO-8859-1."""
    return F.translate(text, CP1252_TEXT, CP1252_BYTES)


def spark_pattern(strptime_format: str) -> str:
    """Translate a strptime format into a Spark datetime pattern.

    strptime takes one or two digits for days, months and clock fields, so the
    free-width pattern letter is used unless two fields touch.
    """
    pieces = re.findall(r"%.|[^%]+", strptime_format)
    out = []
    for i, piece in enumerate(pieces):
        if not piece.startswith("%"):
            out.append(re.sub(r"[A-Za-z']+", lambda m: "'" + m[0].replace("'", "''") + "'", piece))
        elif piece == "%%":
            out.append("%")
        elif piece in STRPTIME_TO_SPARK:
            fixed, free = STRPTIME_TO_SPARK[piece]
            touches = any(p.startswith("%") for p in pieces[max(i - 1, 0) : i] + pieces[i + 1 : i + 2])
            out.append(fixed if touches else free)
        else:
            raise ValueError(f"Date format {strptime_format!r}: directive {piece!r} is not supported")
    return "".join(out)


def has_clock(strptime_format: str) -> bool:
    """Whether a strptime format holds a time of day."""
    return any(d in strptime_format for d in ("%H", "%M", "%S", "%f"))
