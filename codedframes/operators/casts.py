"""Casts of raw extract cells, as SQL expressions over a text column.

Missing-value tokens become NULL. A cell that does not fit its column's type
fails the job and names the column, whatever the session's ANSI setting.
Categorical columns are closed lists: a value outside the list becomes missing.

Each expression reads the raw cell directly. Stacking the steps as projections
costs about twice the time on wide rows, because every layer copies the row.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from ..functions.fixed import NA_TOKENS
from ..functions.text import cp1252_from_latin1, has_clock, missing_to_null, quote_text, spark_pattern, text_list

SHORT_LIST = 64
#: Positions in so short a list are searched one by one.
SHORT_INDEX = 8


@dataclass(frozen=True)
class NameAt:
    """Stands for a column's name in a lambda over the cells of several columns: the name at place `i`."""

    names: tuple[str, ...]


def _label(name: str | NameAt) -> str:
    return f"array({text_list(name.names)})[i]" if isinstance(name, NameAt) else quote_text(name)


def _rarely(cell: str, expression: str) -> str:
    """An expression over `x` for the few cells that plain attempts do not settle.

    A lambda is not compiled into the projection. That keeps the generated
    methods short enough for the JVM to optimise, which matters far more for
    wide rows than the speed of the rare case.
    """
    return f"transform(array({cell}), x -> {expression})[0]"


def _unless_token(expression: str) -> str:
    """The expression over `x`, NULL when `x` is a missing-value token."""
    return f"IF(find_in_set(x, {quote_text(','.join(NA_TOKENS))}) > 0, NULL, {expression})"


def _refused(name: str | NameAt, kind: str) -> str:
    return f"raise_error(concat('Column ', {_label(name)}, {quote_text(f': not a {kind}: ')}, x))"


# Java also reads "1d" and "1f" as numbers, and "NAN" as one. With "e0" after
# it, plain notation keeps its value and those words do not parse; nor does a
# missing-value token. The second attempt is for exponents, infinities, blanks.
_PLAIN_NUMBER = "try_cast(concat({0}, 'e0') AS DOUBLE)"
_OTHER_NUMBER = (
    "IF(right(x, 1) IN ('d', 'D', 'f', 'F', 'n', 'N') AND NOT lower(trim(x)) LIKE '%inf' OR x RLIKE '[xXpP]', NULL, try_cast(x AS DOUBLE))"
)
# Text such as "3.0" is a whole number too.
_PLAIN_WHOLE = "try_cast({0} AS BIGINT)"
_OTHER_WHOLE = (
    "IF(right(x, 1) <= '9' AND NOT x RLIKE '[xXpP]' AND try_cast(x AS DOUBLE) = floor(try_cast(x AS DOUBLE)), "
    "try_cast(try_cast(x AS DOUBLE) AS BIGINT), NULL)"
)


def _strict(name: str | NameAt, cell: str, plain: str, other: str | None, kind: str) -> str:
    """A plain attempt; then tokens, another attempt, or failure."""
    refused = _refused(name, kind)
    settled = _rarely(cell, _unless_token(f"coalesce({other}, {refused})" if other else refused))
    return f"CASE WHEN {cell} IS NOT NULL THEN coalesce({plain}, {settled}) END"


def to_int(name: str | NameAt, cell: str) -> str:
    """Whole number; a missing value is an error."""
    message = f"concat('Column ', {_label(name)}, ': missing value in an integer column')"
    return f"coalesce({to_long(name, cell)}, raise_error({message}))"


def to_long(name: str | NameAt, cell: str) -> str:
    """Whole number or missing."""
    return _strict(name, cell, _PLAIN_WHOLE.format(cell), _OTHER_WHOLE, "whole number")


def to_double(name: str | NameAt, cell: str) -> str:
    return _strict(name, cell, _PLAIN_NUMBER.format(cell), _OTHER_NUMBER, "number")


def to_day(name: str | NameAt, cell: str, fmt: str) -> str:
    plain = f"try_to_date({cell}, {quote_text(spark_pattern(fmt))})"
    return _strict(name, cell, plain, None, f"date of format {fmt}")


def to_timestamp(name: str | NameAt, cell: str, fmt: str) -> str:
    if not has_clock(fmt):
        return f"CAST({to_day(name, cell, fmt)} AS TIMESTAMP_NTZ)"
    # Only the parser with a time zone is lenient: it says whether the cell fits, at a fixed offset, so that the
    # session's zone and its gaps play no part; the value comes from the parser without one.
    fits = f"try_to_timestamp(concat({cell}, ' +0000'), {quote_text(spark_pattern(fmt) + ' xx')}) IS NOT NULL"
    plain = f"IF({fits}, to_timestamp_ntz({cell}, {quote_text(spark_pattern(fmt))}), NULL)"
    return _strict(name, cell, plain, None, f"date of format {fmt}")


def to_text(cell: str, latin1: bool = False) -> str:
    """Text, with windows-1252 characters put right when it was read as ISO-8859-1."""
    return missing_to_null(cell, cp1252_from_latin1(cell) if latin1 else cell)


def cast_cell(name: str | NameAt, cell: str, target: str, spark_type: str, fmt: str | None, latin1: bool = False) -> str:
    """Strict cast of a raw cell to the target of its column."""
    if target == "date":
        return to_timestamp(name, cell, fmt)
    if target == "day":
        return to_day(name, cell, fmt)
    if target in ("int", "int64"):
        return to_int(name, cell)
    if spark_type == "string":
        return to_text(cell, latin1)
    return {"bigint": to_long, "double": to_double}[spark_type](name, cell)


def category_value(cell: str, spark_type: str, latin1: bool = False) -> str:
    """Value of a categorical cell before its list is applied.

    What is not a number becomes missing, and so do the tokens: none of them
    is a number that a list can hold.
    """
    if spark_type == "string":
        return to_text(cell, latin1)
    plain, other = (_PLAIN_NUMBER, _OTHER_NUMBER) if spark_type == "double" else (_PLAIN_WHOLE, _OTHER_WHOLE)
    return f"CASE WHEN {cell} IS NOT NULL THEN coalesce({plain.format(cell)}, {_rarely(cell, other)}) END"


def whole_category(cell: str) -> str:
    """The whole number that a cell is in plain notation, else NULL; `category_value` of a number kind gives the same number.

    Spark's whole numbers may have a DEL character around them, its other numbers not.
    """
    return f"IF(contains({cell}, chr(127)), NULL, {_PLAIN_WHOLE.format(cell)})"


#: What counts as a number in a coding table, in Python and in Spark alike.
CODE_NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def code_literal(code: str | None, spark_type: str) -> str | None:
    """A code as a SQL literal of the value type, None if it is no such value: "1.0" is the whole number 1."""
    if code is None or spark_type == "string":
        return None if code is None else quote_text(code)
    if not re.fullmatch(CODE_NUMBER, code.strip(" ")):
        return None
    if spark_type == "double":
        number = float(code) + 0.0
        return f"{number!r}D" if math.isfinite(number) else None
    number = Decimal(code.strip(" "))
    whole = number == number.to_integral_value() and -(2**63) <= number < 2**63
    return f"CAST('{int(number)}' AS BIGINT)" if whole else None


def code_value(spark_type: str, code: str = "code") -> str:
    """`code_literal` for a column of codes, as a SQL expression."""
    if spark_type == "string":
        return code
    read = f"try_cast(trim({code}) AS {'DOUBLE' if spark_type == 'double' else 'DECIMAL(38, 18)'})"
    if spark_type == "double":
        value = f"IF(abs({read}) < double('Infinity'), {read} + 0D, NULL)"
    else:
        value = f"coalesce(try_cast(trim({code}) AS BIGINT), IF({read} = floor({read}), try_cast({read} AS BIGINT), NULL))"
    return f"CASE WHEN trim({code}) RLIKE {quote_text('^' + CODE_NUMBER + '$')} THEN {value} END"


def dated_value(code: str, fmt: str) -> str:
    """A code as a date or time of a format, NULL when it is none."""
    pattern = spark_pattern(fmt)
    if not has_clock(fmt):
        return f"try_to_date({code}, {quote_text(pattern)})"
    fits = f"try_to_timestamp(concat({code}, ' +0000'), {quote_text(pattern + ' xx')}) IS NOT NULL"
    return f"IF({fits}, to_timestamp_ntz({code}, {quote_text(pattern)}), NULL)"


def category_literals(codes, spark_type: str, name: str) -> list[str]:
    """A list of codes as SQL literals of the value type, without repeats."""
    literals = {}
    for code in codes:
        literal = code_literal(code, spark_type)
        if literal is None:
            raise ValueError(f"Column {name}: code {code} does not fit its coding")
        literals[literal] = None
    return list(literals)


def close_domain(value: str, literals: list[str], spark_type: str) -> str:
    """Keep listed values only.

    A short list is a map from each value to itself, so that the value is
    worked out once; a longer one is looked up by hash.
    """
    if not literals:
        return f"CAST(NULL AS {spark_type})"
    if len(literals) <= SHORT_LIST:
        return f"try_element_at(map({', '.join(f'{x}, {x}' for x in literals)}), {value})"
    return f"transform(array({value}), y -> {hashed(literals, spark_type, 'y')})[0]"


def category_index(value: str, literals: list[str], index_type: str, spark_type: str = "string") -> str:
    """Zero-based position of a value in its list, NULL outside it; a long list is looked up by hash."""
    if not literals:
        return f"CAST(NULL AS {index_type})"
    if len(literals) <= SHORT_INDEX:
        return f"CAST(nullif(array_position(array({', '.join(literals)}), {value}), 0) - 1 AS {index_type})"
    return f"CAST(transform(array({value}), y -> {hashed(literals, spark_type, 'y', range(len(literals)))})[0] AS {index_type})"


def hashed(literals: Sequence[str], spark_type: str, y: str, results: Sequence | None = None) -> str:
    """What belongs to the value `y` (a name): its result, or by default the value itself; NULL when it isn't listed.

    The list is a constant array of small maps. A value's map is at a place computed from the value, so a lookup takes
    as long for a thousand values as for one. Spark folds the array into one constant.
    """
    where = {"string": f"crc32({y})", "double": f"coalesce(try_cast({y} AS BIGINT), 0L)", "bigint": y}[spark_type]
    keys = [_number(literal, spark_type) for literal in literals]
    size = min(range(2 * len(keys) + 1, 2 * len(keys) + 33, 2), key=lambda n: _fullest(keys, n))
    maps: list[list[str]] = [[] for _ in range(size)]
    for key, literal, result in zip(keys, literals, literals if results is None else results, strict=True):
        maps[key % size].append(f"{literal}, {result}")
    table = ", ".join(f"map({', '.join(pairs)})" if pairs else "NULL" for pairs in maps)
    return f"try_element_at(array({table})[pmod({where}, {size}L)], {y})"


def _number(literal: str, spark_type: str) -> int:
    """The number that a literal's place is computed from."""
    if spark_type == "string":
        return zlib.crc32(re.sub(r"\\(.)", r"\1", literal[1:-1], flags=re.DOTALL).encode())
    if spark_type == "double":
        whole = int(float(literal.removesuffix("D")))
        return whole if -(2**63) <= whole < 2**63 else 0
    return int(re.search(r"[+-]?[0-9]+", literal)[0])


def _fullest(keys: Sequence[int], size: int) -> int:
    places: dict[int, int] = {}
    for key in keys:
        places[key % size] = places.get(key % size, 0) + 1
    return max(places.values(), default=0)
