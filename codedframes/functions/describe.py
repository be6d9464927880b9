"""Columns derived from a dictionary row's UDI, type and description."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the coding sentence in a description.
CODING_ID = r"Uses data-coding (\d+)"
CODING_MEMBERS = r"Uses data-coding \d+ comprises (\d+)"
CODING_VALUE_TYPE = r"Uses data-coding \d+ comprises \d+ (\w+)-valued"
CODING_SENTENCE = " Uses data-coding"


def _extract(description: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(description, pattern, 1), F.lit(""))


def encoding_id(description: Column) -> Column:
    """Coding id, kept as a string."""
    return _extract(description, CODING_ID)


def encoding_num_members(description: Column) -> Column:
    return _extract(description, CODING_MEMBERS).try_cast("bigint")


def encoding_type(description: Column) -> Column:
    return _extract(description, CODING_VALUE_TYPE)


def is_hierarchical(description: Column) -> Column:
    return F.coalesce(description.contains("hierarchical"), F.lit(False))


def is_categorical(kind: Column) -> Column:
    return F.coalesce(kind.startswith("Categorical"), F.lit(False))


def field_id(udi: Column) -> Column:
    return F.split_part(udi, F.lit("-"), F.lit(1))


def readable_name(description: Column) -> Column:
    return F.split_part(description, F.lit(CODING_SENTENCE), F.lit(1))
