"""Decoding: coded values to their meanings."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import quote_name, quote_text
from .casts import code_value, dated_value
from .joins import BROADCAST_BYTES, Ask, lookup_columns
from .order import numbered
from .types import usable_codes

LITERAL_CODES = 64


def _comparable(value: Column, kind: str) -> Column:
    """Codes are compared by value: "1", "1.0" and 1 are the same number."""
    if kind == "string":
        return value.cast("string")
    number = value.try_cast("double")
    if kind == "double":
        return number
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(value.try_cast("bigint"), whole)


def _text_key(value: Column, kind: str) -> Column:
    """The value as text, in one spelling for equal values (0.0 and -0.0 are equal)."""
    return (value + F.lit(0.0) if kind == "double" else value).cast("string")


def _compared_as(kind: str) -> str:
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return "bigint"
    return "double" if kind in ("float", "double") else "string"


def coding_lookup(encodings: DataFrame, encoding_id: str, kind: str, how: dict | None = None) -> DataFrame:
    """`code, meaning` of one coding with unique codes; the first row counts.

    `how` is a typed column's metadata: it says whether the column holds
    positions in the list of usable codes, and in which format dates are coded.
    """
    how = how or {}
    rows = encodings.where(F.col("encoding_id") == str(encoding_id))
    if how.get("stored") == "position":
        # One place per different value, in table order.
        value = F.expr(code_value(how["compared"]))
        listed = usable_codes(rows).select(value.alias("value"), "pos", "meaning").where("value IS NOT NULL")
        listed = listed.groupBy("value").agg(F.min("pos").alias("pos"), F.min_by("meaning", "pos").alias("meaning"))
        return numbered(listed, [], ["pos"]).select(F.col("place").alias("code"), "meaning")
    key = F.expr(code_value(kind))
    if how.get("format"):
        key = F.expr(f"CAST({dated_value('code', how['format'])} AS {how['dtype']})").cast("string")
    return (
        rows.select(key.alias("code"), "pos", "meaning")
        .where(F.col("code").isNotNull())
        .groupBy("code")
        .agg(F.min_by("meaning", "pos").alias("meaning"))
    )


def decode_columns(
    frame: DataFrame,
    columns: Mapping[str, str],
    encodings: DataFrame,
    suffix: str = "_meaning",
    literal_codes: int = LITERAL_CODES,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add `<column><suffix>` for every `column: encoding_id` of `columns`.

    An unknown code has no meaning. Columns of a typed load say in their
    metadata how their codes are stored: as positions, or as dates of a format.
    Each coding is read once for all columns that store it alike. Codings with
    few codes become map literals inside one projection, so decoding many
    columns adds no joins; longer ones are joined, all in one go (`lookup_columns`).
    """
    wanted: dict[tuple, dict] = {}
    asks: dict[str, tuple] = {}
    for name, i in columns.items():
        field = frame.schema[name]
        kind = _compared_as(field.dataType.simpleString())
        said = field.metadata or {}
        how = {k: said[k] for k in ("stored", "compared", "format") if said.get(k)}
        if how.get("format"):
            how["dtype"] = field.dataType.simpleString()
        asks[name] = (str(i), kind, *sorted(how.items()))
        wanted[asks[name]] = how
    used = encodings.where(F.col("encoding_id").isin(sorted({ask[0] for ask in wanted})))
    sizes = {r["encoding_id"]: r["count"] for r in used.groupBy("encoding_id").count().collect()}
    lookups = {ask: coding_lookup(encodings, ask[0], ask[1], how) for ask, how in wanted.items()}
    few = [ask for ask in wanted if sizes.get(ask[0], 0) <= literal_codes]
    maps: dict[tuple, dict] = {ask: {} for ask in few}
    if few:
        tagged = [lookups[ask].select(F.lit(n).alias("n"), F.col("code").cast("string").alias("code"), "meaning") for n, ask in enumerate(few)]
        for r in reduce(DataFrame.unionByName, tagged).collect():
            maps[few[r["n"]]][r["code"]] = r["meaning"]
    literals = [
        f"{_literal_meaning(name, maps[ask], ask[1])} AS {quote_name(name + suffix)}" for name, ask in asks.items() if ask in maps
    ]
    out = frame.selectExpr("*", *literals) if literals else frame
    joined = [Ask(name + suffix, _text_key(_comparable(F.col(quote_name(name)), ask[1]), ask[1]), ask) for name, ask in asks.items() if ask not in maps]
    values = {ask: lookups[ask].select(_text_key(F.col("code"), ask[1]).alias("code"), F.col("meaning").alias("value")) for ask in wanted if ask not in maps}
    out = lookup_columns(out, joined, values, max_broadcast_bytes)
    names = [quote_name(n) for n in [*frame.columns, *[c + suffix for c in columns]]]
    return out.selectExpr(*names)


def _literal_meaning(name: str, meanings: dict, kind: str) -> str:
    if not meanings:
        return "CAST(NULL AS STRING)"
    pairs = ", ".join(
        f"CAST({quote_text(code)} AS {kind}), {'CAST(NULL AS STRING)' if meaning is None else quote_text(meaning)}"
        for code, meaning in sorted(meanings.items())
    )
    return f"try_element_at(map({pairs}), CAST({quote_name(name)} AS {kind}))"
