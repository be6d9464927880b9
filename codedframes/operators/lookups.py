"""Dictionary and coding lookups for a frame of keys.

Each lookup takes a frame of keys instead of one key and answers all of them in
one plan. A frame that carries `dict_id` is matched within that dictionary.
Equal keys are asked for once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import describe as D


def _scope(*frames: DataFrame) -> list[str]:
    return ["dict_id"] if all("dict_id" in f.columns for f in frames) else []


def _distinct_keys(keys: DataFrame, key: str) -> DataFrame:
    return keys.select(*_scope(keys), F.col(key).cast("string").alias("key")).distinct()


def valid_encoding_ids(keys: DataFrame, dictionary: DataFrame, key: str = "encoding_id") -> DataFrame:
    """Keys that are coding ids of the dictionary."""
    return _membership(keys, dictionary, key, "left_semi")


def invalid_encoding_ids(keys: DataFrame, dictionary: DataFrame, key: str = "encoding_id") -> DataFrame:
    """Keys that are not coding ids of the dictionary."""
    return _membership(keys, dictionary, key, "left_anti")


def _membership(keys: DataFrame, dictionary: DataFrame, key: str, how: str) -> DataFrame:
    known = dictionary.where("Has_encoding").select(
        *_scope(dictionary, keys), F.col("Encoding_id").alias("key")
    ).distinct()
    return _distinct_keys(keys, key).join(known, [*_scope(dictionary, keys), "key"], how)


def encoding_tables(keys: DataFrame, encodings: DataFrame, key: str = "encoding_id") -> DataFrame:
    """Coding table rows of the given coding ids: `key, pos, code, meaning, …`."""
    scope = _scope(keys, encodings)
    tables = encodings.withColumnRenamed("encoding_id", "key")
    return _distinct_keys(keys, key).join(tables, [*scope, "key"])


def encoding_ids_by_udi(keys: DataFrame, dictionary: DataFrame, key: str = "udi") -> DataFrame:
    """`key, encoding_id` for column ids the dictionary knows."""
    by_udi = dictionary.select(
        *_scope(dictionary, keys), F.col("UDI").alias("key"), F.col("Encoding_id").alias("encoding_id")
    )
    return _distinct_keys(keys, key).join(by_udi, [*_scope(dictionary, keys), "key"])


def encoding_ids_by_field(keys: DataFrame, dictionary: DataFrame, key: str = "field_id") -> DataFrame:
    """`key, encoding_id` for field ids; the field's first column decides."""
    scope = _scope(dictionary, keys)
    by_field = (
        dictionary.groupBy(*scope, D.field_id(F.col("UDI")).alias("key"))
        .agg(F.min_by(F.struct("Encoding_id"), "Column").alias("first"))
        .select(*scope, "key", F.col("first.Encoding_id").alias("encoding_id"))
    )
    return _distinct_keys(keys, key).join(by_field, [*scope, "key"])


def encodings_by_udi(keys: DataFrame, dictionary: DataFrame, encodings: DataFrame, key: str = "udi") -> DataFrame:
    """Coding tables of column ids: `key, encoding_id, pos, code, meaning, …`."""
    return _with_tables(encoding_ids_by_udi(keys, dictionary, key), encodings)


def encodings_by_field(
    keys: DataFrame, dictionary: DataFrame, encodings: DataFrame, key: str = "field_id"
) -> DataFrame:
    """Coding tables of field ids: `key, encoding_id, pos, code, meaning, …`."""
    return _with_tables(encoding_ids_by_field(keys, dictionary, key), encodings)


def _with_tables(ids: DataFrame, encodings: DataFrame) -> DataFrame:
    return ids.where(F.col("encoding_id").isNotNull()).join(encodings, [*_scope(ids, encodings), "encoding_id"])


def missing_keys(keys: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """Keys without an answer."""
    scope = _scope(keys, answers)
    return _distinct_keys(keys, key).join(answers.select(*scope, "key").distinct(), [*scope, "key"], "left_anti")


def names_by_udi(keys: DataFrame, dictionary: DataFrame, key: str = "udi") -> DataFrame:
    """`key, name` for column ids."""
    scope = _scope(dictionary, keys)
    by_udi = dictionary.select(*scope, F.col("UDI").alias("key"), D.readable_name(F.col("Description")).alias("name"))
    return _distinct_keys(keys, key).join(by_udi, [*scope, "key"])


def names_by_field(keys: DataFrame, dictionary: DataFrame, key: str = "field_id") -> DataFrame:
    """`key, name, ambiguous` for field ids.

    A field whose columns differ in their full description is ambiguous and
    gets no name. Comparing the smallest and largest description finds that
    out in one aggregation.
    """
    scope = _scope(dictionary, keys)
    text = F.col("Description")
    low, high = F.min(text), F.max(text)
    differs: Column = (low != high) | (F.count(text).between(F.lit(1), F.count("*") - 1))
    by_field = (
        dictionary.groupBy(*scope, D.field_id(F.col("UDI")).alias("key"))
        .agg(low.alias("text"), F.coalesce(differs, F.lit(False)).alias("ambiguous"))
        .select(*scope, "key", F.when(~F.col("ambiguous"), D.readable_name(F.col("text"))).alias("name"), "ambiguous")
    )
    return _distinct_keys(keys, key).join(by_field, [*scope, "key"])
