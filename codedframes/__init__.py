"""Coded cohort extracts on Spark: dictionaries, codings, typed loads, Parquet."""

from .library import CodedDictionary
from .operators.decode import decode_columns
from .plans.convert import convert, load_dictionary, typed_extract
from .plans.spec import ConversionSpec

__all__ = ["CodedDictionary", "ConversionSpec", "convert", "decode_columns", "load_dictionary", "typed_extract"]
