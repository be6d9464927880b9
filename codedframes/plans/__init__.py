"""Whole conversions: extract and dictionary in, typed Parquet out."""
