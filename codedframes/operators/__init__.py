"""Lookups, validation, type resolution, casts, decoding and profiling."""
