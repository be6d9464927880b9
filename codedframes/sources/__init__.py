"""Readers: data dictionaries, coding tables and extracts."""
