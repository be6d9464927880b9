"""Checks of an extract's header against its dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import lookup_join


def header_matches(header: DataFrame, dictionary: DataFrame) -> DataFrame:
    """`pos, udi, matches`: dictionary rows per header name."""
    scope = [c for c in ("dict_id",) if c in header.columns and c in dictionary.columns]
    counts = dictionary.groupBy(*scope, F.col("UDI").alias("udi")).agg(F.count("*").alias("matches"))
    joined = header.join(counts, [*scope, "udi"], "left") if scope else lookup_join(header, counts, "udi")
    return joined.select(
        *scope, "pos", "udi", F.coalesce("matches", F.lit(0)).cast("bigint").alias("matches")
    )


def header_problems(header: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Header names without exactly one dictionary row."""
    return header_matches(header, dictionary).where("matches <> 1")


def header_rows(header: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The dictionary row of every header name that has exactly one."""
    from .types import first_rows

    scope = [c for c in ("dict_id",) if c in header.columns and c in dictionary.columns]
    rows = first_rows(dictionary).where("matches = 1").drop("matches")
    if scope:
        return header.join(rows, [*scope, "udi"])
    return lookup_join(header, rows.withColumn("__found", F.lit(True)), "udi").where("__found").drop("__found")


def check_header(header: DataFrame, dictionary: DataFrame) -> None:
    """Raise when a header name has no dictionary row, or several."""
    bad = header_problems(header, dictionary).orderBy("pos").limit(20).collect()
    if bad:
        shown = "; ".join(
            f"column {r['pos']} {r['udi']!r} "
            + ("is not in the dictionary" if r["matches"] == 0 else f"has {r['matches']} dictionary rows")
            for r in bad
        )
        raise ValueError(f"The extract does not match the dictionary: {shown}")
