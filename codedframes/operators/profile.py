"""Column report of a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import quote_name, quote_text

#: Frames of more columns are counted cell by cell: thousands of aggregates in one method are more than the JVM compiles.
WIDE, SLICE = 100, 256


def profile_columns(frame: DataFrame) -> DataFrame:
    """`name, dtype, non_null` for every column, from one pass over the rows.

    A wide frame's rows are turned into the numbers of the columns that they fill, which are counted where they are read;
    only a count for each column and task is shuffled.
    """
    entries = list(enumerate(frame.dtypes))
    if len(entries) <= WIDE:
        counts = [f"count({quote_name(name)}) AS c{i}" for i, (name, _) in entries]
        rows = ", ".join(f"{quote_text(name)}, {quote_text(kind)}, c{i}" for i, (name, kind) in entries)
        return frame.selectExpr(*counts).selectExpr(f"stack({len(counts)}, {rows}) AS (name, dtype, non_null)")
    slices = [
        "array_compact(array(" + ", ".join(f"IF({quote_name(name)} IS NULL, NULL, {i})" for i, (name, _) in entries[at:at + SLICE]) + "))"
        for at in range(0, len(entries), SLICE)
    ]
    # The outer form keeps Spark from testing the array's size first, which would work it out twice.
    filled = frame.selectExpr(f"flatten(array({', '.join(slices)})) AS filled").select(F.explode_outer("filled").alias("at"))
    counted = filled.groupBy("at").agg(F.count("*").alias("non_null"))
    names = frame.sparkSession.createDataFrame([(i, name, kind) for i, (name, kind) in entries], "at int, name string, dtype string")
    return names.join(counted, "at", "left").select("name", "dtype", F.coalesce("non_null", F.lit(0)).alias("non_null"))
