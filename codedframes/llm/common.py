"""Helpers that the operators share: tables in the shared folder, words, and numpy pieces."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are maximal runs of characters other than blank, tab, line feed, vertical tab, form feed and carriage return.
#: bytes.split() splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a session that names none (a local test) gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="codedframes-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: With this setting, the shuffles of a write are deleted when it ends, not when the driver happens to collect garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(frame: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read again: its lineage ends there, and it outlives executors."""
    path = f"{shared_folder(frame.sparkSession)}/llm-{uuid.uuid4().hex}"
    conf = frame.sparkSession.conf
    before = conf.get(CLEANED, "false")
    conf.set(CLEANED, "true")
    try:
        frame.write.parquet(path)
    finally:
        conf.set(CLEANED, before)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def drop_saved(frame: DataFrame) -> None:
    """Delete the files of a frame from `saved` that nothing reads any more."""
    spark = frame.sparkSession
    for file in {os.path.dirname(name) for name in frame.inputFiles()}:
        if os.path.basename(file).startswith("llm-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ranked(frame: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`frame` with `rank`, from 0, of each row within its group in the given order; equal rows get any order.

    No group has to fit a task: rows are dealt by ranges of (group, order) and kept, numbered within each range, and
    each range adds the counts of those before it. The counts have one row per range and group, not per row.
    """
    dealt = saved(frame.repartitionByRange(group, *order).withColumn("range_no", F.spark_partition_id()))
    before = Window.partitionBy(group).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(group, "range_no").count().select(
        group, "range_no", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    in_range = F.row_number().over(Window.partitionBy(group, "range_no").orderBy(*order)) - 1
    numbered = dealt.withColumn("rank", in_range).join(starts, [group, "range_no"])
    return numbered.withColumn("rank", F.col("rank") + F.col("before")).drop("before", "range_no")


def local_components(n: int, left: np.ndarray, right: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """The smallest member of each node's component among nodes 0..n-1; `root` carries on an earlier result."""
    root = np.arange(n) if root is None else root
    while len(left):
        a, b = root[left], root[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low != high
        np.minimum.at(root, high[open_], low[open_])
        while not np.array_equal(nxt := root[root], root):
            root = nxt
        left, right = left[open_], right[open_]
    return root


def byte_windows(text: bytes, size: int) -> Iterator[bytes]:
    """Pieces of a text of about `size` bytes, cut at ASCII blanks; a run without blanks is never cut."""
    at = 0
    while len(text) - at > size:
        gap = _BLANK.search(text, at + size)
        if gap is None:
            break
        yield text[at:gap.start()]
        at = gap.end()
    yield text[at:] if at else text


_BLANK = re.compile(rb"[\x20\x09-\x0D]")
