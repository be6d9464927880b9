"""File order of an extract: row index and first rows.

Text files carry no row numbers. One counting pass gives the rows of every
file block; from the blocks' running totals each row's index follows without
moving a row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .joins import BROADCAST_BYTES, new_path, stored

_AT = "__at"
_FILE = "__file"
_BLOCK = "__block"
_SEQUENCE = "__sequence"


def _positions() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_BLOCK),
        F.monotonically_increasing_id().alias(_SEQUENCE),
        F.xxhash64(F.spark_partition_id(), "_metadata.file_path", "_metadata.file_block_start").alias(_AT),
    ]


def block_offsets(scan: DataFrame) -> DataFrame:
    """Rows before each file block, in file order. One row per block.

    Spark numbers rows per scan partition; `__first` is the number of the
    block's first row, so a row's place in its block is the difference to it.
    `__at` names partition, file and block in eight bytes.
    """
    counted = scan.select(*_positions()).groupBy(_AT, _FILE, _BLOCK).agg(F.count("*").alias("__rows"), F.min(_SEQUENCE).alias("__first"))
    # The running total is over blocks, not rows.
    before = Window.orderBy(_FILE, _BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))


def with_row_index(scan: DataFrame, name: str = "index", first_rows: int = 0) -> DataFrame:
    """Add each row's zero-based index in file order; with `first_rows`, keep only these.

    `scan` is a plain read of text files. One pass counts the rows of each
    block; the counts are kept as a table, and a block takes 32 bytes of the
    broadcast: 64 MB stand for 2,000,000 blocks, 256 TB at 128 MB each. Beyond
    that, the blocks are joined by a shuffle. A scan that is split in another
    way than the counting pass was fails, as one of changed files does.
    """
    blocks = stored(block_offsets(scan))
    names = blocks.agg(F.count("*"), F.count_distinct(_AT)).first()
    if names[0] != names[1]:
        raise RuntimeError("Two file blocks have the same hash; rename a file")
    if first_rows:
        blocks = blocks.where(F.col("__before") < first_rows)
    blocks = blocks.select(_AT, "__first", "__before", "__rows")
    if names[0] * 32 <= BROADCAST_BYTES:
        blocks = F.broadcast(blocks)
    place = F.col(_SEQUENCE) - F.col("__first")
    changed = F.raise_error(F.lit("The extract was split in another way, or its files changed, while it was read"))
    index = F.when((place >= 0) & (place < F.col("__rows")), F.col("__before") + place).otherwise(changed.cast("bigint")).alias(name)
    indexed = scan.select("*", *_positions()).join(blocks, _AT, "inner" if first_rows else "left")
    out = indexed.select(index, *[F.col(f"`{c.replace('`', '``')}`") for c in scan.columns])
    return out.where(F.col(name) < first_rows) if first_rows else out


def numbered(frame: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "place") -> DataFrame:
    """`frame` with each row's zero-based place in its group of equal keys.

    No group has to fit a task: rows are dealt by ranges of keys and order and
    kept as a table, each range is numbered by itself, and the counts of a
    group's earlier ranges are added.
    """
    dealt = stored(frame.repartitionByRange(*keys, *order).withColumn("__range", F.spark_partition_id()))
    groups = [*keys, "__range"]
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*groups).agg(F.count("*").alias("__rows"))
    starts = starts.select(*groups, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy(*groups).orderBy(*order)) - 1
    joined = dealt.withColumn("__within", within).join(F.broadcast(starts) if not keys else starts, groups)
    return joined.select(*[F.col(f"`{c.replace('`', '``')}`") for c in frame.columns], (F.col("__before") + F.col("__within")).cast("bigint").alias(name))


def list_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Data files below a path, in path order."""
    frame = spark.read.format("text").load(path if isinstance(path, str) else list(path))
    return sorted(frame.inputFiles())


def leading_bytes(file: str, first_rows: int, scan: Callable[[Sequence[str]], DataFrame]) -> str | None:
    """A copy, in the shared folder, of the first bytes of `file`, which hold more than `first_rows` rows.

    A scan of a file opens all of its splits, so the rows are looked for in growing pieces of the first split's size at
    most, streamed by the driver. One row more than asked for means that the last of these isn't cut. None if the file has one
    split, is compressed, or the first split has too few rows.
    """
    spark = scan([file]).sparkSession
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    source = hadoop.fs.Path(file)
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    compressed = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(source) is not None
    if compressed or source.getFileSystem(conf).getFileStatus(source).getLen() <= split:
        return None
    for size in (split // 16, split // 4, split):
        copy = hadoop.fs.Path(new_path(spark))
        read, write = source.getFileSystem(conf).open(source), copy.getFileSystem(conf).create(copy)
        try:
            spark._jvm.org.apache.commons.io.IOUtils.copyLarge(read, write, 0, size)
        finally:
            read.close()
            write.close()
        if scan([copy.toString()]).count() > first_rows:
            return copy.toString()
    return None


def first_files(
    files: Sequence[str], first_rows: int, scan: Callable[[Sequence[str]], DataFrame]
) -> Sequence[str]:
    """The shortest doubling run of leading files that holds `first_rows` rows.

    Later files are never opened, so a few rows of a huge extract are cheap. If the first file has several splits and its
    first bytes hold the rows, the run is a copy of these bytes.
    """
    start = leading_bytes(files[0], first_rows, scan) if files else None
    if start:
        return [start]
    taken = 1
    while taken < len(files):
        if scan(files[:taken]).count() >= first_rows:
            return files[:taken]
        taken *= 2
    return files
