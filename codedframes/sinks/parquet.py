"""Guarded Parquet output with a provenance record beside it."""

from __future__ import annotations

import datetime
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings other Parquet writers know and Spark's does not need.
IGNORED_SETTINGS = ("engine", "write_metadata_file", "write_index", "overwrite")


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(jvm_path)


def is_non_empty(spark: SparkSession, path: str) -> bool:
    system, where = _path(spark, path)
    return system.exists(where) and len(system.listStatus(where)) > 0


def check_output(spark: SparkSession, path: str, force: bool = False, inputs: tuple[str, ...] = ()) -> None:
    """Refuse a non-empty folder without `force`, and one that holds an input."""
    if not force and is_non_empty(spark, path):
        raise OSError(f"Folder {path} is not empty; use force to replace what is in it")
    target = _path(spark, path)[1].toString().rstrip("/") + "/"
    for source in inputs:
        if (_path(spark, source)[1].toString().rstrip("/") + "/").startswith(target):
            raise OSError(f"Folder {path} holds the input {source}")


def repartition(frame: DataFrame, partitions: int | None) -> DataFrame:
    """Deal a frame's rows out evenly to a number of partitions; None or 0 keeps them as they are."""
    return frame.repartition(partitions) if partitions else frame


def check_outputs_apart(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Refuse output folders that are equal or lie in one another: one write would replace another's result."""
    full = sorted((_path(spark, path)[1].toString().rstrip("/") + "/", name) for name, path in paths.items())
    for (outer, a), (inner, b) in zip(full, full[1:]):
        if inner.startswith(outer):
            raise ValueError(f"Outputs {a} and {b} share a folder: {inner.rstrip('/')} lies in {outer.rstrip('/')}")


def write_parquet(
    frame: DataFrame,
    path: str,
    settings: Mapping | None = None,
    force: bool = False,
    inputs: tuple[str, ...] = (),
) -> None:
    """Write a frame; `settings` are Parquet writer options such as `compression`."""
    check_output(frame.sparkSession, path, force, inputs)
    options = {k: v for k, v in (settings or {}).items() if k not in IGNORED_SETTINGS}
    if str(options.get("compression", "")).lower() == "none":
        options["compression"] = "uncompressed"
    # "overwrite" also accepts a folder that exists and is empty.
    frame.write.mode("overwrite").options(**options).parquet(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """`file, rows` of every file of a written folder, those without rows included."""
    counted = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(F.col("path").alias("file"))
    bare = F.regexp_replace("file", "^file:/+", "file:///")
    return files.withColumn("file", bare).join(counted.withColumn("file", bare), "file", "left").withColumn(
        "rows", F.coalesce("rows", F.lit(0)))


def write_manifest(
    spark: SparkSession, path: str, config: Mapping, description: str | None = None, to: str | None = None
) -> str:
    """Record how a folder was made, as JSON lines beside it: settings, time, rows per file."""
    where = to or path.rstrip("/") + ".provenance"
    now = datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")
    record = manifest(spark, path).select(
        F.lit(now).alias("created"),
        F.lit(description).cast("string").alias("description"),
        F.lit(json.dumps(config, default=str, sort_keys=True)).alias("config"),
        "file",
        "rows",
    )
    record.coalesce(1).write.mode("overwrite").json(where)
    return where
