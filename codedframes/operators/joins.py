"""Joining large fact frames with lookup frames of unknown size."""

from __future__ import annotations

import uuid
from collections.abc import Hashable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import quote_name

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 1000


def measured_bytes(frame: DataFrame) -> int:
    """Size of a frame's rows, from one aggregation over it."""
    widths = [
        F.coalesce(F.octet_length(F.col(quote_name(name))), F.lit(0)) + 16 if kind == "string" else F.lit(16)
        for name, kind in frame.dtypes
    ]
    row = F.lit(16)
    for width in widths:
        row = row + width
    return frame.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0)).alias("bytes")).first()["bytes"]


def hot_keys(facts: DataFrame, key: str) -> list:
    """Keys that hold more than 1/1000 of the rows; there are fewer than 1000."""
    counts = facts.groupBy(key).count()
    total = facts.count()
    return [r[0] for r in counts.where((F.col("count") * HOT_SHARE > total) & F.col(key).isNotNull()).collect()]


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    counted: DataFrame | None = None,
    size: int | None = None,
) -> DataFrame:
    """`facts LEFT JOIN lookup USING (key)`, where the lookup has unique keys.

    A lookup that measures small is broadcast, so the facts are not shuffled.
    A larger one is shuffled against the facts. The rows of hot keys, and rows
    without a key, are read apart and never shuffled: they stay in the tasks
    that read them, and hot keys find their few lookup rows by a broadcast.
    `counted` is a cheaper frame with the same key column to find the hot keys
    in, `size` the lookup's bytes where they were measured before.
    """
    if (measured_bytes(lookup) if size is None else size) <= max_broadcast_bytes:
        return facts.join(F.broadcast(lookup), key, "left")
    hot = hot_keys(facts if counted is None else counted, key)
    apart = F.col(key).isNull() | (F.col(key).isin(hot) if hot else F.lit(False))
    # Fewer than 1,000 keys are hot and each has one lookup row.
    few = lookup.where(F.col(key).isin(hot) if hot else F.lit(False))
    kept = facts.where(apart).join(F.broadcast(few), key, "left")
    return facts.where(~apart).join(lookup, key, "left").unionByName(kept)


def new_path(spark: SparkSession) -> str:
    """A path not used before, in the shared checkpoint folder, or else below the warehouse folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/stored-{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: worked out once."""
    spark = frame.sparkSession
    path = new_path(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@dataclass(frozen=True)
class Ask:
    """A column to add: the value that lookup `of` has for each row's `key`, which is text."""

    name: str
    key: Column
    of: Hashable


def lookup_columns(
    facts: DataFrame, asks: Sequence[Ask], lookups: Mapping[Hashable, DataFrame], max_broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """`facts` with one more column per ask. Lookups have unique keys: `code string, value string`.

    All lookups are measured in one job. As many as fit the bound together are broadcast, smallest first. For the others, one
    pass over the facts gathers the codes that the asked columns use, each once with its count, and one join finds
    their values. If these used parts fit the bound, they are broadcast, and the facts are not shuffled. If not, codes that
    hold over 1/1000 of the cells (so there are fewer than 1,000) are broadcast, and only then does each such column
    take a shuffled join with the rest, in which rows that need no lookup are dealt out by what else they hold.
    Whatever the number of columns, facts are read twice at most.
    """
    if not asks:
        return facts
    numbers = {of: n for n, of in enumerate(lookups)}
    tagged = reduce(DataFrame.unionByName, [frame.select(F.lit(n).alias("of"), "code", "value") for frame, n in zip(lookups.values(), numbers.values())])
    width = F.coalesce(F.octet_length("code"), F.lit(0)) + F.coalesce(F.octet_length("value"), F.lit(0)) + 48
    sizes = {r["of"]: r["bytes"] for r in tagged.groupBy("of").agg(F.sum(width.cast("bigint")).alias("bytes")).collect()}
    small, room = set(), max_broadcast_bytes
    for n in sorted(numbers.values(), key=lambda n: sizes.get(n, 0)):
        if sizes.get(n, 0) <= room:
            small.add(n)
            room -= sizes.get(n, 0)
    far = [a for a in asks if numbers[a.of] not in small]
    near, rest = tagged.where(F.col("of").isin(sorted(small))), None
    if far:
        used = stored(_used_codes(facts, far, numbers, tagged))
        total = used.agg(F.sum(width.cast("bigint")), F.sum("n")).first()
        if (total[0] or 0) > room:
            hot = F.col("n") * HOT_SHARE > total[1]
            used, rest = used.where(hot), used.where(~hot)
        far_kept = used.select("of", "code", "value")
    keys = [f"__key_{i}" for i in range(len(asks))]
    out = facts.select("*", *[a.key.alias(k) for a, k in zip(asks, keys)])
    hashable = [F.col(quote_name(f.name)) for f in facts.schema.fields if "map<" not in f.dataType.simpleString()]
    for i, (a, key) in enumerate(zip(asks, keys)):
        n, name = numbers[a.of], quote_name(a.name)
        kept = (near if n in small else far_kept).where(F.col("of") == n)
        kept = kept.select(F.col("code").alias(key), F.col("value").alias(a.name), F.lit(True).alias(f"__met_{i}"))
        out = out.join(F.broadcast(kept), key, "left")
        if rest is not None and n not in small:
            settled = F.col(key).isNull() | F.col(f"__met_{i}")
            dealt = F.when(F.coalesce(settled, F.lit(False)), F.concat(F.lit("\x01"), F.xxhash64(*hashable))).otherwise(F.col(key))
            others = rest.where(F.col("of") == n).select(F.col("code").alias(f"__dealt_{i}"), F.col("value").alias(f"__other_{i}"))
            out = out.withColumn(f"__dealt_{i}", dealt).join(others, f"__dealt_{i}", "left")
            out = out.withColumn(a.name, F.coalesce(F.col(name), F.col(f"__other_{i}")))
    return out.select(*[F.col(quote_name(c)) for c in [*facts.columns, *[a.name for a in asks]]])


def _used_codes(facts: DataFrame, asks: Sequence[Ask], numbers: Mapping, tagged: DataFrame) -> DataFrame:
    """`of, code, n, value` of every different code in the asked columns, unknown ones included."""
    cells = F.array(*[F.struct(F.lit(numbers[a.of]).alias("of"), a.key.alias("code")) for a in asks])
    found = facts.select(F.explode(cells).alias("cell")).select("cell.of", "cell.code").where("code IS NOT NULL")
    return found.groupBy("of", "code").agg(F.count("*").alias("n")).join(tagged, ["of", "code"], "left")
