"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codedframes.llm.common import WORD, ranked, saved

WEIGHTS = (5, 2, 1)


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> list[tuple]:
    """(source, size, target) in code point order, null last.

    The sources share `share` times all sizes by weight; a target stops at `most` times its source's size and the excess
    is shared again by weight. Sources are capped in order of cap / weight: what is left then gives one rate per weight.
    """
    rows = sorted(sizes, key=lambda r: (r[0] is None, r[0] or ""))
    weighed = [(most * size / weights[i % len(weights)], i, weights[i % len(weights)], most * size) for i, (_, size) in enumerate(rows)]
    rest, weight = share * sum(size for _, size in rows), float(sum(w for _, _, w, _ in weighed))
    given = {}
    for _, i, w, cap in sorted(weighed):
        if rest / weight * w > cap:
            given[i], rest, weight = cap, rest - cap, weight - w
        else:
            break
    return [(s, size, given[i] if i in given else rest / weight * weighed[i][2]) for i, (s, size) in enumerate(rows)]


def offset(source: str | None, seed: int) -> float:
    """A number in [0, 1) that depends on source and seed alone, so reruns agree."""
    return int(hashlib.md5(f"{seed}:{'null' if source is None else '=' + source}".encode()).hexdigest()[:13], 16) / 16.0**13


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 42) -> DataFrame:
    """(doc_id, key, source, size, source_size, target, copies, taken) of each row of `docs` (doc_id, text, source).

    size is the number of words; every document of a source is expected target / source_size times. Within a source,
    in order of (size, doc_id, key), a document comes once for each integer that the running sum of expected copies
    plus the source's offset crosses. Neighbours in that order are of nearly equal size, so the words taken come within
    about one document of the target. `key` is a hash of doc_id and text that pairs the rows with `docs` again.

    A null text has size 0, a source without words target 0; null is a source of its own, the last; rows with a null
    doc_id and repeated rows count like others. The running sum needs no source in one task: rows are dealt by ranges
    of (source, size, doc_id, key), numbered within each range, and each range adds the counts of those before it.
    One row per source comes to the driver: sources are names of data sets, thousands at most.
    """
    spark = docs.sparkSession
    sized = saved(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"), "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ))
    totals = [(r["source"], r["size"]) for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    plan = [
        (i, source, size, target, min(most, target / size) if size else 0.0, offset(source, seed))
        for i, (source, size, target) in enumerate(targets(totals, weights, share, most))
    ]
    plan = spark.createDataFrame(plan, "number int, of string, source_size long, target double, rate double, start double")
    numbered = sized.join(F.broadcast(plan.select("number", "of")), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    placed = ranked(numbered, "number", ["size", "doc_id", "key"]).join(F.broadcast(plan), "number")
    at = F.col("rank")
    crossed = F.floor((at + 1) * F.col("rate") + F.col("start")) - F.floor(at * F.col("rate") + F.col("start"))
    return placed.withColumn("copies", crossed.cast("int")).select(
        "doc_id", "key", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns, each as often as `mix` takes it."""
    nth = Window.partitionBy("mix_key").orderBy(F.lit(1))
    taken = mix(docs, **options).select(F.col("key").alias("mix_key"), "copies")
    taken = taken.withColumn("mix_nth", F.row_number().over(nth)).where("copies > 0")
    rows = docs.withColumn("mix_key", F.xxhash64("doc_id", "text")).withColumn("mix_nth", F.row_number().over(nth))
    out = rows.join(taken, ["mix_key", "mix_nth"]).withColumn("mix_copy", F.explode(F.expr("sequence(1, copies)")))
    return out.select(*docs.columns)
