"""A corpus pipeline of five stages over `documents`; each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codedframes.llm import line_dedup, mixing, packing, simhash, toxicity
from codedframes.llm.common import saved

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the given labels, doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = docs.select(*COLUMNS)
    return toxicity.accepted(docs, toxicity.fit(docs, labels))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat another; n_chars counts what is left (null for a null text)."""
    rows = line_dedup.dedup_lines(docs, carry=("lang", "source")).select("doc_id", "text", "carried.*")
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest doc_id, of each group of near-duplicates.

    Texts link where the SimHash fingerprints of their three-word shingles differ in three bits or fewer; texts without words
    (null, empty, blank) link with each other. A document without an id is known by a number above all ids, made from its
    text, and stays only if its group has no ids. Of rows that repeat id and text one stays; an empty table stays empty.
    """
    number = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61))
    rows = docs.select(*COLUMNS, F.coalesce("doc_id", number).alias("row_id"))
    found = simhash.near_duplicates(rows.select(F.col("row_id").alias("doc_id"), "text"), shingle=3, max_bits=3)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("row_id")).distinct()
    return rows.join(kept, "row_id", "left_semi").dropDuplicates(["row_id", "text"]).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources by weight takes them.

    A null source is one of its own, the last; a null text has no words and is never taken; each of several equal rows is
    taken for itself; an empty table stays empty.
    """
    return mixing.mixed(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences of 1024.

    A null or empty text is one piece, the end id; rows that the mix repeats are packed each for itself; no documents make
    no pieces.
    """
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources), ("packing", pack_sequences),
]

#: The toxicity model is fitted on the labels, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again, whatever nulls, repeats or no rows it has."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
