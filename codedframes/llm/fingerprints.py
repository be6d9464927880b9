"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame expressions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codedframes.llm.common import GAP

SHINGLE, K = 5, 128


def sketch(text: Column, shingle: int = SHINGLE, k: int = K) -> Column:
    """The k smallest distinct hashes of the text's word shingles, sorted (array<bigint>).

    Words are lower-cased; a text of fewer words than a shingle is one shingle, one without words gives an empty array,
    as does a null text. Two sketches of the same k and shingle can be merged and compared.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), "")

    def of_hashes(hashes: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(hashes) - (shingle - 1)))
        found = F.transform(at, lambda i: F.xxhash64(F.slice(hashes, i, shingle)))
        return F.when(F.size(hashes) == 0, F.array().cast("array<bigint>")).otherwise(
            F.slice(F.sort_array(F.array_distinct(found)), 1, k)
        )

    # The word hashes are made once and bound to a name by a transform over an array of one.
    return F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), of_hashes)[0]


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merged(sketches: DataFrame, key: str, column: str, k: int = K) -> DataFrame:
    """(key, column): the sketch of the union of each key's sketches. Each task keeps k hashes of a key before the shuffle."""
    each = sketches.select(key, F.explode(column).alias("hash")).distinct()
    nth = F.row_number().over(Window.partitionBy(key).orderBy("hash"))
    return each.withColumn("nth", nth).where(F.col("nth") <= k).groupBy(key).agg(F.sort_array(F.collect_list("hash")).alias(column))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, 0 to 1: the share of the union's sketch that both have. Two empty ones give 1."""
    both = F.size(F.array_intersect(F.array_intersect(a, b), merge(a, b, k)))
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(both / F.size(merge(a, b, k)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1; an empty a is contained in all."""
    j = resemblance(a, b, k)
    shared = j / (1 + j) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def encoded(a: Column) -> Column:
    """A sketch as text: base64 of its hashes, eight bytes each."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")))


def with_next(docs: DataFrame, carry, per_partition: int = 4) -> DataFrame:
    """(doc_id, text, next_text, and for each name in `carry` itself and next_name) in descending order of doc_id.

    After the smallest id comes the largest again; a single row is its own next. Null ids come last, in the order of a
    hash of their text; equal ids are in the order of that hash. A null text counts as empty. `carry` maps names to
    columns of `text`, made once per row after the shuffle.

    Rows are dealt by ranges of doc_id, whose bounds are estimated quantiles, a few per partition; the first row of each
    range also goes to the range before it. So the order is global, and each text is shuffled once.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    last = F.lit(-(1 << 63)) + F.pmod(F.xxhash64(text), F.lit(1 << 40))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("at", F.coalesce("doc_id", last))
    n = max(2, min(20_000, per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    bounds = rows.agg(F.percentile_approx("at", [i / n for i in range(1, n)], max(10_000, 20 * n)).alias("b")).first()["b"]
    bounds = sorted(set(bounds or []))
    if not bounds:
        return _following(rows.withColumn("range", F.lit(0)).withColumn("guest", F.lit(False)), carry)
    steps = F.sequence(F.lit(len(bounds).bit_length() - 1), F.lit(0), F.lit(-1))
    def step(at: Column, s: Column) -> Column:
        further = at + F.call_function("shiftleft", F.lit(1), s)
        return F.when((further <= len(bounds)) & (F.get(F.lit(bounds), further - 1) <= F.col("at")), further).otherwise(at)

    place = F.aggregate(steps, F.lit(0), step)  # the number of bounds up to the id, by halving
    rows = rows.withColumn("range", place)
    tops = {r["range"]: r["top"] for r in rows.groupBy("range").agg(F.max("at").alias("top")).collect()}
    filled = sorted(tops)
    above = dict(zip(filled, [*filled[1:], filled[0]], strict=True))
    top = F.get(F.lit([tops.get(i, 0) for i in range(len(bounds) + 1)]), F.col("range"))
    to = F.get(F.lit([above.get(i, 0) for i in range(len(bounds) + 1)]), F.col("range"))
    own, guest = F.struct(F.col("range"), F.lit(False).alias("guest")), F.struct(to.alias("range"), F.lit(True).alias("guest"))
    dealt = rows.withColumn("dealt", F.explode(F.when(F.col("at") == top, F.array(own, guest)).otherwise(F.array(own))))
    return _following(dealt.select("doc_id", "text", "at", "dealt.range", "dealt.guest"), carry)


def _following(dealt: DataFrame, carry) -> DataFrame:
    rows = dealt.repartition("range")
    for name, column in carry.items():
        rows = rows.withColumn(name, column)
    order = Window.partitionBy("range").orderBy("guest", F.desc("at"), F.desc(F.xxhash64("text")))
    followed = rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("text", *carry)]).where("NOT guest")
    own = [F.coalesce(f"next_{c}", c).alias(f"next_{c}") for c in ("text", *carry)]
    return followed.select("doc_id", "text", *carry, *own)


def edited_pairs(docs: DataFrame, shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """(doc_id, n_chars, edited_text, sketch, edited_sketch, next_sketch): each whole text, its edited form and the next.

    The edited text has the last half of the text's characters, rounded down, replaced by as many first characters of the
    next document, or all it has. Any table works: see `with_next` for null and equal ids; an empty one gives no rows.
    """
    rows = with_next(docs, {"sketch": sketch(F.col("text"), shingle, k)})
    half = F.expr("length(text) DIV 2")
    edited = F.concat(F.expr("substring(text, 1, length(text) - length(text) DIV 2)"), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited_text"), "sketch", "next_sketch")
    return rows.withColumn("edited_sketch", sketch(F.col("edited_text"), shingle, k))
