"""Line dedup by a segment-partition edit join, in DataFrame expressions alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codedframes.llm.common import drop_saved, saved
from codedframes.llm.components import components

#: Lines of at least so many characters (the shorter one of two) also match at up to so many edits (insert, delete or
#: replace one character): one at LEAST, more from the lengths in MORE on.
LEAST, MORE = 20, ((64, 2), (128, 3))
#: Lines that share their whole parts are compared in pairs up to so many; larger groups are divided further.
PAIRED = 8
#: In a larger group, a stretch of up to so many characters that holds the edit is tried at each place.
PLACES = 32
#: Segments of lines that may take several edits depend on the length in steps of STEP. What is left of a large group of
#: these is compared in pairs of blocks of about so many lines.
STEP, BLOCK = 16, 512


def _lines(docs: DataFrame, *more: str) -> DataFrame:
    """(key, no, line, hash, ...): the lines of each text that are not blank; key is a hash of doc_id and text."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("key"), *more, F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return rows.where("line RLIKE '[^\\\\s]'").withColumn("hash", F.xxhash64("line"))


def _states(lines: DataFrame, parts: list[tuple[Column, Column, Column, bool | Column]]) -> DataFrame:
    """(segment, hash, longer, n, a, b) of each line and each of `parts` (n, a, b, longer), as `_first` explains."""
    def state(n, a, b, longer) -> Column:
        suffix = F.substring("line", F.length("line") - b + 1, b)
        key = F.xxhash64(n, a, b, F.substring("line", F.lit(1), a), F.when(b > 0, suffix).otherwise(""))
        longer = longer if isinstance(longer, Column) else F.lit(longer)
        return F.struct(key.alias("segment"), longer.alias("longer"), n.alias("n"), a.alias("a"), b.alias("b"))

    return lines.select("hash", F.explode(F.array(*[state(*p) for p in parts])).alias("s")).select("hash", "s.*")


def _first(lines: DataFrame) -> DataFrame:
    """The states in which a line may meet others at one edit.

    Of two lines at one edit, the shorter (or either) of n characters is cut into two segments at n / 2, and one of them
    is whole in both lines: the first a characters, or the last b. A line meets others of its own length n, and as the
    longer one those of length n - 1. Length, a, b and the text of the whole part make the key.
    """
    parts = []
    for longer in (0, 1):
        n = F.length("line") - longer
        half = F.floor(n / 2).cast("int")
        parts += [(n, half, F.lit(0), bool(longer)), (n, F.lit(0), n - half, bool(longer))]
    return _states(lines.where(F.length("line") >= LEAST), parts)


def _meeting(states: DataFrame) -> DataFrame:
    """The states, saved, whose segment two different lines share, at least one of them as the shorter; `large`: more than PAIRED share it."""
    group = Window.partitionBy("segment")
    own = F.when(~F.col("longer"), F.col("hash"))
    shared = states.select("*", F.min(own).over(group).alias("x"), F.max(own).over(group).alias("y"), F.max("longer").over(group).alias("z"),
                           (F.count("*").over(group) > PAIRED).alias("large")).where("x <> y OR (x IS NOT NULL AND z)")
    return saved(shared.select("segment", "hash", "longer", "n", "a", "b", "large", F.expr("n - a - b AS middle")))


def _edits(n: Column) -> Column:
    """How many edits a line of n characters may take."""
    return reduce(lambda e, x: F.when(n >= x[0], x[1]).otherwise(e), MORE, F.when(n >= LEAST, 1).otherwise(0))


def _segments(lines: DataFrame) -> DataFrame:
    """(segment, hash, n), each once: segments of which two lines share one, if they are within 2 or 3 edits, as many as they may take.

    The shorter line has a segment for each edit and one more: the first (at the start), the second (next to it), of three
    edits the third, and the last (at the end), with the place of those behind the middle counted from the end. If neither
    the first nor the last is whole in the other line, each holds an edit. Of two edits, the second is then whole and at
    most one place off. Of three, the second is, or all but one edit come before the third, which is then at most one place
    off. Their length depends on the line's length, rounded down to STEP, so the longer one mostly has the same.
    """
    # Each step reads columns of the one before: inside larger expressions a length would be counted many times over.
    lines = lines.select("hash", "line", F.length("line").alias("n")).where(F.col("n") >= MORE[0][0])
    n, most = F.col("n"), max(t for _, t in MORE)
    kinds = [F.struct(_edits(n - k).alias("edits"), (F.floor((n - k) / STEP) * STEP).cast("int").alias("size")) for k in range(most + 1)]
    lines = lines.select("hash", "line", "n", *[kind.alias(f"kind_{k}") for k, kind in enumerate(kinds)])
    # As the shorter line's length falls, so do edits and size: a kind that was there before is next to its like.
    fresh = [F.col("kind_0"), *[
        F.when(F.expr(f"kind_{k}.edits >= {max(2, k)} AND kind_{k} <> kind_{k - 1}"), F.col(f"kind_{k}")) for k in range(1, most + 1)]]
    each = lines.select("hash", "line", "n", F.explode(F.array(*fresh)).alias("k")).where("k IS NOT NULL")
    each = each.select("hash", "line", "n", "k.*").withColumn("long", F.expr("size DIV (edits + 1)"))
    long = F.col("long")

    def key(no: int, start: Column) -> Column:
        return F.xxhash64("edits", "size", F.lit(no), F.substring("line", start, long))

    keys = [key(1, F.lit(1)), key(4, F.col("n") - long + 1), *[key(2, long + 1 + s) for s in (-1, 0, 1)]]
    keys += [F.when(F.col("edits") == 3, key(3, F.col("n") - 2 * long + 1 + s)) for s in (-1, 0, 1)]
    return each.select(F.explode(F.array_distinct(F.array(*keys))).alias("segment"), "hash", "n").where("segment IS NOT NULL")


def _marks(line: str) -> Column:
    """(pairs, chars), 64 bits each: whether the line holds an odd number of the pairs of neighbours, the characters, that fall to a bit.

    An edit takes away up to two pairs and brings up to two, or one character each, so lines within e edits differ in 4 * e
    bits of the first and 2 * e of the second at most (`_may_be`).
    """
    odd = "aggregate({}, 0L, (all, x) -> all ^ shiftleft(1L, int(x & 63)))"
    pairs = f"zip_with(slice(split({line}, ''), 1, length({line}) - 1), slice(split({line}, ''), 2, length({line})), (a, b) -> xxhash64(a, b))"
    chars = f"transform(split({line}, ''), x -> xxhash64(x))"
    return F.expr(f"struct({odd.format(pairs)} AS pairs, {odd.format(chars)} AS chars)")


def _may_be(most: Column) -> Column:
    """Whether the marks of two lines allow so many edits."""
    return (F.expr("bit_count(marks_a.pairs ^ marks_b.pairs)") <= 4 * most) & (F.expr("bit_count(marks_a.chars ^ marks_b.chars)") <= 2 * most)


def near_edges(lines: DataFrame) -> DataFrame:
    """Edges (a, b) between hashes of different lines that connect them exactly as all links do; not each is a link itself.

    `lines` (hash, line) has each different line once. Two lines are linked within as many edits as the shorter may take. Shorter lines, and those in large groups of longer
    ones, go through `_one_edit_edges`. Longer ones that share a segment are verified in pairs, in groups of up to PAIRED.
    In larger groups, lines that aren't connected by then meet in all pairs, in blocks of about BLOCK, and are verified
    where they meet, if their `_marks` are near enough: no list of pairs is made, and nothing is left out.
    """
    # Rows are counted where they are sorted by segment: a group's rows are three numbers each and may spill.
    size = F.count("*").over(Window.partitionBy("segment"))
    sized = saved(_segments(lines).withColumn("size", size).where("size > 1"))
    small, large = sized.where(F.col("size") <= PAIRED), sized.where(F.col("size") > PAIRED)
    wanted = sized.groupBy(F.col("hash").alias("of_hash")).agg(F.max(F.col("size") > PAIRED).alias("large"))
    texts = saved(lines.select("hash", "line").join(wanted.hint("shuffle_hash"), F.col("hash") == F.col("of_hash")).select(
        "hash", "line", "large", _marks("line").alias("marks")))
    short = lines.where(F.length("line") <= MORE[0][0]).select("hash", "line")
    one = _one_edit_edges(short.union(texts.where("large").select("hash", "line")))
    most = max(t for _, t in MORE)
    may = _edits(F.least(F.length("line_a"), F.length("line_b")))
    edits = F.levenshtein("line_a", "line_b", most)
    near, linked = _may_be(F.lit(most)) & _may_be(may), (edits >= 0) & (edits <= may)
    first, second = (texts.select(F.col("hash").alias(c), F.col("line").alias(f"line_{c}"), F.col("marks").alias(f"marks_{c}")) for c in ("a", "b"))
    pairs = (
        small.select("segment", F.col("hash").alias("a"), F.col("n").alias("n_a"))
        .join(small.select("segment", F.col("hash").alias("b"), F.col("n").alias("n_b")), "segment")
        .where(f"a < b AND abs(n_a - n_b) <= {most}").select("a", "b").distinct()
    )
    found = saved(one.union(pairs.join(first, "a").join(second, "b").where(near & linked).select("a", "b")))
    if large.isEmpty():
        return found
    roots = saved(components(found)).select(F.col("node").alias("of_node"), "root")
    rooted = saved(large.join(roots, F.col("hash") == F.col("of_node"), "left").select(
        "segment", "hash", "n", F.coalesce("root", "hash").alias("root")))
    several = rooted.groupBy("segment").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("m")).where("x <> y").select(
        "segment", F.expr(f"int(ceil(m / {BLOCK}))").alias("blocks"))
    still = saved(rooted.join(several, "segment"))
    # A line has few segments. Two lines that share several of these are verified in the smallest alone.
    of_line = still.groupBy("hash").agg(F.sort_array(F.collect_set("segment")).alias("shared"))
    still = saved(still.join(texts.select("hash", "line", "marks").join(of_line, "hash"), "hash"))
    own, all_blocks = F.expr("int(pmod(xxhash64(hash, 6), blocks))"), F.expr("explode(sequence(0, blocks - 1))")
    one_side = still.select("segment", own.alias("block"), all_blocks.alias("o_block"), F.col("hash").alias("a"), F.col("n").alias("n_a"),
                            F.col("root").alias("root_a"), F.col("line").alias("line_a"), F.col("marks").alias("marks_a"), F.col("shared").alias("shared_a"))
    other_side = still.select("segment", all_blocks.alias("block"), own.alias("o_block"), F.col("hash").alias("b"), F.col("n").alias("n_b"),
                              F.col("root").alias("root_b"), F.col("line").alias("line_b"), F.col("marks").alias("marks_b"), F.col("shared").alias("shared_b"))
    once = F.expr("array_min(array_intersect(shared_a, shared_b)) = segment")
    crossing = one_side.join(other_side, ["segment", "block", "o_block"]).where(
        F.expr(f"a < b AND root_a <> root_b AND abs(n_a - n_b) <= {most}") & near & once & linked).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    # Each line next to its root, and roots that a link joins: fewer steps from end to end than over the links themselves.
    return roots.where("of_node <> root").select(F.col("of_node").alias("a"), F.col("root").alias("b")).union(crossing.distinct())


def _one_edit_edges(lines: DataFrame) -> DataFrame:
    """Edges (a, b) between hashes of different lines that connect them exactly as all links at one edit do.

    `lines` (hash, line) has each line once. Only segments that two lines share go on; texts are fetched for those lines
    alone. Groups of up to PAIRED lines are verified in pairs by Spark's banded edit distance. In a larger group the edit
    lies in the middle that isn't known to be whole. A middle of up to PLACES characters is tried at each place
    (`_at_each_place`). Of a longer one, a first or a last half must be whole, so the line goes on with a longer a and with a longer b.
    """
    met = _meeting(_first(lines))
    wanted = met.select(F.col("hash").alias("of_hash")).distinct()
    texts = saved(lines.select("hash", "line").join(wanted, F.col("hash") == F.col("of_hash")).select("hash", "line"))
    first, second = (texts.select(F.col("hash").alias(c), F.col("line").alias(f"line_{c}")) for c in ("a", "b"))
    pairs, tried = [], []
    while True:
        small, large = met.where("NOT large"), met.where("large")
        pairs.append(
            small.where("NOT longer").select("segment", F.col("hash").alias("a"))
            .join(small.select("segment", F.col("hash").alias("b"), "longer"), "segment")
            .where("a < b OR (longer AND a <> b)").select("a", "b")
        )
        tried.append(large.where(F.col("middle") <= PLACES))
        on = large.where(F.col("middle") > PLACES).select(F.col("hash").alias("on_hash"), "longer", "n", "a", "b", "middle")
        if on.isEmpty():
            break
        half, rest = F.expr("middle DIV 2"), F.expr("middle - middle DIV 2")
        lasting = on.join(texts, F.col("on_hash") == F.col("hash"))
        n, a, b, longer = (F.col(c) for c in ("n", "a", "b", "longer"))
        met = _meeting(_states(lasting, [(n, a + half, b, longer), (n, a, b + rest, longer)]).distinct())
    verified = reduce(DataFrame.union, pairs).distinct().join(first, "a").join(second, "b").where(
        F.levenshtein("line_a", "line_b", 1) >= 0).select("a", "b")
    of_large = reduce(DataFrame.union, tried).select(F.col("hash").alias("of_hash"), "longer", "a", "middle")
    return verified.union(_at_each_place(texts.join(of_large, F.col("hash") == F.col("of_hash")))).distinct()


def _at_each_place(lines: DataFrame) -> DataFrame:
    """Edges of `lines` (hash, line, longer, a, middle) at one edit behind the first a characters, within the middle.

    Lines that share all but the character at one place, and a line that others give without one of theirs, are links by
    themselves and are joined as a star. A star has at most one line for each character, or for each place and character.
    """
    without = F.expr("concat(substring(line, 1, place - 1), substring(line, place + 1))")
    places = lines.withColumn("place", F.expr("explode(sequence(a + 1, a + middle + int(longer)))"))
    keys = places.select("hash", (~F.col("longer")).alias("whole"), F.xxhash64(F.expr("IF(longer, 0L, bigint(place))"), without).alias("key"))
    whole = lines.where("NOT longer").select("hash", F.lit(True).alias("whole"), F.xxhash64(F.expr("0L"), "line").alias("key"))
    head = F.min(F.when(F.col("whole"), F.col("hash"))).over(Window.partitionBy("key"))
    return keys.union(whole).select("hash", head.alias("head")).where("hash <> head").select(F.col("hash").alias("a"), F.col("head").alias("b"))


def dedup_lines(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, key, text, n_lines, n_removed, removed, carried): each row of `docs` (doc_id, text) without its repeated lines.

    Lines (split at line feeds, compared as they are) form classes: equal lines, and lines of at least LEAST characters
    linked at one edit, longer ones at up to three (MORE), directly or through others. The first line of a class stays, in order of doc_id (null last), a
    hash of the text, and place; the others go. Blank lines stay. `removed` has the numbers of the lines that went, from
    0. A null text stays null and has no lines; a text may end up empty. Rows that repeat doc_id and text are one
    document and stay alike. `carried` is a struct of the columns named in `carry`; others are not read. An empty table gives no rows.
    """
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    lines = _lines(docs.withColumn("doc_order", order), "doc_order")
    # Each different line once, with its text where it may be linked: links are sought in this table, not in the documents.
    counted = saved(lines.groupBy("hash", F.when(F.length("line") >= LEAST, F.col("line")).alias("line")).agg(F.count("*").alias("n")))
    roots = saved(components(near_edges(counted.where("line IS NOT NULL").select("hash", "line"))))
    rooted = saved(counted.select("hash", "n").join(roots, F.col("hash") == F.col("node"), "left").where("n > 1 OR root IS NOT NULL").select(
        F.col("hash").alias("of_hash"), F.coalesce("root", "hash").alias("root")))
    drop_saved(counted)
    places = saved(lines.select("doc_order", "key", "no", "hash").join(rooted.hint("shuffle_hash"), F.col("hash") == F.col("of_hash")).select(
        "root", F.struct("doc_order", "key", "no").alias("place")))
    classes = saved(places.groupBy(F.col("root").alias("of_root")).agg(F.min("place").alias("stays")))
    gone = places.join(classes, F.col("root") == F.col("of_root")).where("place <> stays").select(
        F.col("place.key").alias("of_key"), "place.no")
    per_text = gone.groupBy("of_key").agg(F.sort_array(F.collect_set("no")).alias("removed"))
    # A map of marks next to the lines would be searched in full for each line; marks in line order are read by place.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"), "text",
                       F.struct(*carry).alias("carried") if carry else F.lit(None).alias("carried"))
    joined = rows.join(per_text.hint("shuffle_hash"), F.col("key") == F.col("of_key"), "left")
    split = F.split("text", "\n")
    steps = F.expr("array_append(removed, size(split(text, '\n')))")
    stretches = F.transform(
        F.arrays_zip(F.concat(F.array(F.lit(-1)), F.col("removed")).alias("a"), steps.alias("b")),
        lambda x: F.slice(split, x["a"] + 2, x["b"] - x["a"] - 1),
    )
    kept = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(stretches), "\n"))
    return joined.select(
        "doc_id", "key", kept.alias("text"), F.coalesce(F.size(split), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        "carried",
    )
