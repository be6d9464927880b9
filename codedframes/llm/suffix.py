"""Removal of repeated byte strings by bucket-pointer refinement over anchored suffixes."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codedframes.llm.common import saved

#: A repeated string has LENGTH bytes; buckets start as q-grams of GRAM bytes, which are doubled until they are as long.
LENGTH, GRAM = 200, 100
REACH = LENGTH - GRAM  # a string starts at most so far before its anchor
#: A gram with more contexts than 1 / HOT_SHARE of all, or than CHUNK, is counted by string instead of in one task.
HOT_SHARE, HOT_LEAST, CHUNK = 500, 256, 20_000

_BASE, _UNBASE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_BYTES = np.random.default_rng(2024).integers(0, 1 << 64, 256, dtype=np.uint64)


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, np.uint64)
    return tuple(np.cumprod(np.concatenate([one, np.full(n - 1, b, np.uint64)])) for b in (_BASE, _UNBASE))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """64-bit hashes of any substrings of one text, from prefix sums (arithmetic modulo 2^64)."""

    def __init__(self, text: bytes):
        codes = _BYTES[np.frombuffer(text, np.uint8)]
        power, self.unpower = _powers(1 << max(10, (len(text) + 1).bit_length()))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * power[:len(codes)], dtype=np.uint64)])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.unpower[start] + (stop - start).astype(np.uint64))


def _slide(values: np.ndarray, width: int, least) -> np.ndarray:
    """The minimum (or maximum) of each `width` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        values, span = least(values[:-span], values[span:]), 2 * span
    return least(values[:len(values) - (width - span)], values[width - span:]) if width > span else values


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, gram hashes and context hashes of a text's anchors.

    In each string of LENGTH bytes the gram of the least hash is an anchor (all of them, if it repeats), so equal strings
    have equal anchors at equal places. The context is all that strings with this anchor may cover, inside the text.
    """
    if len(text) < LENGTH:
        return (np.zeros(0, np.int64),) * 3
    hashes, at = Hashes(text), np.arange(len(text) - GRAM + 1)
    grams = hashes.of(at, at + GRAM)
    least = _slide(grams, REACH + 1, np.minimum)
    edge = np.zeros(REACH, np.uint64)
    found = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), REACH + 1, np.maximum) == grams)
    low, high = np.maximum(found - REACH, 0), np.minimum(found + LENGTH, len(text))
    whole = hashes.of(low, high) + (found - low).astype(np.uint64) * np.uint64(_BASE)
    return found, grams[found].view(np.int64), whole.view(np.int64)


def refine(contexts: list[bytes], left: np.ndarray) -> np.ndarray:
    """For each context and each place its string may start, whether another context has the same string there.

    Column c of the result is the string that starts c bytes into the frame, REACH before the anchor. Each round doubles
    the length: the new bucket of a place is the pair of its bucket and the bucket one length later, as the last round
    left them. A bucket of one row is closed (-1), and closes all longer ones that contain it.
    """
    n, width = len(contexts), REACH + LENGTH
    codes = np.zeros((n, width), np.uint64)
    inside = np.zeros((n, width + 1), bool)
    for i, (text, l) in enumerate(zip(contexts, left, strict=True)):
        codes[i, REACH - l:REACH - l + len(text)] = _BYTES[np.frombuffer(text, np.uint8)]
        inside[i, REACH - l:REACH - l + len(text) + 1] = True
    power, unpower = _powers(1024)
    sums = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(codes * power[:width], axis=1, dtype=np.uint64)], axis=1)
    places = width - GRAM + 1
    buckets = np.full((places, n), -1, np.int64)
    for c in range(places):
        live = np.flatnonzero(inside[:, c] & inside[:, c + GRAM])
        buckets[c, live] = _shared((sums[live, c + GRAM] - sums[live, c]) * unpower[c])
    length = GRAM
    while length < LENGTH:
        for c in range(len(buckets) - length):
            live = np.flatnonzero((buckets[c] >= 0) & (buckets[c + length] >= 0))
            pairs = buckets[c, live] * n + buckets[c + length, live]
            buckets[c] = -1
            buckets[c, live] = _shared(pairs)
        buckets, length = buckets[:len(buckets) - length], 2 * length
    return (buckets >= 0).T


def _shared(values: np.ndarray) -> np.ndarray:
    """Numbers of the buckets of equal values; -1 for a value that is there once."""
    _, number, count = np.unique(values, return_inverse=True, return_counts=True)
    return np.where(count[number] > 1, number, -1)


def _runs(row: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (first, last + 1) of a boolean row."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], row.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _key():
    return F.xxhash64("doc_id", "text")


def repeated(docs: DataFrame) -> DataFrame:
    """(key, first, last): byte ranges that repeated strings cover, per hash of (doc_id, text); ranges may overlap.

    1. Anchors are bucketed by their gram; a gram that is there once drops out.
    2. Grams whose contexts are all equal are repeated as a whole. Of the others, contexts found more than once are too.
    3. One example of each different context of the rest is fetched, and the buckets are refined within their grams.
       Grams with very many contexts are not gathered: their strings are counted one by one, and equal ones meet early.
    """
    texts = docs.select(_key().alias("key"), F.col("text").cast("binary").alias("text")).where(f"length(text) >= {LENGTH}")

    def find(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, gram, whole = anchors(text)
                low, high = np.minimum(at, REACH), np.minimum(len(text) - at, LENGTH)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram), pa.array(whole), pa.array(np.full(len(at), key)), pa.array(at.astype(np.int32)),
                     pa.array((low << 16 | high).astype(np.int32))], ["gram", "whole", "key", "at", "reach"])

    found = texts.mapInArrow(find, "gram long, whole long, key long, at int, reach int")
    grams = saved(found.groupBy("gram").agg(F.count("*").alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b"))
                  .where("n > 1").selectExpr("gram AS of_gram", "a <> b AS differ"))
    open_ = saved(found.join(grams, F.col("gram") == F.col("of_gram")).drop("of_gram"))
    all_of = ["key", "at - shiftright(reach, 16) AS first", "at + (reach & 65535) AS last"]
    equal = open_.where("NOT differ").selectExpr(*all_of)

    examples = saved(open_.where("differ").groupBy("gram", "whole").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "at", "reach")).alias("example")))
    many = examples.where("n > 1").select(F.col("gram").alias("of_gram"), F.col("whole").alias("of_whole"))
    copied = open_.where("differ").join(
        saved(many), (F.col("gram") == F.col("of_gram")) & (F.col("whole") == F.col("of_whole"))).selectExpr(*all_of)

    total = examples.count()
    bound = min(max(HOT_LEAST, total // HOT_SHARE), CHUNK)
    sizes = saved(examples.groupBy("gram").agg((F.count("*") > bound).alias("hot")).withColumnRenamed("gram", "of_gram"))
    wanted = examples.join(sizes, F.col("gram") == F.col("of_gram")).selectExpr(
        "example.key AS of_key", "struct(gram, n, example.at AS at, example.reach AS reach, hot) AS item")
    per_text = wanted.groupBy("of_key").agg(F.collect_list("item").alias("items"))

    def fetch(batches):
        for batch in batches:
            for key, text, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for at in range(0, len(items), CHUNK):
                    part = items[at:at + CHUNK]
                    cut = [text[x["at"] - (x["reach"] >> 16):x["at"] + (x["reach"] & 65535)] for x in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[c] for x in part], t) for c, t in (("gram", pa.int64()), ("n", pa.int64()), ("hot", pa.bool_()))]
                        + [pa.array([key] * len(part), pa.int64()), pa.array([x["at"] for x in part], pa.int32()),
                           pa.array([x["reach"] >> 16 for x in part], pa.int32()), pa.array(cut, pa.binary())],
                        ["gram", "n", "hot", "key", "at", "left", "context"])

    contexts = saved(
        texts.join(per_text, F.col("key") == F.col("of_key")).dropDuplicates(["key"]).select("key", "text", "items")
        .mapInArrow(fetch, "gram long, n long, hot boolean, key long, at int, left int, context binary"))

    def resolve(batches):
        def done(table: pa.Table):
            rows = table.to_pydict()
            hits = refine(rows["context"], np.array(rows["left"]))
            out = [(key, at - REACH + a, at - REACH + b - 1 + LENGTH) for key, at, n, hit in zip(
                rows["key"], rows["at"], rows["n"], hits, strict=True) if n == 1 for a, b in _runs(hit)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(
                (pa.int64(), pa.int32(), pa.int32()))], ["key", "first", "last"])

        held = None
        for batch in batches:  # sorted by gram; the last gram of a chunk waits for its other rows
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            gram = held.column("gram").to_numpy()
            if len(gram) >= CHUNK and (full := int(np.flatnonzero(gram != gram[-1])[-1] + 1 if (gram != gram[-1]).any() else 0)):
                yield from done(held.slice(0, full))
                held = held.slice(full)
        if held is not None and held.num_rows:
            yield from done(held)

    def spell(batches):
        for batch in batches:
            for gram, n, _, key, at, left, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start = np.arange(len(text) - LENGTH + 1)
                if len(start):
                    string = Hashes(text).of(start, start + LENGTH) + (start - left).astype(np.uint64) * np.uint64(_BASE)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(string.view(np.int64)), pa.array(np.full(len(start), n)), pa.array(np.full(len(start), key)),
                         pa.array((at - left + start).astype(np.int32))], ["string", "n", "key", "first"])

    few = contexts.where("NOT hot").repartition("gram").sortWithinPartitions("gram")
    refined = few.mapInArrow(resolve, "key long, first int, last int")
    spelt = contexts.where("hot").mapInArrow(spell, "string long, n long, key long, first int")
    twice = saved(spelt.groupBy("string").agg(F.sum("n").alias("n")).where("n > 1").select(F.col("string").alias("of_string")))
    counted = spelt.where("n = 1").join(twice, F.col("string") == F.col("of_string")).selectExpr(
        "key", "first", f"first + {LENGTH} AS last")
    return equal.union(copied).union(refined).union(counted)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, kept binary, n_bytes, n_removed, n_spans) of each row of `docs` (doc_id, text), whole texts as UTF-8.

    A byte goes if a string of LENGTH bytes covers it that also starts elsewhere, in the same or another row; strings
    never cross rows and are judged on the input. A null or short text loses nothing (null counts as empty). Rows that
    repeat doc_id and text are elsewhere for each other, so all their long texts go. Other columns are not read; an
    empty table gives no rows.
    """
    ranges = repeated(docs).groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"), _key().alias("key"))

    def cut(batches):
        for batch in batches:
            out = []
            for text, ranges_ in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                kept, stop, spans, removed = [], 0, 0, 0
                for first, last in sorted((r["first"], r["last"]) for r in ranges_ or ()):
                    if first > stop or not spans:
                        kept.append(text[stop:first])
                        spans += 1
                        removed += last - first
                        stop = last
                    elif last > stop:
                        removed += last - stop
                        stop = last
                kept.append(text[stop:])
                out.append((b"".join(kept), len(text), removed, spans))
            types = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in out], t) for i, t in enumerate(types))],
                ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return rows.join(ranges, "key", "left").select("doc_id", "text", "ranges").mapInArrow(
        cut, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")

