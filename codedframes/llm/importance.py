"""Importance resampling towards a target's distribution of hashed n-grams."""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codedframes.llm.common import byte_windows, ranked, saved

BUCKETS, NGRAMS, SEED = 10_000, 2, 7
#: Text put into one buffer at a time, words whose n-grams are interned together, zero bytes behind a buffer.
WINDOW, CHUNK, PAD = 1 << 18, 1 << 16, 8

#: A-Z become a-z; all other bytes that are no digit, a-z or part of a character above U+007F become blanks.
LOWER = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

#: The five primes of XXH64: fixed values.
PRIMES = tuple(np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261,
))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _loads(text: bytes, kind: str) -> np.ndarray:
    """The number that starts at each byte of the text, which has zero bytes behind it."""
    width = np.dtype(kind).itemsize
    return np.ndarray(len(text) - width + 1, dtype=kind, buffer=text, strides=(1,))


def keys_of(text: bytes, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of the strings at these places of a text that ends in PAD zero bytes."""
    p1, p2, p3, p4, p5 = PRIMES
    eights, fours, ones = _loads(text, "<u8"), _loads(text, "<u4"), _loads(text, "u1")
    h = p5 + length.astype(np.uint64)
    for lane in range(3):
        at = np.flatnonzero(length >= 8 * lane + 8)
        word = _turned(eights[start[at] + 8 * lane] * p2, 31) * p1
        h[at] = _turned(h[at] ^ word, 27) * p1 + p4
    place = start + (length & ~7)
    at = np.flatnonzero(length & 4)
    h[at] = _turned(h[at] ^ fours[place[at]].astype(np.uint64) * p1, 23) * p2 + p3
    place = start + (length & ~3)
    for n in range(3):
        at = np.flatnonzero((length & 3) > n)
        h[at] = _turned(h[at] ^ ones[place[at] + n].astype(np.uint64) * p5, 11) * p1
    h ^= h >> np.uint64(33)
    h *= p2
    h ^= h >> np.uint64(29)
    h *= p3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(length >= 32):
        h[i] = xxhash.xxh64_intdigest(text[start[i]:start[i] + length[i]])
    return h


def _same(eights: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the strings of these lengths at `a` and at `b` are equal, byte by byte."""
    same = np.ones(len(a), dtype=bool)
    at, done = np.arange(len(a)), 0
    while len(at):
        keep = np.minimum(length[at] - done, 8)
        differ = (eights[a[at] + done] ^ eights[b[at] + done]) << ((8 - keep) * 8).astype(np.uint64)
        same[at[differ != 0]] = False
        done += 8
        at = at[(differ == 0) & (length[at] > done)]
    return same


class Interned:
    """An open-addressed table of the different strings among the given ones.

    `slots` has the slot of each string; `buckets` and `counts` have the bucket and the number of strings of each slot.
    A slot belongs to the string of the number in `owners` (-1: free). Keys find a slot, bytes decide: a string whose
    key meets other bytes goes on to the next slot.
    """

    def __init__(self, text: bytes, start: np.ndarray, length: np.ndarray, bucket_of: Callable[[np.ndarray], np.ndarray]):
        keys, eights = keys_of(text, start, length), _loads(text, "<u8")
        size = 1 << max(4, (2 * len(start)).bit_length())
        self.owners = np.full(size, -1, dtype=np.int32)
        self.slots = (keys & np.uint64(size - 1)).astype(np.int32)
        open_ = np.arange(len(start), dtype=np.int32)
        while len(open_):
            slots = self.slots[open_]
            free = np.flatnonzero(self.owners[slots] < 0)
            self.owners[slots[free]] = open_[free]
            owner = self.owners[slots]
            settled = owner == open_
            at = np.flatnonzero(~settled & (keys[owner] == keys[open_]))
            at = at[length[owner[at]] == length[open_[at]]]
            settled[at[_same(eights, start[owner[at]], start[open_[at]], length[open_[at]])]] = True
            open_ = open_[~settled]
            self.slots[open_] = (self.slots[open_] + 1) & (size - 1)
        self.counts = np.bincount(self.slots, minlength=size)
        used = np.flatnonzero(self.owners >= 0)
        self.buckets = np.zeros(size, dtype=np.int32)
        self.buckets[used] = bucket_of(self.owners[used])


@functools.cache
def _shift(power: int) -> np.ndarray:
    """What 2 ** power zero bytes behind a string make of each byte of its crc32 (four rows of 256): a linear map."""
    ones = np.array([1 << bit for bit in range(32)], dtype=np.uint32)
    if power == 0:
        # zlib's crc32 goes on from a crc with its bits turned round, before and after.
        images = np.array([zlib.crc32(bytes(1), int(x) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for x in ones], dtype=np.uint32)
    else:
        images = _shifted_by(_shifted_by(ones, power - 1), power - 1)
    values = np.arange(256)
    table = np.zeros((4, 256), dtype=np.uint32)
    for byte in range(4):
        for bit in range(8):
            table[byte] ^= np.where(values >> bit & 1, images[8 * byte + bit], np.uint32(0)).astype(np.uint32)
    return table


def _shifted_by(crc: np.ndarray, power: int) -> np.ndarray:
    t = _shift(power)
    return t[0][crc & 255] ^ t[1][crc >> 8 & 255] ^ t[2][crc >> 16 & 255] ^ t[3][crc >> 24]


def joined_crc(a: np.ndarray, b: np.ndarray, b_length: np.ndarray) -> np.ndarray:
    """crc32 of strings of crc32 `a`, each with one of crc32 `b` behind it."""
    a = a.copy()
    for power in range(int(b_length.max(initial=0)).bit_length()):
        at = np.flatnonzero(b_length >> power & 1)
        a[at] = _shifted_by(a[at], power)
    return a ^ b


def interned(texts: list[bytes], buckets: int, ngrams: int) -> Iterator[tuple[Interned, np.ndarray, np.ndarray]]:
    """Tables of the n-grams of some texts, with the text of each n-gram, and the words of each text found meanwhile.

    Words of a text are put into one buffer, a blank between two, where each n-gram is one run of bytes. N-grams that reach
    from one window of a long text to the next begin with the words that the last window ends with.
    """
    parts, owners, held = [], [], 0
    for i, text in enumerate(texts):
        tail: list[bytes] = []
        for window in byte_windows(text.translate(LOWER), WINDOW):
            words = window.split()
            if words:
                parts.append((tail + words, len(tail)))
                owners.append(i)
                tail = (tail + words)[max(0, len(tail) + len(words) - ngrams + 1):] if ngrams > 1 else []
                held += len(window)
            if held >= WINDOW:
                yield from _tables(parts, owners, len(texts), buckets, ngrams)
                parts, owners, held = [], [], 0
    if parts:
        yield from _tables(parts, owners, len(texts), buckets, ngrams)


def _tables(parts: list, owners: list[int], n_texts: int, buckets: int, ngrams: int):
    text = b" ".join(b" ".join(words) for words, _ in parts)
    blanks = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 0x20)
    start, end = np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(text)]])
    text += bytes(PAD)
    sizes = np.array([len(words) for words, _ in parts])
    part = np.repeat(np.arange(len(parts)), sizes)
    place = np.arange(len(part)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    old = np.array([n for _, n in parts])[part]
    owner = np.array(owners)[part]
    crc = np.fromiter(map(zlib.crc32, chain.from_iterable(words for words, _ in parts)), np.uint32, len(part))
    after_blank = joined_crc(np.full(len(part), zlib.crc32(b" "), dtype=np.uint32), crc, end - start)
    for low in range(0, len(part), CHUNK):
        first = np.arange(low, min(low + CHUNK, len(part)))
        grams = []
        for n in range(1, ngrams + 1):
            a = first[first + n <= len(part)]
            # One that ends within the words of the window before was counted there.
            grams.append(a[(part[a] == part[a + n - 1]) & (place[a] + n > old[a])])
        words, last = np.concatenate(grams), np.concatenate([a + n for n, a in enumerate(grams)])

        def bucket_of(gram, words=words, last=last):
            a, b = words[gram], last[gram]
            found = crc[a]
            for n in range(1, ngrams):
                at = np.flatnonzero(b >= a + n)
                nxt = a[at] + n
                found[at] = joined_crc(found[at], after_blank[nxt], end[nxt] - start[nxt] + 1)
            return found % buckets

        table = Interned(text, start[words], end[last] - start[words], bucket_of)
        yield table, owner[words], np.bincount(owner[grams[0]], minlength=n_texts)


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [text or b"" for text in batch.column(column).cast(pa.binary()).to_pylist()]


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, ngrams: int = NGRAMS) -> np.ndarray:
    """N-grams of all texts by bucket. A task gives one row for each bucket, and `buckets` numbers come to the driver."""

    def count(batches):
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for table, _, _ in interned(_texts(batch, 0), buckets, ngrams):
                counts += np.bincount(table.buckets, weights=table.counts, minlength=buckets).astype(np.int64)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])

    found = docs.select(F.col("text").cast("string")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, dtype=np.int64)
    for row in found.collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What an n-gram of each bucket adds to a weight: 1000 times the log of the target's share over the source's."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist())
    ], dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, ngrams: int = NGRAMS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row of `docs`: the floored mean gain of its n-grams, 0 without any."""

    def weigh(batches):
        for batch in batches:
            texts = _texts(batch, 1)
            words, features, total = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
            for table, whose, n_words in interned(texts, len(gain), ngrams):
                words += n_words
                features += np.bincount(whose, minlength=len(texts))
                np.add.at(total, whose, gain[table.buckets][table.slots])
            weight = total // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (words, features, weight))], ["doc_id", "n_words", "n_features", "weight"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, buckets: int = BUCKETS, ngrams: int = NGRAMS, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of each row of `docs` (doc_id, text), drawn towards `target` (text).

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters above U+007F; features are the runs of one to
    `ngrams` words, in buckets by crc32. The score adds Gumbel noise, made from seed and id, to the weight; the highest scores
    among documents of `min_words` or more are drawn, `percent` of these documents, and numbered from 1 (others: null).

    A null text has no words; a null doc_id is spelled as an empty one for the noise, and is last in a tie; repeated rows are
    scored alike and ranked one after the other. Empty tables are allowed: without documents there are no rows, without a
    target the shares of it are even. Texts are read twice; between the passes there are `buckets` numbers. Ranks come from
    ranges of (score, doc_id), none of which has to hold more than its part of the documents.
    """
    gain = gains(bucket_counts(docs, buckets, ngrams), bucket_counts(target, buckets, ngrams))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("long") + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = saved(weighed(docs, gain, ngrams).withColumn("score", F.col("weight") + noise))
    fit = F.col("n_words") >= min_words
    drawn = percent * scored.where(fit).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("n_features"), F.col("n_words")]
    numbered = ranked(scored.where(fit).withColumn("all", F.lit(0)), "all", order).drop("all")
    rank = F.when(F.col("rank") < drawn, F.col("rank").cast("long") + 1)
    return numbered.withColumn("rank", rank).unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))
