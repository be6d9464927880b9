import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from codedframes.llm import importance as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features(text, ngrams=2):
    w = words_of(text)
    return [" ".join(w[i:i + n]) for n in range(1, ngrams + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, buckets, percent, min_words, ngrams=2):
    def counted(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, ngrams))

    s, t = counted(x for _, x in docs), counted(target)
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in range(buckets)]
    out = []
    for doc, text in docs:
        f = features(text, ngrams)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text))])
    fit = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for n, row in enumerate(fit[:percent * len(fit) // 100], 1):
        row[4] = n
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("ngrams", [1, 2, 3])
def test_same_as_brute_force(spark, kinds, rows, ngrams):
    target = [r[1] for r in rows[::5]]
    frame = spark.createDataFrame([(0, t) for t in target], "item_id long, text string")
    found = I.resample(kinds, frame, percent=40, min_words=10, buckets=300, ngrams=ngrams)
    found = sorted((tuple(r) for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)
    assert found == brute([r[:2] for r in rows], target, 300, 40, 10, ngrams)


@pytest.mark.parametrize("ngrams", [1, 2, 3])
@pytest.mark.parametrize("window,chunk", [(1, 3), (40, 7), (500, 1 << 16)])
def test_windows_and_chunks(rows, ngrams, window, chunk, monkeypatch):
    monkeypatch.setattr(I, "WINDOW", window)
    monkeypatch.setattr(I, "CHUNK", chunk)
    texts = [(r[1] or "")[:900] for r in rows]
    found, words = [Counter() for _ in texts], np.zeros(len(texts), dtype=int)
    for table, whose, n_words in I.interned([t.encode() for t in texts], 1000, ngrams):
        words += n_words
        for i, bucket in zip(whose, table.buckets[table.slots]):
            found[i][int(bucket)] += 1
    assert found == [Counter(zlib.crc32(f.encode()) % 1000 for f in features(t, ngrams)) for t in texts]
    assert words.tolist() == [len(words_of(t)) for t in texts]


def test_no_documents_or_no_target(spark, none, kinds):
    assert I.resample(none, kinds).count() == 0
    assert I.resample(kinds, none).where("rank is not null").count() > 0


def test_keys_are_xxh64():
    rng = random.Random(4)
    text = bytes(rng.randrange(256) for _ in range(500))
    start = np.array([rng.randrange(400) for _ in range(400)])
    length = np.array([rng.randrange(70) for _ in range(400)])
    found = I.keys_of(text + bytes(I.PAD), start, length)
    assert [int(x) for x in found] == [xxhash.xxh64_intdigest(text[a:a + n]) for a, n in zip(start, length)]


def test_equal_keys_of_different_strings_get_slots_of_their_own(monkeypatch):
    monkeypatch.setattr(I, "keys_of", lambda text, start, length: np.full(len(start), 5, dtype=np.uint64))
    words = [b"ab", b"cd", b"ab", b"abcdefgh", b"abcdefghi", b"abcdefghx", b"cd", b"ab"]
    text = b" ".join(words)
    length = np.array([len(w) for w in words])
    start = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
    table = I.Interned(text + bytes(I.PAD), start, length, lambda n: n % 7)
    assert len(set(table.slots)) == 5
    assert {w: int(table.counts[s]) for w, s in zip(words, table.slots)} == Counter(words)


def test_crc_of_joined_strings():
    rng = random.Random(5)
    pairs = [tuple(bytes(rng.randrange(256) for _ in range(rng.randrange(40))) for _ in range(2)) for _ in range(200)]
    a, b = (np.array([zlib.crc32(p[i]) for p in pairs], dtype=np.uint32) for i in (0, 1))
    found = I.joined_crc(a, b, np.array([len(y) for _, y in pairs]))
    assert found.tolist() == [zlib.crc32(x + y) for x, y in pairs]
