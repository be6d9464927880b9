import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from codedframes.llm import search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, c, sum(c.values())) for d, c in bags if c]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in set(items):
        found = []
        for d, c, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                for t, times in Counter(terms(text)).items() if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture
def items(rows):
    return [(1, rows[0][1]), (2, rows[1][1]), (3, "No such thing, ABC! the the and of"), (4, None), (5, ""), (None, rows[7][1][-200:]),
            (3, "No such thing, ABC! the the and of"), (6, "É" * 70)]


@pytest.mark.parametrize("shard", [7, 1000])
def test_same_as_brute_force(spark, kinds, rows, items, shard, monkeypatch):
    monkeypatch.setattr(S, "SHARD_DOCS", shard)
    queries = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")
    found = sorted((tuple(r) for r in S.rank(kinds, queries, k=5).collect()), key=repr)
    assert found == brute([r[:2] for r in rows], items, 5)


@pytest.mark.parametrize("shard,span,block", [(7, 4, 3), (13, 5, 1), (60, 16, 2)])
def test_small_spans_and_blocks(rows, items, shard, span, block, monkeypatch):
    """Shards of few documents, scored few at a time, as a task goes through them one after the other."""
    for name, value in (("SPAN", span), ("BLOCK", block)):
        monkeypatch.setattr(S, name, value)
    docs = [(d if d is not None else S.NO_ID, (t or "").encode()) for d, t in (r[:2] for r in rows)]
    wanted = {i: Counter(terms(t)) for i, t in set(items)}
    lists = [[r for batch in S._shard(0, docs[at:at + shard], None) for r in batch.to_pylist()] for at in range(0, len(docs), shard)]
    df = Counter()
    for rows_ in lists:
        for r in rows_:
            df[r["term"]] += r["df"]
    n_terms = sum(r["total"] for rows_ in lists for r in rows_ if r["term"] == "")
    best = {i: (np.zeros(0, dtype=np.int64),) * 2 for i in wanted}
    for rows_ in lists:
        one = S._Shard(rows_[0]["heads"], rows_[0]["postings"], df[""], n_terms)
        one.lists = {r["term"].encode(): S._List(r["heads"], r["postings"], one) for r in rows_[1:]}
        for i, counts in wanted.items():
            best[i] = one.search({t.encode(): n * S.weight(df[""], df[t]) for t, n in counts.items() if t in df}, best[i], 5)
    found = [(i, n, None if d == S.NO_ID else d, s) for i, (scores, ids) in best.items() for n, (s, d) in enumerate(zip(scores.tolist(), ids.tolist()), 1)]
    assert sorted(found, key=repr) == brute([r[:2] for r in rows], items, 5)


def test_whole_index_and_blocks_of_items(spark, kinds, rows, items, monkeypatch):
    monkeypatch.setattr(S, "ITEMS", 2)
    monkeypatch.setattr(S, "TERMS", 3)
    queries = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((tuple(r) for r in S.rank(kinds, queries, k=4).collect()), key=repr)
    assert found == brute([r[:2] for r in rows], items, 4)


def test_empty_tables(spark, none, kinds):
    queries = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert S.rank(none, queries).count() == 0
    assert S.rank(kinds, queries.where("false")).count() == 0


def test_bounds_skip_blocks():
    """A shard whose non-essential list has blocks that no candidate can profit from leaves them packed."""
    rng = random.Random(6)
    lengths = np.full(2000, 50, dtype=np.int32)
    rare = np.array(sorted(rng.sample(range(2000), 40)))
    shard = S._Shard(np.arange(2000, dtype="<i8").tobytes(), lengths.tobytes(), 2000, 100_000)
    shard.lists[b"rare"] = S._List(*S._packed(rare, np.ones(40, dtype=np.int64), lengths), shard)
    shard.lists[b"common"] = S._List(*S._packed(np.arange(2000), np.ones(2000, dtype=np.int64), lengths), shard)
    part = int(shard.lists[b"rare"].bound)
    best = (np.full(3, 5000 * part + 10 * part + 1), np.array([5000, 5001, 5002]))
    found = shard.search({b"rare": 5000, b"common": 10}, best, 3)
    assert found is best or (found[0] == best[0]).all()
    assert not shard.lists[b"common"].open.any()


def test_packed_lists_round_trip():
    rng = random.Random(7)
    docs = np.array(sorted(rng.sample(range(200_000), 3000)))
    tf = np.array([rng.choice([1, 2, 300, 70_000]) for _ in docs])
    lengths = np.full(200_000, 100_000, dtype=np.int32)
    shard = S._Shard(np.arange(200_000, dtype="<i8").tobytes(), lengths.tobytes(), 200_000, 200_000 * 100_000)
    one = S._List(*S._packed(docs, tf, lengths), shard)
    one.unpack(np.arange(len(one.heads)))
    assert (one.docs == docs).all()
    assert (one.scores == shard.parts(tf, shard.lengths[docs])).all()
    assert all(one.bounds[i // S.BLOCK] >= one.scores[i] for i in range(len(docs)))
