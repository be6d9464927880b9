import numpy as np
import xxhash

from codedframes.llm import simhash as S
from codedframes.llm.components import components


def test_fingerprint_by_bits():
    text = "One two  THREE four\nfive"
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in (b"one two three", b"two three four", b"three four five")]
    expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 3)
    assert S.simhash(text.encode(), 3) == expected
    assert S.simhash(b"One", 3) == xxhash.xxh64_intdigest(b"one", 42) and S.simhash(None, 3) == S.simhash(b" \t", 3) == 0


def test_trie_join_finds_all_near_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    flips = [base ^ (np.uint64(1) << rng.integers(0, 64, 100, dtype=np.uint64)) for _ in range(5)]
    v = np.unique(np.concatenate([base, *flips]))
    expected = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if int(v[i] ^ v[j]).bit_count() <= 3}
    assert {(int(a), int(b)) for i, j in S.near_pairs(v, v, 3) for a, b in zip(i, j)} == expected


def test_classes_match_brute_force(spark, kinds, none, rows, monkeypatch):
    monkeypatch.setattr(S, "PART_LEAST", 4)
    found = S.near_duplicates(kinds).collect()
    assert len(found) == len(rows) and S.near_duplicates(none).count() == 0
    nodes = sorted({r["fingerprint"] for r in found})
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                root[find(a)] = find(b)
    ids = {}
    for r in found:
        if r["doc_id"] is not None:
            c = find(r["fingerprint"])
            ids[c] = min(ids.get(c, r["doc_id"]), r["doc_id"])
    assert all(r["component_id"] == ids.get(find(r["fingerprint"])) for r in found)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
