import bisect
import itertools
import zlib

import numpy as np
import pytest

from codedframes.llm import packing as P


@pytest.mark.parametrize("lengths", [
    [1024] * 3, [1] * 3000, [1000, 24, 1000, 24, 500, 524, 300, 300, 424], [600] * 5 + [400] * 3 + [24] * 2, [],
    list(np.random.default_rng(1).integers(1, 1024, 4000)), list(np.random.default_rng(2).geometric(0.01, 3000).clip(1, 1024)),
])
def test_plan_uses_every_piece_once(lengths):
    counts = {int(x): int((np.array(lengths) == x).sum()) for x in set(lengths)}
    bins = P.plan(dict(counts))
    used = {}
    for parts, n in bins:
        assert sum(parts) <= 1024 and n > 0
        for x in parts:
            used[x] = used.get(x, 0) + n
    assert used == counts
    total, least = sum(n for _, n in bins), -(-sum(map(int, lengths)) // 1024)
    assert total <= max(least * 1.02 + 1, sum(n for x, n in counts.items() if x > 512))


@pytest.mark.parametrize("seed", range(3))
def test_plan_of_uniform_lengths_is_within_two_percent(seed):
    lengths, counts = np.unique(np.random.default_rng(seed).integers(1, 1024, 4000), return_counts=True)
    bins = P.plan(dict(zip(lengths.tolist(), counts.tolist())))
    used = np.zeros(1025, dtype=int)
    for parts, n in bins:
        assert sum(parts) <= 1024
        np.add.at(used, list(parts), n)
    assert np.array_equal(used[lengths], counts) and used.sum() == 4000
    assert sum(n for _, n in bins) <= 1.02 * -(-int((lengths * counts).sum()) // 1024)


def test_sums_follow_the_counts():
    rng, counts = np.random.default_rng(4), {3: 2, 5: 1, 8: 4, 10: 3, 11: 1, 20: 9}
    sums, capacity = P.Sums(counts, 40), 40
    for _ in range(60):
        length = int(rng.choice([3, 5, 8, 10, 11, 20, 30]))
        by = int(rng.integers(-sums.have[length], 4))
        sums.change(length, by)
        there = [x for x in range(41) for _ in range(min(int(sums.have[x]), 3))]
        for size, table in enumerate((sums.one, sums.two, sums.three), 1):
            different = {x for x in itertools.combinations(there, size)}
            assert table.tolist() == [sum(sum(x) == total for x in different) for total in range(capacity + 1)]
        for gap in range(1, capacity + 1):
            fill = sums.complement(gap, capacity)
            exists = any(table[gap] for table in (sums.one, sums.two, sums.three))
            assert bool(fill) == exists
            assert not fill or sum(fill) == gap and all(sums.have[x] >= fill.count(x) for x in fill)


def plain_best_fit(lengths):
    """Bins that best fit alone takes: each piece, longest first, goes into the fullest bin with room for it."""
    gaps = []
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, x)
        left = gaps.pop(at) - x if at < len(gaps) else 1024 - x
        bisect.insort(gaps, left)
    return len(gaps)


@pytest.mark.parametrize("seed", range(4))
def test_complements_take_no_more_bins_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    for lengths in (rng.integers(1, 1024, 2000), rng.integers(200, 700, 2000), rng.geometric(0.005, 2000).clip(1, 1024)):
        kinds, counts = np.unique(lengths, return_counts=True)
        bins = P.plan(dict(zip(kinds.tolist(), counts.tolist())))
        assert sum(n for _, n in bins) <= plain_best_fit(lengths.tolist())


def test_ids_equal_the_tokenizers_library(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r[1] or "" for r in rows] + ["a  b \n\n c's I'LL 12345 ퟿\U0001f600 <|endoftext|>", " \t\r\n\x0b x", "\x00\x1f"]
    for t in texts:
        assert P.token_ids(t, P.vocabulary()) == reference.encode(t, add_special_tokens=False).ids


def test_pieces_and_places(kinds, none, rows):
    assert P.pack(P.pieces(none)).count() == 0
    found = P.pack(P.pieces(kinds, with_ids=True)).collect()
    expected = sorted(str([*P.token_ids(r[1], P.vocabulary()), 2]) for r in rows)
    texts, bins = {}, {}
    for r in found:
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        assert r["length"] == 1024 or r["piece"] == 0
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        texts.setdefault((r["doc_id"], r["piece"]), []).append(r)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    whole = [r["ids"] for r in found if r["start"] == 0 and not texts.get((r["doc_id"], 1))]
    assert all(str(list(x)) in expected for x in whole)
    assert sum(r["length"] for r in found) == sum(len(P.token_ids(r[1], P.vocabulary())) + 1 for r in rows)
