from collections import Counter

import pytest

from codedframes.llm import mixing as M


def test_targets_are_capped_and_shared_again():
    found = M.targets([(None, 100), ("b", 10), ("a", 1000), ("é", 50)])
    assert [r[0] for r in found] == ["a", "b", "é", None]
    assert sum(t for _, _, t in found) == pytest.approx(1.5 * 1160)
    assert all(t <= 2 * s for _, s, t in found)
    free = [(t / w, s) for (_, s, t), w in zip(found, (5, 2, 1, 5)) if t < 2 * s]
    assert max(r for r, _ in free) == pytest.approx(min(r for r, _ in free))
    assert M.targets([("a", 0), (None, 0)]) == [("a", 0, 0.0), (None, 0, 0.0)]


def test_every_row_is_taken_near_its_target(kinds, none, rows):
    found = M.mix(kinds).collect()
    assert len(found) == len(rows) and M.mix(none).count() == 0
    for source in {r["source"] for r in found}:
        own = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
        assert all(r["taken"] <= 2 * r["size"] for r in own)
    assert sorted(map(str, found)) == sorted(map(str, M.mix(kinds).collect()))
    out = M.mixed(kinds)
    assert out.columns == kinds.columns
    assert Counter(r["text"] for r in out.collect()) == Counter(
        t for t, n in ((rows_text(rows, r), r["copies"]) for r in found) for _ in range(n))


def rows_text(rows, r):
    import xxhash  # noqa: F401

    near = [x[1] for x in rows if x[0] == r["doc_id"] and len((x[1] or "").encode().split()) == r["size"]]
    return near[0]
