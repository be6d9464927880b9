import random

import numpy as np
import pytest

from codedframes.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score long"


def brute(rows, k, every):
    good = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % every == 0:
            scores = sorted((-int(a @ b), i) for i, b in good if i != q and len(b) == len(a))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def test_same_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 16)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(90)]
    rows += [(200 + i, [0.5] * 8) for i in range(40)] + [(300, None), (320, [1.0] * 7 + [None]), (340, [float("nan")] * 8), (None, [1.0] * 8)]
    rows += [(360, [1.0, 2.0]), (361, [2.0, 1.0]), (380, [0.0] * 8), (400, [1e3] * 8), (420, [3.0] * 5), (500, []), (501, []), (520, [])]
    frame = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows], SCHEMA).repartition(3)
    found = sorted(tuple(r) for r in K.top_k(frame, k=5, every=20).collect())
    assert found == brute(rows, 5, 20)


@pytest.mark.parametrize("rows", [[(1, [1e17, 1.0])], [(20, [3e9] * 4), (21, [3e9] * 4)]])
def test_scores_beyond_64_bits_are_refused(spark, rows):
    with pytest.raises(Exception, match="fit 64 bits"):
        K.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()


def test_empty(spark):
    assert K.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
