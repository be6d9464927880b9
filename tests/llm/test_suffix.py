import random
from collections import Counter

import numpy as np
import pytest

from codedframes.llm import suffix as S


def brute(texts):
    seen = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((bytes(np.frombuffer(t, np.uint8)[~gone]), len(t), int(gone.sum()), spans))
    return out


@pytest.mark.parametrize("least, share, chunk", [(256, 500, 20_000), (1, 10**9, 50)])
def test_same_as_brute_force(spark, monkeypatch, least, share, chunk):
    for name, value in (("HOT_LEAST", least), ("HOT_SHARE", share), ("CHUNK", chunk)):
        monkeypatch.setattr(S, name, value)
    rng = random.Random(6)

    def noise(n):
        return "".join(rng.choice("abcdé ") for _ in range(n))

    common, short = noise(260), noise(120)
    texts = []
    for i in range(30):
        a, b = rng.randrange(0, 60), rng.randrange(200, 261)
        texts.append(noise(rng.randrange(0, 300)) + common[a:b] + noise(rng.randrange(0, 200)) + short + noise(100))
    texts += [texts[0], texts[3], "z" * 700, "", None, "ab" * 150, noise(199), noise(5000), noise(50) + "z" * 300]
    frame = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, key string").repartition(3)
    found = {r["doc_id"]: r for r in S.remove_repeats(frame).collect()}
    for i, (kept, n, removed, spans) in enumerate(brute([(t or "").encode() for t in texts])):
        r = found[i]
        assert (bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) == (kept, n, removed, spans)


def test_edges(kinds, none, rows):
    assert S.remove_repeats(none).count() == 0
    assert S.remove_repeats(kinds).count() == len(rows)
