import random

import numpy as np

from codedframes.llm import toxicity as T


def corpus(n=400):
    rng, bad = random.Random(4), ["vile", "wretched", "rotten"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(["sun", "tree", "road", "house", "water", "bread"]) + str(rng.randrange(9)) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(40)], words[0] = rng.choice(bad) + "ly", rng.choice(bad)
        docs.append((i, " ".join(words), "x", "y"))
        labels.append((i, i % 3 % 2, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_edges(spark):
    docs, labels = corpus()
    docs += [(1000, None, "x", "y"), (1001, "", "x", "y"), (None, "you vile rotten thing", "x", "y"), (1002, "sun1 " * 20000, "x", "y"), docs[0]]
    frame = spark.createDataFrame(docs, "doc_id long, text string, severity string, grade string")
    known = spark.createDataFrame([r for r in labels if r[0] % 2] + [r for r in labels if r[0] % 4 == 0] + [(3, 1, None), (None, 1, 1)],
                                  "doc_id long, quality int, toxic int")
    model = T.fit(frame, known)
    found = {r["doc_id"]: r for r in T.score(frame, model).collect()}
    held = [r for r in labels if r[0] % 4 == 2]
    assert np.mean([found[i]["rejected"] == bool(t) for i, _, t in held]) > 0.95
    assert not any(found[i]["rejected"] for i in (1000, 1001, 1002)) and found[None]["rejected"]
    assert all(0 <= r["severity"] <= 2 for r in found.values())
    kept = T.accepted(frame, model)
    assert kept.columns == frame.columns and kept.count() == sum(not r["rejected"] for r in T.score(frame, model).collect())


def test_no_labels_and_no_documents(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = T.fit(frame, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert not T.score(frame, model).first()["rejected"] and T.score(frame.limit(0), model).count() == 0


def test_thresholds_share_weights_and_stay_in_order():
    rows = [np.array([i % 3]) for i in range(90)]
    grades = np.array([i % 3 for i in range(90)])
    weights, cuts = T.fit_ordinal(rows, grades, 3, 3)
    assert weights[0] < weights[1] < weights[2] and cuts[0] < cuts[1]
