import hashlib

from pyspark.sql import functions as F

from codedframes.llm import fingerprints as P


def shingles(text):
    words = (text or "").lower().encode().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_edited_texts_and_likeness(spark, rows):
    docs = [(i, r[1]) for i, r in enumerate(rows)]
    frame = P.edited_pairs(spark.createDataFrame(docs, "doc_id long, text string"))
    near = P.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near")
    found = {r["doc_id"]: r for r in frame.select("*", near).collect()}
    texts = [t or "" for _, t in docs]
    for i, t in enumerate(texts):
        after, half = texts[i - 1], len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        assert (found[i]["n_chars"], found[i]["edited_text"]) == (len(t), edited)
        a, b = shingles(t), shingles(edited)
        exact = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(found[i]["near"] - exact) < (0.2 if len(a | b) > P.K else 1e-9)


def test_order_of_null_and_equal_ids(spark, kinds, none):
    assert P.edited_pairs(none).count() == 0
    assert P.edited_pairs(kinds).count() == kinds.count()
    one = P.edited_pairs(spark.createDataFrame([(1, "a b")], "doc_id long, text string")).first()
    assert one["edited_text"] == "a a"


def test_sketches_merge_and_estimate(spark):
    texts = [" ".join(f"w{i}" for i in range(a, b)) for a, b in ((0, 900), (300, 1200))]
    frame = spark.createDataFrame([(1, texts[0], texts[1])], "id int, a string, b string").select(
        "id", P.sketch(F.col("a")).alias("a"), P.sketch(F.col("b")).alias("b"))
    r = frame.select(P.resemblance(F.col("a"), F.col("b")), P.containment(F.col("a"), F.col("b")), P.distinct_shingles(F.col("a"))).first()
    assert abs(r[0] - 596 / 1196) < 0.15 and abs(r[1] - 596 / 896) < 0.2 and abs(r[2] / 896 - 1) < 0.3
    parts = frame.select("id", F.explode(F.array("a", "b")).alias("s"))
    assert P.merged(parts, "id", "s").first()["s"] == frame.select(P.merge(F.col("a"), F.col("b"))).first()[0]
    assert len(hashlib.sha256(b"").hexdigest()) == 64
