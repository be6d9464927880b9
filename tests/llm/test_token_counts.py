import pytest

from codedframes.llm import token_counts as T

public_tokenizers = pytest.importorskip("public_tokenizers")

ODD = ["a\x0bb\x1cc\x85d", "á ́b", "ΑΣ ΑΣ. Σ", "it's 'sx x's", "<|endoftext|>a<|ENDOFTEXT|> <|startoftext|>", "ﬁ Å İstanbul", "​ x",
       "1 234", "😀 👩‍👧 x", " ", "word " * 30, "y" * 5000, "\x00 a\x00b"]


def whole(text):
    return T.lengths([(text or "").encode()], T.vocabulary())[0]


@pytest.mark.parametrize("cache,table", [(-T.TABLE, 8), (T.CACHE, T.TABLE)])
def test_same_as_the_library_on_whole_texts(spark, rows, cache, table, monkeypatch):
    for name, value in (("CACHE", cache), ("TABLE", table)):
        monkeypatch.setattr(T, name, value)
    given = [r[:2] for r in rows] + [(1000 + i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame([(*r, 1) for r in given], "doc_id long, text string, n_tokens int").repartition(2)
    found = sorted((tuple(r) for r in T.token_counts(docs, limit=100).collect()), key=repr)
    assert found == sorted(((d, len((t or "").encode()), n, n > 100) for d, t in given for n in [whole(t)]), key=repr)


def test_sentencepiece_takes_whole_texts(spark, rows):
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD[:4])], "doc_id long, text string")
    found = {r["doc_id"]: r["n_tokens"] for r in T.token_counts(docs, path).collect()}
    assert found == {i: T.lengths([t.encode()], path)[0] for i, t in enumerate(ODD[:4])}


@pytest.mark.parametrize("window", [1, 30, 1000])
def test_windows(rows, window, monkeypatch):
    monkeypatch.setattr(T, "WINDOW", window)
    texts = [(r[1] or "").encode() for r in rows] + [t.encode() for t in ODD]
    found = [[] for _ in texts]
    for owners, windows in T._grouped(texts):
        for i, pieces in zip(owners, windows, strict=True):
            found[i] += pieces
    assert found == [t.split() for t in texts]


def test_empty(spark, none):
    assert T.token_counts(none).count() == 0


def test_frequent_tier_is_bounded(spark, kinds):
    pieces, tokens = T.frequent(kinds, T.vocabulary(), size=16)
    assert len(tokens) <= 16 and len(pieces.split(b"\n")) == len(tokens)
    assert list(tokens) == T.lengths(pieces.split(b"\n"), T.vocabulary())
