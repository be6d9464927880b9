import pytest

from codedframes.llm import urls as U
from codedframes.llm.queries import RULES


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("https://x.org", "x.org", "", None, "allow"),
    ("https://x.org?a=porn", "x.org", "", None, "block"),
    ("https://notexample.org/en/1", "notexample.org", "/en/1", "org/", "allow"),
    ("http://shop.com/de/", "shop.com", "/de/", "com/de/", "block"),
    ("http://cheap-pills.net/", "cheap-pills.net", "/", None, "block"),
    ("http://cheap-cheap.net/", "cheap-cheap.net", "/", None, "allow"),
    ("http://essex.net/sextant", "essex.net", "/sextant", None, "allow"),
    ("no mark", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
])
def test_judgement(spark, url, host, path, rule, verdict):
    frame = spark.createDataFrame([(1, url, "x")], "page_id long, url string, host string")
    r = U.judge(frame, RULES).first()
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)


@pytest.mark.parametrize("url, found", [
    ("http://free-bets.example.com/", {"free", "bet"}), ("http://bet.net/bets/BETS", {"bet"}), ("http://betss.net/", set()),
    ("bets", {"bet"}), ("bet", {"bet"}), ("alphabets", set()), ("http://ads.net", {"ads"}), ("http://win.net/wins2", {"win"}), ("win\u00e9", {"win"}),
])
def test_terms(url, found):
    assert U.Vocabulary(U.VOCABULARY, U.LIMIT).found(url) == found


def test_a_vocabulary_of_weights(spark, monkeypatch):
    schema = "term string, weight int, x int"
    given = [("Lorem", 5, 1), ("ipsum", 3, 1), ("dolor", 2, 1), ("dolor", 1, 1), ("", 9, 1), (None, 9, 1), ("sit", None, 1)]
    weights = U.vocabulary(spark.createDataFrame(given, schema))
    assert weights == {"lorem": 5, "ipsum": 3, "dolor": 2}
    urls = ["http://lorem.net/", "http://ipsum.net/ipsums", "http://ipsum.net/dolor", "http://sit.net/dolor"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    found = {r["page_id"]: (r["verdict"], r["strict_hits"], r["soft_hits"]) for r in U.judge(frame, (), weights, 5).collect()}
    assert found == {0: ("block", 1, 0), 1: ("allow", 0, 1), 2: ("block", 0, 2), 3: ("allow", 0, 1)}
    assert {r["verdict"] for r in U.judge(frame, (), U.vocabulary(spark.createDataFrame([], schema))).collect()} == {"allow"}
    monkeypatch.setattr(U, "MOST_TERMS", 2)
    with pytest.raises(ValueError, match="more than 2"):
        U.vocabulary(spark.createDataFrame(given, schema))


def test_empty_and_long(spark):
    schema = "page_id long, url string"
    assert U.judge(spark.createDataFrame([], schema), RULES).count() == 0
    rows = [(None, "http://a.net/" + "p" * 100_000), (1, "http://a.net/"), (1, "http://a.net/")]
    assert [r["verdict"] for r in U.judge(spark.createDataFrame(rows, schema), RULES).collect()] == ["allow"] * 3
