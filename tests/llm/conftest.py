import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, hash string, rank int, count int, line string"


def prose(rng, n, words="ab cde fgh ij klmn opq rs tuv wx yz the of and to in is".split()):
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))


def rows_of_all_kinds():
    """Texts with copies, near copies, shared lines and passages; nulls, empty and blank texts; repeated rows and ids."""
    rng = random.Random(3)
    base, passage = [prose(rng, 120) for _ in range(6)], prose(rng, 60)
    texts = []
    for i in range(40):
        t = base[i % 6] if i % 4 == 0 else prose(rng, rng.choice([3, 30, 150]))
        if i % 5 == 0:
            w = t.split(" ")
            w[len(w) // 2] = f"edit{i}"
            t = " ".join(w)
        if i % 7 == 0:
            t = prose(rng, 20) + "\n" + passage + "\n" + prose(rng, 20)
        texts.append(t)
    texts += ["", " \t\n", None, None, "one", "É" * 70 + " ünï €", "x" * 3000, "<|endoftext|> mark <|endoftext|>", prose(rng, 6000)]
    rows = [(i, t, "en", [None, "a", "b", "é", "A"][i % 5], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[7], (None, base[1], None, None, None), (None, None, None, None, None), (5, prose(rng, 80), "en", "a", 1)]
    return [(*r, "k", "h", 1, 2, "l") for r in rows]


@pytest.fixture(scope="session")
def kinds(spark):
    return spark.createDataFrame(rows_of_all_kinds(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return rows_of_all_kinds()
