import random

import pytest
from pyspark.sql import functions as F

from codedframes.llm import line_dedup as L


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute(rows):
    lines = [(d, n, x) for d, t in rows if t is not None for n, x in enumerate(t.split("\n")) if x.strip()]
    kinds = sorted({x for _, _, x in lines})
    root = {x: x for x in kinds}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if min(len(a), len(b)) >= L.LEAST and one_edit(a, b):
                root[find(a)] = find(b)
    first = {}
    for d, n, x in sorted(lines):
        first.setdefault(find(x), (d, n))
    return {d: [n for e, n, x in lines if e == d and first[find(x)] != (d, n)] for d, _ in rows}


def sample():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcde é") for _ in range(rng.randint(16, 40))) for _ in range(20)]
    rows = []
    for d in range(50):
        t = []
        for _ in range(rng.randint(0, 6)):
            x = rng.choice(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                i = rng.randrange(len(x) + 1)
                x = x[:i] + rng.choice(["", "z", "y"]) + x[i + rng.choice([0, 1]):]
            t.append(x)
        if d % 2:
            t.append("common start of a very frequent line " + rng.choice("abc") * rng.randint(1, 3) + rng.choice(["", "xyz"]))
        t += [""] * (d % 7 == 0)
        rows.append((d, "\n".join(t)))
    return [*rows, (60, None), (61, ""), (62, " \n\t"), (63, "w" * 50_000)]


@pytest.mark.parametrize("paired", [8, 2])
def test_same_as_brute_force(spark, monkeypatch, paired):
    monkeypatch.setattr(L, "PAIRED", paired)
    rows = sample()
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS no", "'x' AS line", "2 AS hash", "3 AS removed")
    found = {r["doc_id"]: r for r in L.dedup_lines(frame, carry=("line", "removed")).collect()}
    expected = brute(rows)
    for d, t in rows:
        assert list(found[d]["removed"]) == expected[d] and found[d]["n_removed"] == len(expected[d])
        assert found[d]["text"] == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in expected[d]))
        assert tuple(found[d]["carried"]) == ("x", 3)


def test_repeated_rows_and_empty_table(spark, kinds, none, rows):
    found = L.dedup_lines(kinds).collect()
    assert len(found) == len(rows) and L.dedup_lines(none).count() == 0
    twice = [r for r in found if r["doc_id"] == rows[7][0] and r["text"] is not None]
    assert len({(r["key"], r["text"]) for r in twice}) == len({r["key"] for r in twice})


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_longer_lines_take_more_edits(spark, monkeypatch):
    """Lines of 60 to 160 characters against brute force: in small groups, in blocks of large ones, and across the bounds."""
    rng = random.Random(8)

    def changed(x, n):
        for _ in range(n):
            i = rng.randrange(len(x) + 1)
            x = x[:i] + rng.choice(["", "z", "y"]) + x[i + rng.choice([0, 1]):]
        return x

    kinds = []
    for n in (61, 62, 63, 64, 65, 66, 79, 80, 81, 96, 126, 127, 128, 129, 130, 131, 145, 160):
        base = "".join(rng.choice("abcdef é") for _ in range(n))
        kinds += [base, *(changed(base, k) for k in (1, 2, 2, 3, 3, 4))]
    start, end = "a start that many lines have in common, up to here and no more ", " and an end that many of them have as well"
    kinds += [start + "".join(rng.choice("ab") for _ in range(9)) + end[:rng.randint(30, 42)] for _ in range(60)]
    kinds = sorted(set(kinds))
    expected = {x: x for x in kinds}

    def find(x):
        while expected[x] != x:
            x = expected[x]
        return x

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            least = min(len(a), len(b))
            most = 3 if least >= 128 else 2 if least >= 64 else 1
            if abs(len(a) - len(b)) <= most and find(a) != find(b) and edits(a, b) <= most:
                expected[find(a)] = find(b)
    classes = {}
    for x in kinds:
        classes.setdefault(find(x), set()).add(x)
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(kinds)], "doc_id long, text string")
    for paired, block in ((8, 512), (2, 7)):
        monkeypatch.setattr(L, "PAIRED", paired)
        monkeypatch.setattr(L, "BLOCK", block)
        kept = {r["doc_id"] for r in L.dedup_lines(frame).collect() if not r["n_removed"]}
        assert kept == {min(kinds.index(x) for x in c) for c in classes.values()}
    assert 20 < len(classes) < len(kinds) / 2


def test_marks_allow_all_lines_within_the_edits(spark):
    """Lines whose edits are within the bound are never told apart by their marks; others of equal length mostly are."""
    rng = random.Random(11)
    rows = []
    for i in range(200):
        a = "".join(rng.choice("abcdefghi é€😀") for _ in range(rng.randint(20, 200)))
        b = a
        for _ in range(rng.choice([1, 2, 3])):
            at = rng.randrange(len(b) + 1)
            b = b[:at] + rng.choice(["", "z", "😀"]) + b[at + rng.choice([0, 1]):]
        other = "".join(rng.sample(a, len(a)))
        rows.append((i, a, b, other, edits(a, b)))
    frame = spark.createDataFrame(rows, "i int, a string, b string, other string, edits int")
    marks = frame.select("edits", L._marks("a").alias("marks_a"), L._marks("b").alias("marks_b"), L._marks("other").alias("marks_o"))
    found = marks.select(L._may_be(F.col("edits")).alias("near")).collect()
    assert all(r["near"] for r in found)
    far = marks.drop("marks_b").withColumnRenamed("marks_o", "marks_b").select(L._may_be(F.lit(3)).alias("near")).collect()
    assert sum(r["near"] for r in far) < 60


def test_links_are_sought_in_the_table_of_lines(spark, monkeypatch):
    """No step that looks for links splits the documents again."""
    made, lines_of = [], L._lines
    monkeypatch.setattr(L, "_lines", lambda *a: made.append(a) or lines_of(*a))
    edges, read = L.near_edges, []
    monkeypatch.setattr(L, "near_edges", lambda lines: read.append(lines) or edges(lines))
    frame = spark.createDataFrame([(i, "one common line of many characters\n" + f"line {i} of its own, and no more") for i in range(300)],
                                  "doc_id long, text string")
    assert sum(r["n_removed"] for r in L.dedup_lines(frame).collect()) >= 299
    plan = read[0]._jdf.queryExecution().optimizedPlan().toString()
    assert len(made) == 1 and "Generate" not in plan and "parquet" in plan


def test_large_groups_take_few_tables(spark, monkeypatch):
    """One edit in a large group is found in a few steps, however long the part is that is known to hold it."""
    rng = random.Random(13)
    base = "".join(rng.choice("abcdefgh") for _ in range(60))
    kinds = {base[:i] + x + base[i + skip:] for i in range(60) for x in "xy" for skip in (0, 1)} | {"".join(rng.sample(base, 60)) for _ in range(20)}
    kinds = sorted(kinds | {base} | {base[:i] + "zz" + base[i:] for i in (3, 30, 59)} | {base[:i] + base[i + 1:] for i in (0, 29, 59)})
    root = {x: x for x in kinds}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if one_edit(a, b):
                root[find(a)] = find(b)
    lines = spark.createDataFrame([(x,) for x in kinds], "line string").select(F.xxhash64("line").alias("hash"), "line")
    hashes, made, save = {r["line"]: r["hash"] for r in lines.collect()}, [], L.saved
    monkeypatch.setattr(L, "saved", lambda frame: made.append(1) or save(frame))
    for places, most in ((L.PLACES, 4), (2, 9)):
        monkeypatch.setattr(L, "PLACES", places)
        made.clear()
        edges = L._one_edit_edges(lines)
        assert len(made) <= most
        text = {h: x for x, h in hashes.items()}
        links = [(text[r["a"]], text[r["b"]]) for r in edges.collect()]
        assert all(one_edit(a, b) for a, b in links)
        assert len({tuple(sorted(x)) for x in links}) < len(kinds) * len(kinds) / 8
        to = {x: x for x in kinds}

        def end(x, to=to):
            while to[x] != x:
                x = to[x]
            return x

        for a, b in links:
            to[end(a)] = end(b)
        assert len({(find(x), end(x)) for x in kinds}) == len({find(x) for x in kinds}) == len({end(x) for x in kinds})


def test_components_end_with_stars(spark, monkeypatch):
    """A graph of stars is known as such, without another round over it."""
    from codedframes.llm import components as C

    made, save = [], C.saved
    monkeypatch.setattr(C, "saved", lambda frame: made.append(1) or save(frame))
    edges = spark.createDataFrame([(9, 1), (1, 8), (7, 2), (2, 2), (None, 3)], "a long, b long")
    assert {tuple(r) for r in C.components(edges).collect()} == {(1, 1), (8, 1), (9, 1), (2, 2), (7, 2)} and len(made) == 2
    path = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(5, 77)], "a long, b long")
    assert {tuple(r) for r in C.components(path).collect()} == {(i, 0) for i in [*range(41), 77]}
