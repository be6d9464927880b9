"""What has to hold for many columns, long codings and large files: sizes of plans, and the same results on every way."""

import random

import pytest
from pyspark.sql import functions as F

from codedframes.operators import casts as C
from codedframes.operators import joins, order, profile
from codedframes.operators.decode import decode_columns
from codedframes.operators.types import category_lists, type_map
from codedframes.plans import typed
from codedframes.plans.typed import cast_extract, plan_columns
from codedframes.sources.dictionary import describe_dictionary
from codedframes.sources.extract import scan_extract

KINDS = {
    "eid": ("Sequence", None), "1": ("Integer", None), "2": ("Continuous", None), "3": ("Text", None), "4": ("Date", None), "5": ("Time", None),
    "6": ("Categorical (single)", ("60", "Integer")), "7": ("Categorical (single)", ("70", "String")), "8": ("Categorical (single)", ("80", "ERROR")),
}
CODES = {"60": [str(i) for i in range(-20, 60)] + ["1e3"], "70": ["A", "it's", "b\\c", "é", "NA"] + [f"w{i}" for i in range(30)],
         "80": ["1900-01-01", "1903-03-03"]}
CELLS = {"1": ["1", "NA", "", "2.0", "-7"], "2": ["1.5", "inf", "1e3", ""], "3": ["café", "None", "x y", ""], "4": ["2020-01-31", "2020-1-5", ""],
         "5": ["2020-01-31 10:11:12", ""], "6": ["1", "1.0", "-20", "99", "1000", "1d", "", "NaN"], "7": ["A", "it's", "b\\c", "é", "NA", "w7", "none"],
         "8": ["1900-01-01", "1903-3-3", "1903-03-03", "1904-01-01", ""]}


def book(spark, names):
    def text(kind):
        if kind[1] is None:
            return "x"
        number, values = kind[1]
        return f"x Uses data-coding {number} comprises {len(CODES[number])} {values}-valued members in a simple list."

    rows = [(str(i), n, "0", KINDS[n.split("-")[0]][0], text(KINDS[n.split("-")[0]])) for i, n in enumerate(names)]
    dictionary = describe_dictionary(spark.createDataFrame(rows, "Column string, UDI string, Count string, Type string, Description string"))
    codes = [(i, n, code, f"{code}!", None, None, False) for i, of in CODES.items() for n, code in enumerate(of)]
    return dictionary, spark.createDataFrame(
        codes, "encoding_id string, pos bigint, code string, meaning string, parent_id string, selectable string, is_hierarchical boolean")


@pytest.fixture(scope="module")
def wide(spark):
    """110 columns of all kinds; each column's cells in an order of its own."""
    names = ["eid", *[f"{k}-{i}.0" for i in range(13) for k in "12345678"], *[f"6-{i}.1" for i in range(5)]]
    rng = random.Random(2)
    rows = [tuple(str(r) if n == "eid" else rng.choice(CELLS[n[0]]) for n in names) for r in range(40)]
    raw = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    dictionary, codes = book(spark, names)
    return raw, plan_columns(spark, names, dictionary, codes, type_map(spark)), codes


@pytest.mark.parametrize("index", [False, True])
@pytest.mark.parametrize("joined", [False, True])
def test_slices_give_what_single_casts_give(wide, index, joined, monkeypatch):
    raw, plan, _ = wide
    if joined:
        plan = typed.ColumnPlan(plan.rows, plan.lists, set(plan.lists), plan.codes)
    monkeypatch.setattr(typed, "WIDE", 10_000)
    single = cast_extract(raw, plan, "windows-1252", index)
    for width in (3, 256):
        monkeypatch.setattr(typed, "WIDE", 0)
        monkeypatch.setattr(typed, "SLICE", width)
        sliced = cast_extract(raw, plan, "windows-1252", index)
        assert sliced.schema == single.schema
        assert sliced.orderBy("eid").collect() == single.orderBy("eid").collect()


@pytest.mark.parametrize("kind", ["Integer", "Continuous"])
def test_closed_lists_read_whole_numbers_first(spark, kind, monkeypatch):
    """Odd spellings give what single casts give, and the array of cells is made in a projection of its own, not in a lambda."""
    names = ["eid", *[f"6-{i}.0" for i in range(120)]]
    dictionary, codes = book(spark, names)
    if kind == "Continuous":
        dictionary = dictionary.withColumn("Description", F.regexp_replace("Description", "Integer-valued", "Continuous-valued"))
    odd = ["5", "-0", "+5", " 5 ", "05", "5.0", "5e0", "5\x7f", "\x7f5", "\x015", "5d", "0x5", "1000", "1e3", "NA", "", "NaN", "inf", "59", "60",
           "9007199254740993", "99999999999999999999", "5.5", None]
    raw = spark.createDataFrame([(str(r), *[c] * 120) for r, c in enumerate(odd)], ", ".join(f"`{n}` string" for n in names))
    plan = plan_columns(spark, names, dictionary, codes, type_map(spark))
    for index in (False, True):
        monkeypatch.setattr(typed, "WIDE", 100)
        sliced = cast_extract(raw, plan, "utf-8", index)
        optimized = sliced._jdf.queryExecution().optimizedPlan().toString()
        assert "__cells_0" in optimized and "transform(array(6-" not in optimized
        monkeypatch.setattr(typed, "WIDE", 10_000)
        assert sliced.orderBy("eid").collect() == cast_extract(raw, plan, "utf-8", index).orderBy("eid").collect()


@pytest.mark.parametrize("column, value, message", [
    ("1-3.0", "1d", "Column 1-3.0: not a number: 1d"), ("4-12.0", "2020-02-31", "Column 4-12.0: not a date"), ("eid", "", "Column eid: missing value")])
def test_slices_name_the_column_of_a_bad_cell(spark, wide, column, value, message):
    raw, plan, _ = wide
    bad = raw.selectExpr(*[f"'{value}' AS `{c}`" if c == column else f"`{c}`" for c in raw.columns])
    with pytest.raises(Exception, match=message):
        cast_extract(bad, plan, "utf-8").collect()


def test_a_shared_list_is_in_the_plan_once_a_slice(spark):
    """500 columns of one coding: the plan's text before optimisation grows with columns and codes, not with their product."""
    names = ["eid", *[f"6-{i}.0" for i in range(500)]]
    dictionary, codes = book(spark, names)
    raw = spark.range(3).selectExpr("string(id) AS eid", *[f"string(id + {i}) AS `{n}`" for i, n in enumerate(names[1:])])
    out = cast_extract(raw, plan_columns(spark, names, dictionary, codes, type_map(spark)), "utf-8")
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        plan = out._jdf.queryExecution().analyzed().treeString()
        assert plan.count("map(") <= 3 * len(CODES["60"]), plan.count("map(")
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    first = out.orderBy("eid").first()
    assert [first[n] for n in names[1:]] == [float(i) if i < 60 else 1000.0 if i == 1000 else None for i in range(500)]


@pytest.mark.parametrize("kind, codes, absent", [
    ("string", ["A", "it's", "b\\c", "", "é", *[f"w{i}" for i in range(300)]], ["a", "w300", "NULL"]),
    ("double", [*map(str, range(-300, 300)), "1.5", "1.25", "1e300", "-1e300"], ["0.5", "300", "1e301"]),
    ("bigint", [*map(str, range(0, 60_000, 100)), str(2**63 - 1), str(-(2**63))], ["1", "60000"]),
])
def test_hashed_lists(spark, kind, codes, absent):
    literals = C.category_literals(codes, kind, "x")
    frame = spark.createDataFrame([(i, c) for i, c in enumerate([*codes, *absent, None])], "i int, c string")
    value = "c" if kind == "string" else f"CAST(c AS {kind})"
    rows = frame.selectExpr("i", f"{C.close_domain(value, literals, kind)} AS kept", f"{value} AS v", f"{C.category_index(value, literals, 'int', kind)} AS n").collect()
    for r in rows:
        known = r["i"] < len(codes)
        assert r["kept"] == (r["v"] if known else None) and r["n"] == (r["i"] if known else None)


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    """Seven coded columns: a third of all cells on one code, others spread, some unknown (one of them often), some missing."""
    path = str(tmp_path_factory.mktemp("facts"))
    columns = [f"IF(id % 3 = 0, 1L, IF(id % 11 = 1, NULL, IF(id % 11 = 2, -5L, IF(id % 11 = 3, -id, (id * {i + 3}) % 500)))) AS k{i}" for i in range(7)]
    spark.range(0, 6000, 1, 4).selectExpr("id", *columns).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def long_codings(spark):
    return spark.range(15_000).selectExpr("string(id % 3) AS encoding_id", "id AS pos", "string(id DIV 3) AS code", "concat('m', id % 3, '-', id DIV 3) AS meaning")


@pytest.mark.parametrize("bound", [0, 250_000, 1 << 26])
def test_seven_long_codings_read_the_facts_once_more(spark, facts, long_codings, bound):
    asked = {f"k{i}": str(i % 3) for i in range(7)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = decode_columns(facts, asked, long_codings, literal_codes=0, max_broadcast_bytes=bound)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert sum("Relation [id#" in line for line in plan.split("\n")) == 1
        physical = out._jdf.queryExecution().executedPlan().toString()
        assert physical.count("SortMergeJoin") == (7 if bound == 0 else 0)
        found = {r["id"]: r for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == 6000
    for r in found.values():
        for i in range(7):
            k = r[f"k{i}"]
            assert r[f"k{i}_meaning"] == (f"m{i % 3}-{k}" if k is not None and 0 <= k < 5000 else None)


def test_settled_rows_are_dealt_out(spark, facts, long_codings):
    """Rows on a frequent code, on a frequent unknown one or without a code don't meet in one task of the shuffled join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = decode_columns(facts, {"k0": "0"}, long_codings, literal_codes=0, max_broadcast_bytes=0)
        parts = [r["count"] for r in out.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
        assert sum(parts) == 6000 and max(parts) < 2400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_numbering_by_ranges(spark):
    frame = spark.range(1000).selectExpr("string(id % 3) AS g", "(id * 37) % 1000 AS pos", "id AS `a.b`")
    rows = order.numbered(frame, ["g"], ["pos"]).collect()
    for g in "012":
        assert [r["place"] for r in sorted((r for r in rows if r["g"] == g), key=lambda r: r["pos"])] == list(range(sum(r["g"] == g for r in rows)))
    assert sorted(r["place"] for r in order.numbered(frame, [], ["pos"]).collect()) == list(range(1000))
    assert order.numbered(frame.where("false"), ["g"], ["pos"]).count() == 0


def test_category_lists_have_no_window_over_a_coding(spark):
    offered = spark.range(1000).selectExpr("'all' AS encoding_id", "id AS pos", "string(id) AS code")
    lists = category_lists(offered, max_codes=300)
    windows = [line for line in lists._jdf.queryExecution().optimizedPlan().toString().split("\n") if "windowspecdefinition" in line]
    assert windows and all("__range" in line for line in windows)
    assert [r["codes"] for r in lists.orderBy("part").collect()] == [[str(i) for i in range(a, min(a + 300, 1000))] for a in range(0, 1000, 300)]


def test_row_index_counts_once_and_moves_no_row(spark, folder):
    path = f"{folder}/many"
    spark.range(0, 5000, 1, 5).selectExpr("string(id) AS a", "repeat('x', 40) AS b").write.option("header", True).option("sep", "\t").csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = scan_extract(spark, path, ["a", "b"], charset="utf-8")
        out = order.with_row_index(scan)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan csv") == 1 and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
        rows = out.collect()
        assert sorted(r["index"] for r in rows) == list(range(5000))
        by_file = [int(r["a"]) for r in sorted(rows, key=lambda r: r["index"])]
        assert all(b == a + 1 for a, b in zip(by_file, by_file[1:]) if (a + 1) % 1000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(Exception, match="split in another way"):
        out.sparkSession.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        try:
            blocks = order.block_offsets(scan)
            kept = blocks.withColumn("__at", blocks["__at"] + 1)
            order.block_offsets, old = lambda _: kept, order.block_offsets
            try:
                order.with_row_index(scan).collect()
            finally:
                order.block_offsets = old
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_profile_of_many_columns(spark, monkeypatch):
    frame = spark.range(50).selectExpr("id", *[f"IF(id % {i + 2} = 0, NULL, id) AS `{i}-0.0`" for i in range(120)], "CAST(NULL AS string) AS none")
    sliced = sorted(map(tuple, profile.profile_columns(frame).collect()))
    monkeypatch.setattr(profile, "WIDE", 10_000)
    assert sliced == sorted(map(tuple, profile.profile_columns(frame).collect()))
    assert len(sliced) == 122


def test_lookups_share_the_bound(spark):
    """Lookups that fit one by one but not together: the smallest are broadcast, the others go by their used codes."""
    facts = spark.range(100).selectExpr("id", "string(id % 10) AS a", "string(id % 7) AS b")
    lookups = {n: spark.range(1000).selectExpr("string(id) AS code", f"concat('{n}', id) AS value") for n in ("x", "y")}
    asks = [joins.Ask("av", facts["a"], "x"), joins.Ask("bv", facts["b"], "y")]
    out = joins.lookup_columns(facts, asks, lookups, max_broadcast_bytes=60_000)
    assert all(r["av"] == f"x{r['a']}" and r["bv"] == f"y{r['b']}" for r in out.collect()) and out.count() == 100
