import pytest

from codedframes.operators import joins
from codedframes.operators.decode import decode_columns


@pytest.fixture(scope="module")
def coded(spark):
    rows = [(i, float(i % 7) if i % 5 else None, "A" if i % 3 else "odd") for i in range(300)]
    return spark.createDataFrame(rows, "id int, `1-0.0` double, `2-0.0` string")


@pytest.fixture(scope="module")
def lists(spark):
    rows = [("n", 1, "1", "one"), ("n", 2, "2.0", "two"), ("n", 3, "1.0", "one again"), ("n", 4, "x", "no number"), ("t", 1, "A", "it's \\A")]
    return spark.createDataFrame(rows, "encoding_id string, pos bigint, code string, meaning string")


@pytest.mark.parametrize("options", [
    {}, {"literal_codes": 0}, {"literal_codes": 0, "max_broadcast_bytes": 0},
])
def test_every_way_gives_the_same_meanings(coded, lists, options):
    out = decode_columns(coded, {"1-0.0": "n", "2-0.0": "t"}, lists, **options)
    assert out.columns == ["id", "1-0.0", "2-0.0", "1-0.0_meaning", "2-0.0_meaning"]
    names = {1.0: "one", 2.0: "two"}
    found = sorted(tuple(r) for r in out.collect())
    assert found == sorted(
        (r[0], r[1], r[2], names.get(r[1]), "it's \\A" if r[2] == "A" else None) for r in map(tuple, coded.collect())
    )


def test_large_lookup_keeps_hot_rows_in_place(spark):
    facts = spark.range(30000).selectExpr("id", "IF(id % 3 = 0, 1L, IF(id % 50 = 1, NULL, id)) AS k")
    lookup = spark.range(0, 30000, 2).selectExpr("id + 1 AS k", "concat('m', id + 1) AS m")
    assert joins.hot_keys(facts, "k") == [1]
    out = joins.lookup_join(facts, lookup, "k", max_broadcast_bytes=0)
    expected = facts.join(lookup, "k", "left")
    assert out.count() == 30000
    assert out.exceptAll(expected.select(*out.columns)).count() == 0


def test_measured_size(spark):
    assert joins.measured_bytes(spark.range(0)) == 0
    assert joins.measured_bytes(spark.range(10).selectExpr("id", "repeat('x', 100) AS `a.b`")) >= 1000


def test_unknown_coding_has_no_meanings(coded, lists):
    out = decode_columns(coded, {"1-0.0": "absent"}, lists)
    assert out.where("`1-0.0_meaning` IS NOT NULL").count() == 0


@pytest.mark.parametrize("options", [{}, {"literal_codes": 0}])
def test_long_whole_numbers_stay_apart(spark, options):
    big = 2**53
    codes = [("w", 1, str(big), "even"), ("w", 2, str(big + 1), "odd"), ("w", 3, "3.0", "three"), ("w", 4, "3.5", "none")]
    lists = spark.createDataFrame(codes, "encoding_id string, pos bigint, code string, meaning string")
    frame = spark.createDataFrame([(big,), (big + 1,), (3,), (4,)], "c bigint")
    found = {r["c"]: r["c_meaning"] for r in decode_columns(frame, {"c": "w"}, lists, **options).collect()}
    assert found == {big: "even", big + 1: "odd", 3: "three", 4: None}


@pytest.fixture(scope="module")
def typed_codes(spark):
    rows = [("p", 1, "5", "five"), ("p", 2, "7.0", "seven"), ("p", 3, "5.0", "five again"), ("d", 1, "1900-01-01", "unknown"),
            ("d", 2, "1901-01-01", "not asked"), ("q", 1, "b", "bee"), ("q", 2, "a", "ay")]
    frame = spark.createDataFrame(rows, "encoding_id string, pos bigint, code string, meaning string")
    return frame.selectExpr("*", "CAST(NULL AS string) AS parent_id", "CAST(NULL AS string) AS selectable", "false AS is_hierarchical")


@pytest.mark.parametrize("options", [{}, {"literal_codes": 0}, {"literal_codes": 0, "max_broadcast_bytes": 0}])
@pytest.mark.parametrize("index", [False, True])
def test_typed_columns_say_how_codes_are_stored(spark, typed_codes, options, index):
    from codedframes.operators.types import type_map
    from codedframes.plans.typed import cast_extract, plan_columns
    from codedframes.sources.dictionary import describe_dictionary

    kinds = (("1-0.0", "p", 3, "Integer"), ("2-0.0", "d", 2, "ERROR"), ("3-0.0", "q", 2, "String"))
    dictionary = describe_dictionary(spark.createDataFrame(
        [(str(n), udi, "0", "Categorical (single)", f"x Uses data-coding {9 + n} comprises {m} {kind}-valued members in a simple list.")
         for n, (udi, _, m, kind) in enumerate(kinds)],
        "Column string, UDI string, Count string, Type string, Description string"))
    numbers = {"p": "9", "d": "10", "q": "11"}
    codes = typed_codes.replace(numbers, subset=["encoding_id"])
    raw = spark.createDataFrame([("5", "1900-01-01", "a"), ("7", "1901-01-01", "b"), ("8", "1902-01-01", None)],
                                "`1-0.0` string, `2-0.0` string, `3-0.0` string")
    plan = plan_columns(spark, raw.columns, dictionary, codes, type_map(spark))
    typed = cast_extract(raw, plan, "utf-8", index_categories=index)
    out = decode_columns(typed, {udi: numbers[i] for udi, i, _, _ in kinds}, codes, **options)
    found = sorted(tuple(r) for r in out.select("`1-0.0_meaning`", "`2-0.0_meaning`", "`3-0.0_meaning`").collect() if r[0])
    assert found == [("five", "unknown", "ay"), ("seven", "not asked", "bee")]
    assert out.where("`1-0.0_meaning` IS NULL AND `2-0.0_meaning` IS NULL AND `3-0.0_meaning` IS NULL").count() == 1


def test_many_columns_of_one_coding_need_one_lookup(spark, lists):
    frame = spark.range(20).selectExpr(*[f"double(id % 3) AS `{i}-0.0`" for i in range(12)])
    names = {c: "n" for c in frame.columns}
    tracker = spark.sparkContext.statusTracker()

    def jobs(columns):
        spark.sparkContext.setJobGroup(f"decode {len(columns)}", "decode")
        decode_columns(frame, columns, lists, literal_codes=0)
        return len(tracker.getJobIdsForGroup(f"decode {len(columns)}"))

    assert jobs(names) == jobs(dict(list(names.items())[:1]))


def test_hot_rows_and_rows_without_a_key_are_not_shuffled(spark):
    facts = spark.range(0, 20000, 1, 4).selectExpr("IF(id % 3 = 0, 1L, IF(id % 7 = 1, NULL, id)) AS k")
    lookup = spark.range(20000).selectExpr("id AS k", "concat('m', id) AS m")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.lookup_join(facts, lookup, "k", max_broadcast_bytes=0)
        parts = out.where("k IS NULL OR k = 1").selectExpr("spark_partition_id() AS p").distinct().count()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert parts >= 4 and "SortMergeJoin" in plan and out.count() == 20000
        assert out.where("k = 1 AND m = 'm1'").count() == facts.where("k = 1").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
