import pytest

from codedframes.operators import types as R
from codedframes.operators.validate import check_header, header_problems
from codedframes.sources.extract import header_frame

ALL = ["eid", "11-0.0", "13-0.0", "14-0.0", "15-0.0", "16-0.0", "17-0.0", "18-0.0", "19-0.0", "20-0.0", "23-0.0"]


def resolve(spark, dictionary, names, targets="dtype", **options):
    mapping = targets if not isinstance(targets, (str, dict)) else R.type_map(spark, targets)
    return R.resolve_types(header_frame(spark, names), dictionary, mapping, **options)


def as_dict(frame, *columns):
    return {r["udi"]: tuple(r[c] for c in columns) for r in frame.collect()}


@pytest.mark.parametrize("names", [["eid"], ["11-0.0"], ["13-0.0"], ["14-0.0"], ["15-0.0"], ["16-0.0"], ALL])
def test_value_types(spark, dictionary, names):
    expected = {
        "eid": ("regular", "bigint"), "11-0.0": ("categorical", "double"), "13-0.0": ("regular", "double"),
        "14-0.0": ("regular", "string"), "15-0.0": ("regular", "double"), "18-0.0": ("categorical", "double"),
        "19-0.0": ("categorical", "string"), "20-0.0": ("categorical", "double"), "23-0.0": ("categorical", "timestamp_ntz"),
    }
    found = as_dict(R.value_types(resolve(spark, dictionary, names)), "branch", "spark_type")
    assert found == {k: v for k, v in expected.items() if k in names}


def test_date_formats(spark, dictionary):
    found = as_dict(R.date_formats(resolve(spark, dictionary, ALL)), "fmt")
    assert found == {"16-0.0": ("%Y-%m-%d",), "17-0.0": ("%Y-%m-%d %H:%M:%S",)}
    found = as_dict(R.date_formats(resolve(spark, dictionary, ALL, max_categories=1)), "fmt")
    assert found == {"16-0.0": ("%Y-%m-%d",), "17-0.0": ("%Y-%m-%d %H:%M:%S",), "23-0.0": ("%Y-%m-%d",)}


def test_storage_schema(spark, dictionary):
    schema = R.storage_schema(resolve(spark, dictionary, ALL, "nullable"))
    assert schema.names == ALL
    assert [f.dataType.simpleString() for f in schema] == [
        "bigint", "bigint", "bigint", "string", "double", "date", "timestamp_ntz", "bigint", "string", "bigint", "timestamp_ntz",
    ]
    indexed = R.storage_schema(resolve(spark, dictionary, ALL), index_categories=True)
    assert [f.dataType.simpleString() for f in indexed if f.name in ("11-0.0", "19-0.0", "15-0.0")] == ["smallint", "double", "smallint"]
    assert not indexed["eid"].nullable and indexed["15-0.0"].nullable


@pytest.mark.parametrize("size, expected", [
    (2, {"11-0.0": "oversize", "18-0.0": "oversize"}), (20, {"11-0.0": "categorical", "18-0.0": "oversize"}),
    (33, {"11-0.0": "categorical", "18-0.0": "categorical"}),
])
def test_size_threshold_is_inclusive(spark, dictionary, size, expected):
    found = as_dict(resolve(spark, dictionary, list(expected), max_categories=size), "branch")
    assert {k: v[0] for k, v in found.items()} == expected


@pytest.mark.parametrize("members, bits, kind", [
    (1, 8, "smallint"), (256, 8, "smallint"), (257, 16, "int"), (300, 16, "int"), (65536, 16, "int"), (65537, 32, "bigint"), (0, None, None),
])
def test_index_width(spark, members, bits, kind):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(members,)], "n bigint").select(R.index_bits(F.col("n")).alias("b"))
    assert tuple(frame.select("b", R.index_type(F.col("b"))).first()) == (bits, kind)


def test_problems_are_named(spark, dictionary):
    targets = {"Type": {"Integer": "float"}, "Encoding_type": {}}
    twice = dictionary.unionByName(dictionary.where("UDI = '13-0.0'"))
    found = as_dict(resolve(spark, twice, ["13-0.0", "14-0.0", "11-0.0", "zz"], targets), "problem")
    assert found == {
        "13-0.0": ("more than one dictionary row",), "14-0.0": ("no target for type Text",),
        "11-0.0": ("no target for coding type Integer",), "zz": ("not in the dictionary",),
    }
    uncoded = as_dict(resolve(spark, dictionary, ["14-0.0"], categorical_types=["Text"]), "problem")
    assert uncoded == {"14-0.0": ("categorical without coding metadata",)}
    with pytest.raises(ValueError, match="not in the dictionary"):
        R.storage_schema(resolve(spark, dictionary, ["zz"]))


def test_category_lists_in_table_order(spark, dictionary, encodings):
    offered = R.offered_codes(resolve(spark, dictionary, ALL), encodings)
    found = {r["encoding_id"]: r["codes"] for r in R.category_lists(offered).collect()}
    assert found["501"] == ["30", "10", "20", "55", "-7", "40"]
    assert found["77"] == ["501", "502"]
    parts = R.category_lists(offered, max_codes=5).orderBy("encoding_id", "part").collect()
    joined = {i: [c for r in parts if r["encoding_id"] == i for c in r["codes"]] for i in found}
    assert joined == found and max(len(r["codes"]) for r in parts) == 5


def test_required_and_missing_types(spark, dictionary):
    required = {tuple(r) for r in R.required_types(dictionary).collect()}
    assert required == {
        ("Type", "Sequence"), ("Type", "Integer"), ("Type", "Text"), ("Type", "Continuous"), ("Type", "Date"), ("Type", "Time"),
        ("Type", "Compound"), ("Type", "Curve"), ("Encoding_type", "Integer"), ("Encoding_type", "String"), ("Encoding_type", "ERROR"),
    }
    assert R.missing_types(dictionary, R.type_map(spark)).count() == 0
    partial = {"Type": {k: v for k, v in R.DTYPE_TARGETS["Type"].items() if k != "Curve"}, "Encoding_type": {"Integer": "float"}}
    missing = {tuple(r) for r in R.missing_types(dictionary, R.type_map(spark, partial)).collect()}
    assert missing == {("Type", "Curve"), ("Encoding_type", "String"), ("Encoding_type", "ERROR")}


def test_overrides_leave_the_defaults_alone(spark):
    changed = R.override_targets("dtype", {"Type": {"Integer": "string", "New": ["date", "%d/%m/%Y"]}})
    assert changed["Type"]["Integer"] == "string" and R.DTYPE_TARGETS["Type"]["Integer"] == "float"
    rows = {r["source_type"]: (r["target"], r["fmt"]) for r in R.type_map(spark, changed).where("kind = 'Type'").collect()}
    assert rows["New"] == ("date", "%d/%m/%Y") and len(rows) == 9
    assert {r["source_type"] for r in R.date_typed_keys(R.type_map(spark)).collect()} == {"Date", "Time", "ERROR"}
    for bad in ({"Type": {"A": "complex"}}, {"Type": {"A": ["Clock", "%H"]}}, {"Types": {}}):
        with pytest.raises(ValueError):
            R.type_map(spark, bad)


def test_header_validation(spark, dictionary):
    check_header(header_frame(spark, ["eid", "11-0.0"]), dictionary)
    twice = dictionary.unionByName(dictionary.where("UDI = 'eid'"))
    bad = {r["udi"]: r["matches"] for r in header_problems(header_frame(spark, ["eid", "11-0.0", "zz"]), twice).collect()}
    assert bad == {"eid": 2, "zz": 0}
    with pytest.raises(ValueError, match="'zz' is not in the dictionary"):
        check_header(header_frame(spark, ["eid", "zz"]), dictionary)
