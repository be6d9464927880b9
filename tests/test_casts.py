import datetime

import pytest

from codedframes.functions.fixed import NA_TOKENS
from codedframes.functions.text import spark_pattern
from codedframes.operators import casts as C


def run(spark, expression, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r["x"] for r in frame.selectExpr("i", f"{expression} AS x").orderBy("i").collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = ["1.5", " 1.5 ", "1e3", ".5", "5.", "+1", "inf", "-Inf", "Infinity", "007", None, *NA_TOKENS]
        inf = float("inf")
        assert run(spark, C.to_double("x", "c"), good) == [1.5, 1.5, 1000.0, 0.5, 5.0, 1.0, inf, -inf, inf, 7.0, None] + [None] * len(NA_TOKENS)
        for bad in ("1d", "1f", "1D", "1.5F", "NAN", "abc", "1,5", "0x10", "1 2", "1e"):
            with pytest.raises(Exception, match="Column x: not a number"):
                run(spark, C.to_double("x", "c"), [bad])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_whole_numbers(spark):
    assert run(spark, C.to_int("x", "c"), ["12", " 12", "+5", "1.0", "1e3", "9007199254740993", "007"]) == [12, 12, 5, 1, 1000, 9007199254740993, 7]
    assert run(spark, C.to_long("x", "c"), ["-1", "NA", None, ""]) == [-1, None, None, None]
    for bad in ("1.5", "1d", "x"):
        with pytest.raises(Exception, match="Column x: not a whole number"):
            run(spark, C.to_int("x", "c"), [bad])
    for missing in (None, "NA"):
        with pytest.raises(Exception, match="Column x: missing value"):
            run(spark, C.to_int("x", "c"), [missing])


def test_dates(spark):
    day = datetime.datetime(2020, 1, 5)
    assert run(spark, C.to_timestamp("x", "c", "%Y-%m-%d"), ["2020-01-05", "2020-1-5", "NA", None]) == [day, day, None, None]
    moment = datetime.datetime(2020, 1, 31, 10, 11, 12)
    assert run(spark, C.to_timestamp("x", "c", "%Y-%m-%d %H:%M:%S"), ["2020-01-31 10:11:12"]) == [moment]
    assert run(spark, C.to_timestamp("x", "c", "%Y-%m-%dT%H:%M:%S"), ["2020-01-31T10:11:12"]) == [moment]
    assert run(spark, C.to_day("x", "c", "%d%m%Y"), ["31012020"]) == [datetime.date(2020, 1, 31)]
    for bad in ("2020-01-05 ", "2020-13-01", "2020-02-30", "2020-01", "2020-01-05T10:00:00"):
        with pytest.raises(Exception):
            run(spark, C.to_timestamp("x", "c", "%Y-%m-%d"), [bad])


@pytest.mark.parametrize("given, expected", [
    ("%Y-%m-%d", "yyyy-M-d"), ("%Y%m%d", "yyyyMMdd"), ("%Y-%m-%dT%H:%M:%S", "yyyy-M-d'T'H:m:s"), ("%d %b %y", "d MMM yy"),
])
def test_patterns(given, expected):
    assert spark_pattern(given) == expected


def test_unknown_directive():
    with pytest.raises(ValueError):
        spark_pattern("%Q")


def test_closed_lists(spark):
    cells = ["1", "1.0", " 2", "abc", "9", "", "NA", "1d", None, "nan"]
    expected = [1.0, 1.0, 2.0] + [None] * 7
    codes = ["1", "2", "6", "-1", "1.0"]
    literals = C.category_literals(codes, "double", "x")
    assert literals == ["1.0D", "2.0D", "6.0D", "-1.0D"]
    value = C.category_value("c", "double")
    assert run(spark, C.close_domain(value, literals, "double"), cells) == expected
    many = C.category_literals([str(i) for i in range(1, 200)], "double", "x")
    assert run(spark, C.close_domain(value, many, "double"), cells[:4]) == expected[:4]
    assert run(spark, C.category_index(value, literals, "smallint"), ["6", "-1", "1.0", "7"]) == [2, 3, 0, None]
    assert run(spark, C.close_domain(C.category_value("c", "bigint"), ["1L", "2L"], "bigint"), ["1", "2.0", "3", "x"]) == [1, 2, None, None]
    assert run(spark, C.close_domain(value, [], "double"), ["1"]) == [None]
    for bad in ("x", "nan", None):
        with pytest.raises(ValueError, match="Column x"):
            C.category_literals([bad], "double", "x")


def test_closed_text_lists(spark):
    value = C.category_value("c", "string")
    literals = C.category_literals(["A", "it's", "b\\c", "NA"], "string", "x")
    assert run(spark, C.close_domain(value, literals, "string"), ["A", " A", "it's", "b\\c", "NA"]) == ["A", None, "it's", "b\\c", None]
