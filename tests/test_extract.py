import os

import pytest

from codedframes.operators.order import first_files, list_files, with_row_index
from codedframes.operators.profile import profile_columns
from codedframes.sources.extract import add_placeholders, check_quotes, open_quotes, read_extract, read_header, scan_extract
from entry_data import write_extract


def put(folder, name, text, charset="cp1252"):
    path = os.path.join(folder, name)
    with open(path, "wb") as out:
        out.write(text.encode(charset))
    return path


def cells(frame):
    return [tuple(r) for r in frame.collect()]


def test_header_keeps_edge_tabs_out_of_names(spark, folder):
    assert read_header(spark, put(folder, "a.tsv", "eid\t19-0.0\tnaïve\n1\t2\t3\n")) == ["eid", "19-0.0", "naïve"]


def test_charset_tokens_and_quotes(spark, folder):
    path = put(folder, "a.tsv", 'eid\tt\tu\n1\tcafé € “q”\tNA\n2\t"say ""hi""\tnow"\tNone\n3\t  x\tmid"q\n4\tnan\t-1.#IND\n')
    assert cells(read_extract(spark, path)) == [
        ("1", "café € “q”", None), ("2", 'say "hi"\tnow', None), ("3", "  x", 'mid"q'), ("4", None, None),
    ]


def test_utf8(spark, folder):
    path = put(folder, "a.tsv", "eid\tt\n1\tcafé 中\n", "utf-8")
    assert cells(read_extract(spark, path, charset="utf-8")) == [("1", "café 中")]


def test_unknown_charset_needs_the_session_setting(spark, folder):
    path = put(folder, "a.tsv", "eid\tt\n1\tx\n")
    with pytest.raises(ValueError, match="javaCharsets"):
        read_extract(spark, path, charset="cp850")


def test_placeholders():
    assert add_placeholders(["a"], 2) == ["Empty column 0", "Empty column 1", "a"]
    assert add_placeholders(["a"], -1) == ["a", "Empty column 0"]
    assert add_placeholders(["a"], 0) == ["a"]


def test_tab_offsets(spark, folder):
    lead = put(folder, "a.tsv", "a\tb\n\t\t1\t2\n")
    trail = put(folder, "b.tsv", "a\tb\n1\t2\t\n")
    assert cells(read_extract(spark, lead, offset=2)) == [("1", "2")]
    assert cells(read_extract(spark, trail, offset=-1)) == [("1", "2")]


def test_ragged_rows(spark, folder):
    path = put(folder, "a.tsv", "a\tb\tc\n1\n1\t2\t3\t4\n")
    assert cells(read_extract(spark, path)) == [("1", None, None), ("1", "2", "3")]


def test_only_selected_columns_are_scanned(spark, folder):
    path = put(folder, "a.tsv", "a\tb-0.0\tc\n1\t2\t3\n")
    plan = read_extract(spark, path).select("`b-0.0`")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<b-0.0:string>" in plan


def test_headers_of_all_files_must_agree(spark, folder):
    put(folder, "1.tsv", "a\tb\n1\t2\n")
    put(folder, "2.tsv", "b\ta\n1\t2\n")
    with pytest.raises(Exception, match="header does not conform"):
        scan_extract(spark, folder, ["a", "b"]).collect()


def test_repeated_names(spark, folder):
    path = put(folder, "a.tsv", "a\ta\n1\t2\n")
    with pytest.raises(ValueError, match="repeats"):
        read_extract(spark, path)


def test_round_trip(spark, folder):
    frame = spark.createDataFrame([("1", 'q"x', "a\tb"), ("2", None, "€Ž")], "eid string, `19-0.0` string, t string")
    write_extract(frame, folder + "/out", leading_tabs=1)
    assert sorted(cells(read_extract(spark, folder + "/out", offset=1))) == sorted(cells(frame))


def test_file_order(spark, folder):
    for i in range(4):
        put(folder, f"part-{i}.tsv", "n\n" + "".join(f"{i * 1000 + j}\n" for j in range(700 + i)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        def scan(files):
            return scan_extract(spark, files, ["n"])

        files = list_files(spark, folder)
        expected = [str(i * 1000 + j) for i in range(4) for j in range(700 + i)]
        rows = with_row_index(scan(folder)).orderBy("index").collect()
        assert [(r["index"], r["n"]) for r in rows] == list(enumerate(expected))
        for n in (1, 699, 700, 701, 1500, 5000):
            used = first_files(files, n, scan)
            found = with_row_index(scan(used), "index", n).orderBy("index").collect()
            assert [r["n"] for r in found] == expected[:n]
        assert len(first_files(files, 10, scan)) == 1 and len(first_files(files, 900, scan)) == 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_first_rows_of_one_large_file(spark, folder):
    path = put(folder, "a.tsv", "n\tt\n" + "".join(f"{i}\tcell {i}\n" for i in range(20_000)))
    size = os.path.getsize(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 10))
    try:
        def scan(files):
            return scan_extract(spark, files, ["n", "t"])

        assert scan([path]).rdd.getNumPartitions() > 8
        for n in (1, 100, 1200, 1900, 5000, 30_000):
            used = first_files(list_files(spark, folder), n, scan)
            found = with_row_index(scan(used), "index", n).orderBy("index").collect()
            assert [tuple(r) for r in found] == [(i, str(i), f"cell {i}") for i in range(min(n, 20_000))]
            small = used != list_files(spark, folder)
            assert small == (n < 1905)
            # No more than the first split's bytes are read of the file.
            assert not small or os.path.getsize(used[0].removeprefix("file:")) <= size // 10
            assert small != (list_files(spark, folder)[0] in scan(used).inputFiles())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("line, cell", [
    ('a\t"x', '"x'), ('"a""b"\tc', None), ('a""\t"b', '"b'), ('"a\t"', None), ('"abc""', '"'), ('"', '"'), ('""', None), ("", None),
    ('"a"\t""\t"b"x\tmid"q', None), ('"a\tb" \t"c"', None), ('"a\t"\t"b\t', '"b\t'), ('x\t"a""\t""b"', None), (None, None),
    ('"' + '""' * 100_000 + '"', None), ("\t".join(['"a""b"'] * 20_000) + '\t"', '"'),
])
def test_open_quotes(spark, line, cell):
    found = open_quotes(spark.createDataFrame([(line, "k")], "line string, cell string")).collect()
    assert [r["cell"] for r in found] == ([cell] if cell else [])


def test_quoted_line_breaks_are_refused(spark, folder):
    path = put(folder, "a.tsv", 'a\tb\tc\n1\t"x ""y"\t3\n2\t"y\nz"\t3\n')
    with pytest.raises(ValueError, match=r"a\.tsv, after byte 0: '\"y'"):
        check_quotes(spark, path)
    check_quotes(spark, path, first_lines=2)
    with pytest.raises(ValueError, match="line breaks"):
        check_quotes(spark, path, first_lines=3)


def test_profile(spark):
    frame = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int, `it's` string")
    assert sorted(cells(profile_columns(frame))) == [("a.b", "int", 2), ("it's", "string", 1)]
