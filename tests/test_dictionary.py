import pytest

from codedframes import CodedDictionary
from codedframes.functions import markup as M
from codedframes.sources.dictionary import parse_encodings, parse_info, parse_main_table
from pyspark.sql import functions as F
from tests.pages import CENTRES


def test_info(pages):
    assert {r["key"]: r["value"] for r in parse_info(pages).collect()} == {
        "Date Extracted:": "2021-03-04T05:06:07",
        "Data columns:": "20",
    }


def test_columns_and_types(dictionary):
    assert dict(dictionary.dtypes) == {
        "dict_id": "string", "Column": "bigint", "UDI": "string", "Count": "bigint", "Type": "string",
        "Description": "string", "Encoding_id": "string", "Encoding_num_members": "bigint", "Encoding_type": "string",
        "Is_hierarchical": "boolean", "Is_categorical": "boolean", "Has_encoding": "boolean",
    }
    assert dictionary.count() == 20


def test_spanned_cells_are_repeated(dictionary):
    rows = {r["UDI"]: r for r in dictionary.collect()}
    for udi in ("12-0.0", "12-1.0", "12-2.0"):
        assert rows[udi]["Type"] == "Categorical (single)"
        assert rows[udi]["Description"].startswith("Shelf & rack place Uses data-coding 502 comprises 3 Integer-valued")
        assert (rows[udi]["Encoding_id"], rows[udi]["Encoding_num_members"], rows[udi]["Encoding_type"]) == ("502", 3, "Integer")
    assert rows["14-1.0"]["Description"] == "Device café€ label"
    assert rows["20-0.0"]["Is_hierarchical"] and not rows["12-0.0"]["Is_hierarchical"]
    assert rows["eid"]["Encoding_id"] is None and not rows["eid"]["Has_encoding"]
    assert [rows[u]["Count"] for u in ("eid", "12-2.0")] == [900, 20]


def test_independent_spans_and_unclosed_tags(spark):
    page = (
        "<TABLE><tr><td>x</td></tr></TABLE><table><tr><th>Column<th>UDI<th>Count<th>Type<th>Description"
        "<tr><td>1<td rowspan=2>u1<td rowspan='3'>5<td rowspan=2>T<td>D1<tr><td>2<td>D2<tr><td>3<td>u3<td>T3<td>D3</table>"
    )
    frame = spark.createDataFrame([("a", page), ("b", "no tables"), ("c", "<table></table><table><tr><td>1</table>")], "dict_id string, html string")
    assert [tuple(r)[1:] for r in parse_main_table(frame).orderBy("Column").collect()] == [
        ("1", "u1", "5", "T", "D1"), ("2", "u1", "5", "T", "D2"), ("3", "u3", "5", "T3", "D3"),
    ]


def test_coding_tables(pages):
    rows = parse_encodings(pages).orderBy("encoding_id", "pos").collect()
    codes = {}
    for r in rows:
        codes.setdefault(r["encoding_id"], []).append((r["pos"], r["code"], r["meaning"]))
    assert [c for _, c, _ in codes["501"]] == ["30", "10", "20", "55", "-7", "40"]
    assert codes["501"][4] == (5, "-7", "Ferry <5 km>")
    assert codes["502"][2] == (3, "-3", "Floor")
    assert codes["504"] == [(1, "A", "Alpha"), (2, "NA", "Not applicable"), (3, "b&c", "Both")]
    assert [(int(c), m) for _, c, m in codes["503"]] == CENTRES


@pytest.mark.parametrize("text, expected", [
    ("a &amp;lt; b", "a &lt; b"), ("&lt;&gt;&quot;&apos;", "<>\"'"), ("&#233;&#xE9;&eacute;", "ééé"), ("&#128;", "€"),
    ("&nosuch; &", "&nosuch; &"), ("x;y &#0; &#9999999;", "x;y � �"), ("plain", "plain"),
])
def test_unescape(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(M.unescape(F.col("t"))).first()[0] == expected


def test_single_key_lookups(spark, dictionary_file):
    book = CodedDictionary(spark, dictionary_file)
    assert book.info["Data columns:"] == "20"
    expected = [(1, "30", "Bus"), (2, "10", "Tram"), (3, "20", "Bicycle"), (4, "55", "On foot"), (5, "-7", "Ferry <5 km>"), (6, "40", "Van")]
    for table in (book.get_encoding_table(501), book.get_encoding_table("501"), book.get_encoding_by_data_field("11-0.0"),
                  book.get_encoding_by_data_field("11", is_udi=False)):
        assert table.columns == ["#", "Code", "Meaning"]
        assert [tuple(r) for r in table.collect()] == expected
    assert book.get_human_readable_name("11-0.0") == "Carried by"
    assert book.get_human_readable_name("12", is_udi=False) == "Shelf & rack place"
    for call in (
        lambda: book.get_encoding_table("999"),
        lambda: book.get_encoding_by_data_field("no such"),
        lambda: book.get_encoding_by_data_field("no such", is_udi=False),
        lambda: book.get_encoding_by_data_field("11"),
        lambda: book.get_encoding_by_data_field("11-0.0", is_udi=False),
        lambda: book.get_encoding_by_data_field("eid"),
        lambda: book.get_human_readable_name("no such"),
        lambda: book.get_human_readable_name("24", is_udi=False),
        lambda: CodedDictionary(spark, "/tmp/file.txt"),
    ):
        with pytest.raises(ValueError):
            call()
    assert book.get_human_readable_name("24-1.0") == "Second wording"
