import os

import pytest

from codedframes.sources.codings import (
    hierarchical_flags,
    parse_coding_texts,
    read_coding_files,
    read_coding_texts,
    rejected_codings,
    selectable_only,
    unresolved_encodings,
)
from codedframes.sources.dictionary import parse_encodings

HEAD = "preamble\n" * 7


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write(text)


def test_files_are_read_after_the_preamble(spark, folder):
    _write(folder, "encoding_table_77.txt", HEAD + 'coding\tmeaning\tnode_id\tparent_id\tselectable\n-1\tTop\t1\t0\tN\n5 01\t"Hand ""left"""\t2\t1\tY\nNA\tNone\t3\t1\tY\n')
    _write(folder, "encoding_table_78.txt", HEAD + "selectable\tcoding\r\nY\ta\r\n")
    rows = read_coding_files(spark, folder).orderBy("encoding_id", "pos").collect()
    assert [tuple(r) for r in rows] == [
        ("77", 1, "-1", "Top", "0", "N", {"node_id": "1"}), ("77", 2, "5 01", 'Hand "left"', "1", "Y", {"node_id": "2"}),
        ("77", 3, "NA", "None", "1", "Y", {"node_id": "3"}), ("78", 1, "a", None, None, "Y", {}),
    ]


def test_failed_downloads(spark, folder):
    _write(folder, "encoding_table_1.txt", "<p>Sorry, internal error prevents download of coding 1</p>")
    _write(folder, "encoding_table_2.txt", HEAD + "coding\tmeaning\n1\tone\n")
    assert [r["encoding_id"] for r in rejected_codings(read_coding_texts(spark, folder)).collect()] == ["1"]
    assert [r["encoding_id"] for r in read_coding_files(spark, folder, strict=False).collect()] == ["2"]
    with pytest.raises(Exception, match="download error"):
        read_coding_files(spark, folder).collect()


def test_skip_lines_is_a_parameter(spark, folder):
    _write(folder, "encoding_table_3.txt", "coding\tmeaning\n1\tone\n")
    assert [tuple(r)[:4] for r in read_coding_files(spark, folder, skip_lines=0).collect()] == [("3", 1, "1", "one")]


def test_routing(dictionary, encodings):
    by_id = {r["encoding_id"]: r["is_hierarchical"] for r in encodings.select("encoding_id", "is_hierarchical").distinct().collect()}
    assert by_id == {"501": False, "502": False, "503": False, "504": False, "505": False, "77": True}
    assert {r["encoding_id"] for r in hierarchical_flags(dictionary).where("is_hierarchical").collect()} == {"77"}
    assert unresolved_encodings(dictionary, encodings).count() == 0
    left = encodings.where("encoding_id <> '502'")
    assert [r["encoding_id"] for r in unresolved_encodings(dictionary, left).collect()] == ["502"]


def test_headings_are_not_selectable(encodings):
    kept = selectable_only(encodings).where("encoding_id = '77'").orderBy("pos").collect()
    assert [r["code"] for r in kept] == ["501", "502"]


def test_the_header_is_read_once_a_table(pages, spark):
    """Nothing above the explode of a table's rows looks for its header: that would search all rows again for each row."""
    texts = spark.createDataFrame([("1", "h\ncoding\tmeaning\n1\tone\n2\ttwo")], "encoding_id string, content string")
    for frame, header in ((parse_encodings(pages), "(?i)<th"), (parse_coding_texts(texts, 1), "lines#")):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        above, generate, below = plan.partition("Generate posexplode")
        assert generate and header not in above and header in below
    rows = parse_coding_texts(texts, 1).orderBy("pos").collect()
    assert [(r["pos"], r["code"], r["meaning"]) for r in rows] == [(1, "1", "one"), (2, "2", "two")]
