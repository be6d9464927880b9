import datetime
import os

import pytest

from codedframes import ConversionSpec, convert
from codedframes.plans.convert import load_dictionary
from codedframes.plans.typed import cast_extract, check_types, check_width, plan_columns
from codedframes.operators.types import type_map
from codedframes.sinks import parquet as sink
from codedframes.sources.extract import scan_extract

NAMES = "eid 11-0.0 12-0.0 13-0.0 14-0.0 15-0.0 16-0.0 17-0.0 18-0.0 19-0.0 20-0.0 23-0.0".split()
ROWS = [
    "1\t30\t-3\t1960\tcafé €\t1.5\t2020-01-31\t2020-01-31 10:11:12\t103\tA\t501\t1900-01-01",
    '2\t30.0\t9\tNA\t"q ""x"" y"\tinf\t2020-1-5\t\tNA\tNA\t-1\t1902-01-01',
    "3.0\tabc\t\t1961.0\tNone\t1e3\t\t\t1d\tb&c\t999\t",
]
DAY, MOMENT = datetime.datetime(2020, 1, 31), datetime.datetime(2020, 1, 31, 10, 11, 12)
EXPECTED = [
    (1, 30.0, -3.0, 1960.0, "café €", 1.5, DAY, MOMENT, 103.0, "A", 501.0, datetime.datetime(1900, 1, 1)),
    (2, 30.0, None, None, 'q "x" y', float("inf"), datetime.datetime(2020, 1, 5), None, None, None, None, None),
    (3, None, None, 1961.0, None, 1000.0, None, None, None, "b&c", None, None),
]


@pytest.fixture
def inputs(folder, dictionary_file):
    os.mkdir(folder + "/codings")
    with open(folder + "/codings/encoding_table_77.txt", "w") as out:
        out.write("x\n" * 7 + "coding\tmeaning\tselectable\n-1\tUpper\tN\n501\tHand\tY\n-1\tLower\tN\n502\tFoot\tY\n")

    def write(rows=ROWS, names=NAMES):
        path = folder + "/extract.tsv"
        with open(path, "wb") as out:
            out.write("\n".join(["\t".join(names), *rows, ""]).encode("cp1252"))
        return path, dictionary_file, folder + "/codings"

    return write


def test_manifest_reads_footers_alone(spark, folder):
    spark.range(1000).selectExpr("id", "uuid() AS t").repartition(3).write.parquet(folder + "/out")
    frame = sink.manifest(spark, folder + "/out")
    assert sum(r["rows"] for r in frame.collect()) == 1000
    scans = [line for line in frame._jdf.queryExecution().toString().split("\n") if "FileScan parquet" in line]
    assert scans and all("ReadSchema: struct<>" in line for line in scans)


def test_broken_quotes_stop_a_conversion_before_any_write(spark, folder, inputs):
    extract, page, codings = inputs()
    broken = folder + "/broken.tsv"
    with open(extract, "rb") as old, open(broken, "wb") as new:
        new.write(old.read() + b'9\t1\t-1\t1960\t"x\ny"\n')
    with pytest.raises(ValueError, match="line breaks"):
        convert(spark, broken, page, {"a": ConversionSpec(folder + "/a"), "b": ConversionSpec(folder + "/b", nrows=1)}, codings)
    assert not os.path.exists(folder + "/a") and not os.path.exists(folder + "/b")
    convert(spark, broken, page, {"b": ConversionSpec(folder + "/b", nrows=1)}, codings)
    assert spark.read.parquet(folder + "/b").count() == 1


def test_many_outputs(spark, folder, inputs):
    extract, page, codings = inputs()
    specs = {
        "plain": ConversionSpec(folder + "/plain", description="All rows"),
        "short": ConversionSpec.from_dict({
            "out_path": folder + "/short", "dtype_dict": "nullable", "nrows": 2, "npartitions": 3,
            "settings": {"write_index": True, "compression": "gzip"}, "max_categories": 4,
        }),
        "indexed": ConversionSpec(folder + "/indexed", index_categories=True),
    }
    out = convert(spark, extract, page, specs, codings)
    plain = spark.read.parquet(out["plain"])
    assert [tuple(r) for r in plain.orderBy("eid").collect()] == EXPECTED
    short = spark.read.parquet(out["short"])
    assert [tuple(r)[:6] for r in short.orderBy("index").collect()] == [(0, 1, 30, -3, 1960, "café €"), (1, 2, 30, None, None, 'q "x" y')]
    assert dict(short.dtypes)["16-0.0"] == "date" and dict(short.dtypes)["11-0.0"] == "bigint"
    assert any(f.endswith(".gz.parquet") for f in os.listdir(out["short"]))
    indexed = [tuple(r)[:3] for r in spark.read.parquet(out["indexed"]).orderBy("eid").collect()]
    assert indexed == [(1, 0, 2), (2, 0, None), (3, None, None)]
    record = spark.read.json(out["plain"] + ".provenance").first()
    assert record["rows"] == 3 and record["description"] == "All rows" and '"max_categories": 256' in record["config"]
    with pytest.raises(OSError, match="not empty"):
        convert(spark, extract, page, {"plain": specs["plain"]}, codings)
    assert plain.schema["11-0.0"].metadata == {
        "encoding_id": "501", "categories": ["30", "10", "20", "55", "-7", "40"], "stored": "code", "compared": "double", "format": None,
    }


@pytest.mark.parametrize("second", ["out", "out/inner"])
def test_outputs_that_share_a_folder_are_refused(spark, folder, inputs, second):
    extract, page, codings = inputs()
    specs = {"a": ConversionSpec(f"{folder}/out", force=True), "b": ConversionSpec(f"{folder}/{second}", force=True)}
    with pytest.raises(ValueError, match="share a folder"):
        convert(spark, extract, page, specs, codings)


def test_manifest_lists_files_without_rows(spark, folder):
    sink.write_parquet(spark.range(10).where("id < 0").repartition(1), f"{folder}/none")
    assert [r["rows"] for r in sink.manifest(spark, f"{folder}/none").collect()] in ([0], [])
    where = sink.write_manifest(spark, f"{folder}/none", {"compression": "none"}, "nothing")
    assert spark.read.json(where).first()["description"] == "nothing"


def test_index_longer_than_declared_is_named():
    with pytest.raises(ValueError, match="Column 1-0.0: 40000 codes"):
        check_width("1-0.0", 40000, "smallint")


@pytest.mark.parametrize("column, value, message", [
    (0, "", "missing value"), (0, "1.5", "whole number"), (3, "x", "Column 13-0.0: not a number"), (6, "31-01-2020", "Column .*not a date"), (6, "2020-02-31", "Column .*not a date"),
])
def test_bad_cells_fail(spark, folder, inputs, column, value, message):
    cells = ROWS[0].split("\t")
    cells[column] = value
    extract, page, codings = inputs([ROWS[1], "\t".join(cells)])
    with pytest.raises(Exception, match=message):
        convert(spark, extract, page, [ConversionSpec(folder + "/out")], codings)


def test_unknown_header_name(spark, folder, inputs):
    extract, page, codings = inputs(names=[*NAMES[:-1], "99-0.0"])
    with pytest.raises(ValueError, match="99-0.0"):
        convert(spark, extract, page, [ConversionSpec(folder + "/out")], codings)


def test_incomplete_type_map(spark, folder, inputs, dictionary):
    extract, page, codings = inputs()
    spec = ConversionSpec(folder + "/out", dtype_dict={"Type": {"Integer": "float"}})
    with pytest.raises(ValueError, match="type map lacks"):
        convert(spark, extract, page, [spec], codings)
    check_types(dictionary, type_map(spark))


def test_missing_coding_table(spark, folder, inputs):
    extract, page, _ = inputs()
    with pytest.raises(ValueError, match="No coding table"):
        convert(spark, extract, page, [ConversionSpec(folder + "/out")])


@pytest.mark.parametrize("indexed", [False, True])
@pytest.mark.parametrize("max_bytes", [0, 1 << 26])
def test_long_lists_are_joined(spark, inputs, indexed, max_bytes):
    extract, page, codings = inputs()
    book, encodings = load_dictionary(spark, page, codings)
    short = plan_columns(spark, NAMES, book, encodings)
    raw = scan_extract(spark, extract, NAMES)
    expected = cast_extract(raw, short, "windows-1252", indexed)
    short.long_ids = set(short.lists)
    joined = cast_extract(raw, short, "windows-1252", indexed, max_broadcast_bytes=max_bytes)
    assert joined.dtypes == expected.dtypes
    assert joined.orderBy("eid").collect() == expected.orderBy("eid").collect()


def test_spec_checks():
    for bad in ({}, {"out_path": ""}, {"out_path": "x", "nrow": 1}, {"out_path": "x", "dtype_dict": "other"}, {"out_path": "x", "nrows": -1}):
        with pytest.raises(ValueError):
            ConversionSpec.from_dict(bad)


def test_output_guard(spark, folder):
    frame = spark.range(5)
    os.mkdir(folder + "/empty")
    sink.write_parquet(frame, folder + "/empty")
    with pytest.raises(OSError):
        sink.write_parquet(frame, folder + "/empty")
    sink.write_parquet(spark.range(2), folder + "/empty", force=True)
    assert spark.read.parquet(folder + "/empty").count() == 2
    with pytest.raises(OSError, match="holds the input"):
        sink.check_output(spark, folder, force=True, inputs=(folder + "/empty",))


def test_partitions(spark):
    frame = spark.range(0, 1000, 1, 16)
    assert sink.repartition(frame, 0) is frame and sink.repartition(frame, None) is frame
    assert sink.repartition(frame, 8).rdd.getNumPartitions() == 8
    assert sink.repartition(frame, 2).rdd.getNumPartitions() == 2
    assert sink.repartition(frame, 40).rdd.getNumPartitions() == 40


def test_specs_of_equal_types_are_resolved_once(spark, folder, inputs):
    """A second spec of the same types costs the jobs of its write and its manifest only."""
    extract, page, codings = inputs()
    tracker = spark.sparkContext.statusTracker()

    def jobs(label, specs):
        spark.sparkContext.setJobGroup(label, label)
        convert(spark, extract, page, specs, codings)
        return len(tracker.getJobIdsForGroup(label))

    one = jobs("one", [ConversionSpec(f"{folder}/a", settings={"compression": "zstd"})])
    two = jobs("two", [ConversionSpec(f"{folder}/b"), ConversionSpec(f"{folder}/c", index_categories=True)])
    other = jobs("other", [ConversionSpec(f"{folder}/d"), ConversionSpec(f"{folder}/e", max_categories=200)])
    spark.sparkContext.setJobGroup("write", "write")
    sink.write_manifest(spark, f"{folder}/a", {}, to=f"{folder}/again")
    manifest = len(tracker.getJobIdsForGroup("write"))
    assert two - one <= 2 + manifest < other - one


def test_manifest_reads_no_column(spark, folder):
    sink.write_parquet(spark.range(10), f"{folder}/out")
    plan = sink.manifest(spark, f"{folder}/out")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
