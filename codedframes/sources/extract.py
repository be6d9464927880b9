"""Very wide tab-separated extracts.

The scan keeps Spark's line-splittable CSV source: text columns only, one
schema made from the header, and every cast in one projection above it, so
column pruning reaches the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import CHARSET, PLACEHOLDER
from ..functions.text import cp1252_from_latin1, missing_to_null, quote_name
from ..operators.order import with_row_index

CP1252_NAMES = ("windows-1252", "cp1252", "windows1252")
SPARK_CHARSETS = ("us-ascii", "iso-8859-1", "utf-8", "utf-16be", "utf-16le", "utf-16", "utf-32")


def is_cp1252(charset: str) -> bool:
    return charset.lower() in CP1252_NAMES


def reader_charset(spark: SparkSession, charset: str) -> str:
    """The charset to hand to the reader.

    windows-1252 is read as ISO-8859-1 and corrected on text cells. Other
    charsets outside Spark's list need its legacy setting for the session.
    """
    if is_cp1252(charset):
        return "ISO-8859-1"
    if charset.lower() not in SPARK_CHARSETS and spark.conf.get("spark.sql.legacy.javaCharsets") != "true":
        raise ValueError(f"Charset {charset!r} needs spark.sql.legacy.javaCharsets=true in the session")
    return charset


def add_placeholders(names: Sequence[str], offset: int) -> list[str]:
    """Names for the empty columns that extra tabs make.

    A positive offset puts them at the start, a negative one at the end.
    """
    extra = [PLACEHOLDER.format(i) for i in range(abs(offset))]
    return [*extra, *names] if offset > 0 else [*names, *extra]


def read_header(spark: SparkSession, path: str, charset: str = CHARSET) -> list[str]:
    """Column names of an extract: its first line."""
    lines = (
        spark.read.schema("line string")
        .options(sep="\x01", quote="", encoding=reader_charset(spark, charset))
        .csv(path)
    )
    first = lines.first()
    if first is None:
        raise ValueError(f"The extract {path} is empty")
    line = first["line"]
    if is_cp1252(charset):
        line = line.encode("latin-1").decode("cp1252")
    return line.split("\t")


def header_frame(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Header names as `pos, udi`, a local relation of known size."""
    positions = pa.array(range(len(names)), pa.int32())
    return spark.createDataFrame(pa.table({"pos": positions, "udi": pa.array(names, pa.string())}))


def scan_extract(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Sequence[str],
    offset: int = 0,
    charset: str = CHARSET,
) -> DataFrame:
    """All cells as raw text, placeholders included.

    Rows with fewer cells end in NULLs and surplus cells are dropped. Every
    file starts with the header line; without placeholders each file's header
    is checked against `names`.
    """
    if len(set(names)) < len(names):
        repeated = sorted({n for n in names if list(names).count(n) > 1})
        raise ValueError(f"The extract repeats column names: {repeated[:20]}")
    columns = add_placeholders(names, offset)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return (
        spark.read.schema(schema)
        .options(
            sep="\t",
            header=True,
            enforceSchema=offset != 0,
            encoding=reader_charset(spark, charset),
            quote='"',
            escape='"',
            multiLine=False,
            mode="PERMISSIVE",
            maxColumns=len(columns) + 1024,
        )
        .csv(path if isinstance(path, str) else list(path))
    )


def open_quotes(lines: DataFrame) -> DataFrame:
    """The rows of `lines` (line, ...) with a quoted cell that is still open at the line's end, and that `cell`.

    A cell is quoted if it begins with a quote; in it, two quotes stand for one. A break inside such a cell makes two
    rows of one. Quoted cells are taken out of the line piece by piece, so no cell is too long or has too many quotes.
    """
    rest = F.regexp_replace("line", r'(^|\t|\G)"[^"]*"', "$1")
    cell = F.regexp_extract(rest, r'(?:^|\t)("[\s\S]*)', 1)
    return lines.withColumn("cell", cell).where("cell <> ''")


def check_quotes(spark: SparkSession, path: str | Sequence[str], charset: str = CHARSET, first_lines: int = 0) -> None:
    """Raise, with file and cell, if a quoted cell has a line break in it: line-splittable scans would make two rows of it.

    With `first_lines`, only these of all lines in file order, headers included, are looked at.
    """
    lines = spark.read.schema("line string").options(sep="\x01", quote="", encoding=reader_charset(spark, charset)).csv(
        path if isinstance(path, str) else list(path))
    lines = lines.select("line", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    if first_lines:
        lines = with_row_index(lines, "number", first_lines)
    found = open_quotes(lines).select("file", "block", F.substring("cell", 1, 60).alias("cell")).take(5)
    if found:
        places = [f"{r['file']}, after byte {r['block']}: {r['cell']!r}" for r in found]
        raise ValueError(f"Quoted cells have line breaks in them: {'; '.join(places)}")


def clean_cells(raw: DataFrame, names: Sequence[str], text_names: Sequence[str] = (), charset: str = CHARSET) -> DataFrame:
    """Missing-value tokens to NULL, and the charset of `text_names` put right.

    The tokens are plain ASCII, so only columns kept as text need the latter.
    Placeholder columns are not among `names` and fall away here.
    """
    corrected = set(text_names) if is_cp1252(charset) else set()
    cells = []
    for name in names:
        cell = quote_name(name)
        value = cp1252_from_latin1(cell) if name in corrected else cell
        cells.append(f"{missing_to_null(cell, value)} AS {cell}")
    return raw.selectExpr(*cells)


def read_extract(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Sequence[str] | None = None,
    offset: int = 0,
    charset: str = CHARSET,
) -> DataFrame:
    """An extract as text with missing values marked, before any cast."""
    if names is None:
        names = read_header(spark, path if isinstance(path, str) else path[0], charset)
    raw = scan_extract(spark, path, names, offset, charset)
    return clean_cells(raw, names, text_names=names, charset=charset)
