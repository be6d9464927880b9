"""Data dictionaries in HTML, parsed as Spark jobs.

Every function takes a frame with one page per row (`dict_id`, `html`), so a
collection of dictionaries is parsed in parallel, map-only: a page's tables,
rows and cells are unfolded inside its own row and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import describe as D
from ..functions import markup as M


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Dictionary files, one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("dict_id"), F.col("value").alias("html")
    )


def parse_info(pages: DataFrame) -> DataFrame:
    """Key/value pairs of the first table: `dict_id, key, value`."""
    table_rows = M.rows(F.try_element_at(F.col("tables"), F.lit(1)))
    return (
        pages.select("dict_id", M.tables(F.col("html")).alias("tables"))
        .select("dict_id", F.explode(table_rows).alias("row"))
        .select("dict_id", M.texts(F.col("row")).alias("cells"))
        .where(F.size("cells") >= 2)
        .select("dict_id", F.col("cells")[0].alias("key"), F.col("cells")[1].alias("value"))
    )


def parse_main_table(pages: DataFrame) -> DataFrame:
    """Rows of the second table as text, with row spans expanded."""
    names = F.col("names")
    data_rows = F.transform(F.filter("rows", M.is_data_row), M.cells)
    return (
        pages.select("dict_id", M.tables(F.col("html")).alias("tables"))
        .select("dict_id", M.rows(F.try_element_at(F.col("tables"), F.lit(2))).alias("rows"))
        .select("dict_id", M.header_names(F.col("rows")).alias("names"), data_rows.alias("data"))
        .select("dict_id", "names", F.size("names").alias("width"), "data")
        .select("dict_id", "names", "width", F.explode(M.span_groups(F.col("data"), F.col("width"))).alias("run"))
        .select("dict_id", "names", F.explode(M.expand_spans("run", "width")).alias("cells"))
        .select(
            "dict_id",
            *[M.pick(F.col("cells"), names, n).alias(n) for n in ("Column", "UDI", "Count", "Type", "Description")],
        )
    )


def describe_dictionary(main: DataFrame) -> DataFrame:
    """Add the derived columns to `Column, UDI, Count, Type, Description`."""
    text = F.col("Description")
    return main.select(
        *[c for c in main.columns if c == "dict_id"],
        F.col("Column").try_cast("bigint").alias("Column"),
        "UDI",
        F.col("Count").try_cast("bigint").alias("Count"),
        "Type",
        "Description",
        D.encoding_id(text).alias("Encoding_id"),
        D.encoding_num_members(text).alias("Encoding_num_members"),
        D.encoding_type(text).alias("Encoding_type"),
        D.is_hierarchical(text).alias("Is_hierarchical"),
        D.is_categorical(F.col("Type")).alias("Is_categorical"),
        D.encoding_id(text).isNotNull().alias("Has_encoding"),
    )


def parse_dictionary(pages: DataFrame) -> DataFrame:
    """The dictionary: one row per column of the extract."""
    return describe_dictionary(parse_main_table(pages))


def parse_encodings(pages: DataFrame) -> DataFrame:
    """All coding tables of all pages as one long frame.

    `dict_id, encoding_id, pos, code, meaning`; `pos` is the table order. The
    first table of a coding counts when a page repeats one.
    """
    pairs = F.transform(
        M.tables(F.col("html")),
        lambda t: F.struct(
            F.regexp_extract(M.attribute(t, "summary"), r"^Coding (.+)$", 1).alias("encoding_id"), t.alias("html")
        ),
    )
    coding = F.col("coding")
    return (
        pages.select("dict_id", F.filter(pairs, lambda p: p["encoding_id"] != "").alias("codings"))
        .select("dict_id", "codings", F.col("codings.encoding_id").alias("ids"))
        .select("dict_id", "ids", F.posexplode("codings").alias("at", "coding"))
        .where(F.array_position("ids", coding["encoding_id"]) == F.col("at") + 1)
        .select("dict_id", coding["encoding_id"].alias("encoding_id"), M.rows(coding["html"]).alias("rows"))
        # The header is read below the explode: beside it, it would be searched for in all rows of a table again for each of them.
        .select("dict_id", "encoding_id", M.header_names(F.col("rows")).alias("names"), F.filter("rows", M.is_data_row).alias("data"))
        .select("dict_id", "encoding_id", "names", F.posexplode("data").alias("at", "row"))
        .select("dict_id", "encoding_id", "names", "at", M.texts(F.col("row")).alias("cells"))
        .select(
            "dict_id",
            "encoding_id",
            (F.col("at") + 1).cast("bigint").alias("pos"),
            M.pick(F.col("cells"), F.col("names"), "Code").alias("code"),
            M.pick(F.col("cells"), F.col("names"), "Meaning").alias("meaning"),
        )
    )
