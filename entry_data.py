"""Inputs that the queries derive from the given tables: extracts, dictionaries, codings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codedframes.functions.fixed import BAD_DOWNLOAD_TEXT, CHARSET
from codedframes.functions.text import latin1_from_cp1252, quote_name
from codedframes.sources.dictionary import describe_dictionary
from codedframes.sources.extract import is_cp1252, reader_charset


def write_extract(
    frame: DataFrame, path: str, charset: str = CHARSET, leading_tabs: int = 0, trailing_tabs: int = 0
) -> None:
    """Write columns as an extract of text cells.

    Each file starts with the header line. Extra tabs go on data rows only. A
    cell with a tab or a quote is quoted.
    """
    cells = []
    for name in frame.columns:
        cell = F.coalesce(F.col(quote_name(name)).cast("string"), F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))
        cells.append(F.when(cell.rlike('[\t"]'), quoted).otherwise(cell))
    line = F.concat_ws("\t", *[F.lit("")] * leading_tabs, *cells, *[F.lit("")] * trailing_tabs)
    if is_cp1252(charset):
        line = latin1_from_cp1252(line)
    (
        frame.select(line.alias("\t".join(frame.columns)))
        .write.options(sep="\x01", quote="", emptyValue="", header=True,
                       ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                       encoding=reader_charset(frame.sparkSession, charset))
        .csv(path)
    )


def workspace(spark) -> str:
    """A new folder under the shared checkpoint folder of the cluster, or else below its warehouse folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/codedframes-{uuid.uuid4().hex}"


_written: dict[tuple, str] = {}


def written_once(spark, key: tuple, write) -> str:
    """Path of a derived input, written on first use in an application."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _written:
        path = workspace(spark)
        write(path)
        _written[key] = path
    return _written[key]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_cells(spark, sf_dir: str) -> DataFrame:
    """`orders` as text cells in key order, with missing-value tokens in some."""
    customer = F.col("o_custkey")
    return table(spark, sf_dir, "orders").orderBy("o_orderkey").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(customer % 7 == 0, "NA").when(customer % 7 == 1, "").otherwise(customer.cast("string")).alias("o_custkey"),
        F.when(customer % 11 == 0, "None").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(customer % 13 == 0, "nan").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.concat(F.col("o_orderpriority"), F.lit(" café €")).alias("o_orderpriority"),
    )


def orders_extract(spark, sf_dir: str, leading_tabs: int = 0, trailing_tabs: int = 0) -> str:
    return written_once(
        spark,
        ("orders", sf_dir, leading_tabs, trailing_tabs),
        lambda path: write_extract(orders_cells(spark, sf_dir), path, leading_tabs=leading_tabs, trailing_tabs=trailing_tabs),
    )


def lineitem_extract(spark, sf_dir: str) -> str:
    """`lineitem` as an extract."""

    def write(path):
        cells = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
        write_extract(cells, path)

    return written_once(spark, ("lineitem", sf_dir), write)


LINEITEM_TYPES = {
    "l_orderkey": ("Sequence", None),
    "l_partkey": ("Integer", None),
    "l_suppkey": ("Integer", None),
    "l_linenumber": ("Categorical (single)", ("11", 7, "Integer")),
    "l_quantity": ("Continuous", None),
    "l_extendedprice": ("Continuous", None),
    "l_discount": ("Continuous", None),
    "l_tax": ("Continuous", None),
    "l_returnflag": ("Categorical (single)", ("12", 2, "String")),
    "l_linestatus": ("Text", None),
    "l_shipdate": ("Date", None),
}


def _description(name: str, coding) -> str:
    if coding is None:
        return name
    number, members, kind = coding
    return f"{name} Uses data-coding {number} comprises {members} {kind}-valued members in a simple list."


def column_dictionary(spark, types: dict) -> DataFrame:
    """A dictionary for the columns of an extract."""
    rows = [(str(i), name, "0", kind, _description(name, coding)) for i, (name, (kind, coding)) in enumerate(types.items())]
    return describe_dictionary(
        spark.createDataFrame(rows, "Column string, UDI string, Count string, Type string, Description string")
    )


def lineitem_codings(spark) -> DataFrame:
    """Codings of `lineitem`; the return flag's list leaves one flag out."""
    rows = [("11", i, str(i), f"Line {i}") for i in range(1, 8)] + [("12", 1, "A", "Accepted"), ("12", 2, "R", "Returned")]
    return spark.createDataFrame(rows, "encoding_id string, pos bigint, code string, meaning string").withColumn(
        "is_hierarchical", F.lit(False)
    )


# A dictionary with one row per part. Four parts make a field; type and coding
# depend on the field, every third field has differing descriptions.
PART_TYPES = (
    "Sequence", "Integer", "Continuous", "Text", "Date", "Time", "Categorical (single)", "Categorical (multiple)",
    "Compound", "Curve",
)
PART_VALUE_TYPES = ("Integer", "Real", "String", "ERROR")


def part_main_table(spark, sf_dir: str) -> DataFrame:
    types = ", ".join(f"'{t}'" for t in PART_TYPES)
    values = ", ".join(f"'{t}'" for t in PART_VALUE_TYPES)
    return (
        table(spark, sf_dir, "part")
        .selectExpr("*", "p_partkey div 4 AS f")
        .selectExpr(
            "CAST(p_partkey AS string) AS Column",
            "concat(f, '-', p_partkey % 4, '.0') AS UDI",
            "IF(p_size = 50, 'unknown', CAST(p_size * 100 AS string)) AS Count",
            f"element_at(array({types}), CAST(f % 10 + 1 AS int)) AS Type",
            "IF(f % 3 = 0, p_name, concat('Measure ', f)) AS name",
            f"""concat(' Uses data-coding ', f div 10 + 5, ' comprises ', f % 40 + 1, ' ',
                element_at(array({values}), CAST(f div 10 % 4 + 1 AS int)), '-valued members in a ',
                IF(f div 10 % 5 = 0, 'hierarchical tree', 'simple list'), '.') AS coding""",
        )
        .selectExpr("Column", "UDI", "Count", "Type",
                    "IF(Type LIKE 'Categorical%', concat(name, coding), name) AS Description")
    )


def part_dictionary(spark, sf_dir: str) -> DataFrame:
    return describe_dictionary(part_main_table(spark, sf_dir))


def customer_codings(spark, sf_dir: str, size: int = 30) -> DataFrame:
    """Codings of `size` customers each; every fifth is hierarchical."""
    return (
        table(spark, sf_dir, "customer")
        .selectExpr("*", f"c_custkey div {size} AS k", f"c_custkey div {size} % 5 = 0 AS is_hierarchical")
        .selectExpr(
            "CAST(k AS string) AS encoding_id",
            f"c_custkey % {size} + 1 AS pos",
            "CAST(c_custkey AS string) AS code",
            "concat(c_name, ' <', c_mktsegment, '> & ', c_nationkey) AS meaning",
            "IF(is_hierarchical, CAST(c_nationkey AS string), NULL) AS parent_id",
            "IF(is_hierarchical, IF(c_custkey % 2 = 0, 'Y', 'N'), NULL) AS selectable",
            "is_hierarchical",
        )
    )


PARTS_PER_PAGE = 1000


def _escaped(text):
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&#62;"))


def dictionary_pages(spark, sf_dir: str) -> DataFrame:
    """`part` written as dictionary pages (`dict_id, html`) of at most 1,000 rows.

    Parts of equal brand and type share their spanned cells. Part keys are
    unique, so the groups are bounded by the page size.
    """
    page = F.floor(F.col("p_partkey") / PARTS_PER_PAGE).cast("string").alias("dict_id")
    row = F.concat(
        F.lit("<tr><td align=right>"), F.col("p_partkey"), F.lit("</td><td><a href='#udi'>"), F.col("p_partkey"),
        F.lit("-0.0</a></td><td>"), F.col("p_size"), F.lit("</td>"),
    )
    span = F.concat(F.lit("<td rowspan=\""), F.size("rows"), F.lit("\">"))
    shared = F.concat(
        span, F.lit("<span>"), F.col("p_type"), F.lit("</span></td>"), span, _escaped(F.concat(F.col("p_brand"), F.lit(" <x> & y"))),
        F.lit("<br>Uses data-coding <a href='c'>"), F.regexp_replace("p_brand", r"\D", ""),
        F.lit("</a> comprises 3 Integer-valued members in a simple list.</td>"),
    )
    groups = (
        table(spark, sf_dir, "part")
        .groupBy(page, "p_brand", "p_type")
        .agg(F.sort_array(F.collect_list(F.struct("p_partkey", row.alias("html")))).alias("rows"))
        .select(
            "dict_id",
            F.size("rows").alias("n"),
            F.array_join(
                F.transform("rows", lambda r, i: F.concat(r["html"], F.when(i == 0, shared).otherwise(""), F.lit("</tr>"))), "\n"
            ).alias("html"),
        )
    )
    info = F.concat(
        F.lit("<table>\n<tr><td>Date Extracted:</td><td>2020-01-01T00:00:00</td></tr>\n<tr><td>Data columns:</td><td>"),
        F.sum("n"), F.lit("</td></tr>\n</table>\n<!-- <table> -->\n"),
    )
    head = F.lit(
        "<table border>\n<tr><th>Column</th><th><a href='#udi'>UDI</a></th><th>Count</th><th>Type</th><th>Description</th></tr>\n"
    )
    body = F.array_join(F.collect_list("html"), "\n")
    return groups.groupBy("dict_id").agg(
        F.concat(F.lit("<html><body>"), info, head, body, F.lit("\n</table></body></html>")).alias("html")
    )


def coding_pages(spark, sf_dir: str, size: int = 30) -> DataFrame:
    """The customers' codings as pages of thirty coding tables (`dict_id, html`)."""
    row = F.concat(
        F.lit("<tr><td>"), F.col("pos"), F.lit("</td><td>"), F.col("code"), F.lit("</td><td>"), _escaped(F.col("meaning")),
        F.lit("</td></tr>"),
    )
    rows = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", row.alias("html")))), lambda r: r["html"]), "\n")
    one = F.concat(
        F.lit("<h3>Data-Coding</h3>\n<table border summary=\"Coding "), F.col("encoding_id"),
        F.lit("\">\n<tr><th>#</th><th>Code</th><th>Meaning</th>\n"), rows, F.lit("\n</table>\n"),
    )
    page = F.floor(F.col("encoding_id").cast("bigint") / 30).cast("string")
    return (
        customer_codings(spark, sf_dir, size)
        .groupBy("encoding_id")
        .agg(one.alias("html"))
        .groupBy(page.alias("dict_id"))
        .agg(F.array_join(F.collect_list("html"), "").alias("html"))
    )


FILE_CODING_SIZE = 250


def coding_folder(spark, sf_dir: str) -> str:
    """Codings of 250 customers as coding files, one per coding; every third is
    a failed download. Ids are read from the folder names."""

    def write(path):
        line = F.concat_ws("\t", F.col("pos") + 500, "code", "meaning", F.coalesce("parent_id", F.lit("")), F.coalesce("selectable", F.lit("")))
        lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))), lambda r: r["line"]), "\n")
        head = F.lit("header\n" * 7 + "node_id\tcoding\tmeaning\tparent_id\tselectable\n")
        failed = F.col("encoding_id").cast("bigint") % 3 == 1
        files = customer_codings(spark, sf_dir, FILE_CODING_SIZE).groupBy("encoding_id").agg(F.concat(head, lines).alias("body"))
        files.select(
            "encoding_id", F.when(failed, F.lit(f"<p>{BAD_DOWNLOAD_TEXT}</p>")).otherwise(F.col("body")).alias("value")
        ).repartition("encoding_id").write.partitionBy("encoding_id").text(path)

    return written_once(spark, ("codings", sf_dir), write)


CODING_FOLDER_ID = r"encoding_id=([^/]+)/[^/]+$"


ORDERS_TYPES = {
    "o_orderkey": ("Sequence", None),
    "o_custkey": ("Integer", None),
    "o_orderstatus": ("Categorical (single)", ("21", 2, "String")),
    "o_totalprice": ("Continuous", None),
    "o_orderdate": ("Date", None),
    "o_orderpriority": ("Text", None),
}


def orders_page(spark, sf_dir: str) -> str:
    """The data dictionary of the `orders` extract, as an HTML file."""

    def write(path):
        cells = [
            f"<tr><td>{i}</td><td>{name}</td><td>0</td><td rowspan='1'>{kind}</td><td rowspan='1'>{_description(name, coding)}</td></tr>"
            for i, (name, (kind, coding)) in enumerate(ORDERS_TYPES.items())
        ]
        page = (
            "<table><tr><td>Data columns:</td><td>6</td></tr></table><table><tr><th>Column</th><th>UDI</th><th>Count</th>"
            f"<th>Type</th><th>Description</th></tr>{''.join(cells)}</table><table summary='Coding 21'><tr><th>#</th>"
            "<th>Code</th><th>Meaning</th><tr><td>1</td><td>F</td><td>Filled</td></tr><tr><td>2</td><td>O</td><td>Open</td></tr></table>"
        )
        spark.range(1).select(F.lit(page).alias("value")).coalesce(1).write.text(path)

    return written_once(spark, ("orders page", sf_dir), write)
