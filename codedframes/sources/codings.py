"""Coding tables kept in files, and the choice between file and page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import BAD_DOWNLOAD_TEXT, CODING_FILE_SKIP_LINES
from ..functions.markup import pick

ID_PATTERN = r"encoding_table_(.+)\.txt$"


def read_coding_texts(spark: SparkSession, path: str, id_pattern: str = ID_PATTERN) -> DataFrame:
    """Coding files as `encoding_id, content`, the id taken from the file path.

    A file is one coding table of bounded size, hence one row.
    """
    location = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.regexp_extract(location, id_pattern, 1).alias("encoding_id"), F.col("value").alias("content")
    )


def rejected_codings(texts: DataFrame) -> DataFrame:
    """Files that hold the download-error page instead of a table."""
    return texts.where(F.col("content").contains(BAD_DOWNLOAD_TEXT)).select("encoding_id")


def parse_coding_texts(
    texts: DataFrame, skip_lines: int = CODING_FILE_SKIP_LINES, strict: bool = True
) -> DataFrame:
    """`encoding_id, pos, code, meaning, parent_id, selectable, others`.

    `others` maps the header's other names, such as `node_id`, to their cells,
    so nothing of a file is lost. The header is the line after `skip_lines`. A file with the download-error
    page fails the job when `strict`, else it is left out.
    """
    bad = F.col("content").contains(BAD_DOWNLOAD_TEXT)
    if strict:
        message = F.concat(F.lit("Coding file holds a download error, encoding id "), F.col("encoding_id"))
        texts = texts.withColumn("content", F.when(bad, F.raise_error(message)).otherwise(F.col("content")))
    else:
        texts = texts.where(~bad)
    lines = F.split("content", r"\r?\n")
    body = F.filter(F.slice(F.col("lines"), skip_lines + 2, F.size("lines")), lambda s: F.trim(s) != "")
    fields = F.col("fields")

    def named(name: str) -> Column:
        return pick(fields, F.col("names"), name).alias(name)

    return (
        texts.select("encoding_id", lines.alias("lines"))
        .select(
            "encoding_id",
            _fields(F.try_element_at(F.col("lines"), F.lit(skip_lines + 1))).alias("names"),
            body.alias("body"),
        )
        .select("encoding_id", "names", F.posexplode("body").alias("at", "line"))
        .select("encoding_id", "names", "at", _fields(F.col("line")).alias("fields"))
        .select(
            "encoding_id",
            (F.col("at") + 1).cast("bigint").alias("pos"),
            named("coding").alias("code"),
            named("meaning"),
            named("parent_id"),
            named("selectable"),
            _others(F.col("names"), fields).alias("others"),
        )
    )


def _others(names: Column, fields: Column) -> Column:
    known = F.array(*[F.lit(n) for n in ("coding", "meaning", "parent_id", "selectable")])
    pairs = F.transform(names, lambda n, i: F.struct(n.alias("name"), F.get(fields, i).alias("cell")))
    return F.map_from_entries(F.filter(pairs, lambda p: p["name"].isNotNull() & ~F.array_contains(known, p["name"])))


def _fields(line: Column) -> Column:
    """Tab-separated fields, without the quotes around quoted ones."""
    quoted = r'^"(.*)"$'
    return F.transform(
        F.split(line, "\t"),
        lambda f: F.when(f.rlike(quoted), F.replace(F.regexp_extract(f, quoted, 1), F.lit('""'), F.lit('"'))).otherwise(f),
    )


def read_coding_files(
    spark: SparkSession,
    path: str,
    id_pattern: str = ID_PATTERN,
    skip_lines: int = CODING_FILE_SKIP_LINES,
    strict: bool = True,
) -> DataFrame:
    return parse_coding_texts(read_coding_texts(spark, path, id_pattern), skip_lines, strict)


def hierarchical_flags(dictionary: DataFrame) -> DataFrame:
    """One row per coding: the flag of its first dictionary row."""
    scope = [c for c in ("dict_id",) if c in dictionary.columns]
    return (
        dictionary.where(F.col("Encoding_id").isNotNull())
        .groupBy(*scope, F.col("Encoding_id").alias("encoding_id"))
        .agg(F.min_by("Is_hierarchical", "Column").alias("is_hierarchical"))
    )


def route_encodings(dictionary: DataFrame, page_codings: DataFrame, file_codings: DataFrame) -> DataFrame:
    """Coding tables the dictionary uses: hierarchical ones from the files, the
    others from the page."""
    flags = hierarchical_flags(dictionary)
    scope = [c for c in ("dict_id",) if c in flags.columns and c in page_codings.columns]
    keys = [*scope, "encoding_id"]
    from_page = page_codings.join(flags.where("not is_hierarchical").select(keys), keys, "left_semi")
    from_file = file_codings.join(flags.where("is_hierarchical").select(keys), "encoding_id")
    return from_page.withColumn("is_hierarchical", F.lit(False)).unionByName(
        from_file.withColumn("is_hierarchical", F.lit(True)), allowMissingColumns=True
    )


def unresolved_encodings(dictionary: DataFrame, encodings: DataFrame) -> DataFrame:
    """Codings the dictionary uses for which no table was found."""
    flags = hierarchical_flags(dictionary)
    keys = [c for c in flags.columns if c in encodings.columns and c != "is_hierarchical"]
    return flags.join(encodings.select(keys).distinct(), keys, "left_anti")


def selectable_only(encodings: DataFrame) -> DataFrame:
    """Drop the headings of hierarchical codings."""
    return encodings.where("not is_hierarchical or selectable = 'Y'")
