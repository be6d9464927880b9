"""Queries over the given tables, one per operator, each with its check in SQL."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import entry_data as data  # noqa: E402
from codedframes.functions import describe  # noqa: E402
from codedframes.functions.text import missing_to_null, quote_name  # noqa: E402
from codedframes.operators import casts, lookups, types, validate  # noqa: E402
from codedframes.operators.decode import decode_columns  # noqa: E402
from codedframes.operators.order import first_files, list_files, with_row_index  # noqa: E402
from codedframes.operators.profile import profile_columns  # noqa: E402
from codedframes.plans.convert import convert  # noqa: E402
from codedframes.plans.spec import ConversionSpec  # noqa: E402
from codedframes.plans.typed import cast_extract, plan_columns  # noqa: E402
from codedframes.sinks import parquet as sink  # noqa: E402
from codedframes.sources import codings, extract  # noqa: E402
from codedframes.sources import dictionary as pages  # noqa: E402

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The operators on training text are an optional part: the rest works without their folder.
TEXT_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TEXT_ORACLES: dict[str, str] = {}
try:
    import corpus_pipeline
    from codedframes.llm import queries as text
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "codedframes.llm"):
        raise
else:
    TEXT_QUERIES |= text.QUERIES | {"pipeline": corpus_pipeline.run}
    TEXT_ORACLES |= text.ORACLES
    if corpus_pipeline.ORACLE_SQL is not None:
        TEXT_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def entry(spark: SparkSession) -> DataFrame:
    """Typed load of a stringified `lineitem` with its coded columns decoded."""
    return typed_lineitem(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES) | TEXT_QUERIES


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES) | TEXT_ORACLES


# Pieces of SQL that several checks share.

PART_SQL = """
WITH fields AS (SELECT *, p_partkey // 4 AS f FROM part),
typed AS (
  SELECT *, list_element(['Sequence', 'Integer', 'Continuous', 'Text', 'Date', 'Time', 'Categorical (single)',
                          'Categorical (multiple)', 'Compound', 'Curve'], CAST(f % 10 + 1 AS INT)) AS "Type",
         list_element(['Integer', 'Real', 'String', 'ERROR'], CAST((f // 10) % 4 + 1 AS INT)) AS vt
  FROM fields),
named AS (
  SELECT *, "Type" LIKE 'Categorical%' AS cat, CASE WHEN f % 3 = 0 THEN p_name ELSE 'Measure ' || f END AS name FROM typed),
d AS (
  SELECT p_partkey AS "Column", f || '-' || (p_partkey % 4) || '.0' AS "UDI", CAST(f AS VARCHAR) AS field_id,
         CASE WHEN p_size <> 50 THEN CAST(p_size * 100 AS BIGINT) END AS "Count", "Type", name,
         CASE WHEN cat THEN name || ' Uses data-coding ' || (f // 10 + 5) || ' comprises ' || (f % 40 + 1) || ' ' || vt
                || '-valued members in a ' || CASE WHEN (f // 10) % 5 = 0 THEN 'hierarchical tree' ELSE 'simple list' END || '.'
              ELSE name END AS "Description",
         CASE WHEN cat THEN CAST(f // 10 + 5 AS VARCHAR) END AS "Encoding_id",
         CASE WHEN cat THEN CAST(f % 40 + 1 AS BIGINT) END AS "Encoding_num_members",
         CASE WHEN cat THEN vt END AS "Encoding_type",
         cat AND (f // 10) % 5 = 0 AS "Is_hierarchical", cat AS "Is_categorical", cat AS "Has_encoding"
  FROM named)
"""


def codings_sql(size: int) -> str:
    return f"""e AS (
  SELECT CAST(c_custkey // {size} AS VARCHAR) AS encoding_id, CAST(c_custkey % {size} + 1 AS BIGINT) AS pos,
         CAST(c_custkey AS VARCHAR) AS code,
         c_name || ' <' || c_mktsegment || '> & ' || c_nationkey AS meaning,
         CASE WHEN (c_custkey // {size}) % 5 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS parent_id,
         CASE WHEN (c_custkey // {size}) % 5 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END END AS selectable,
         (c_custkey // {size}) % 5 = 0 AS is_hierarchical
  FROM customer)"""


CODINGS_SQL = codings_sql(30)
FILE_CODINGS_SQL = codings_sql(data.FILE_CODING_SIZE)
BOTH_SQL = f"{PART_SQL}, {CODINGS_SQL}"

ORDERS_SQL = """
SELECT o_orderkey, CASE WHEN o_custkey % 7 > 1 THEN CAST(o_custkey AS DOUBLE) END AS o_custkey,
       CASE WHEN o_custkey % 11 <> 0 AND o_orderstatus IN ('F', 'O') THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_custkey % 13 <> 0 THEN o_totalprice END AS o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderdate, o_orderpriority || ' café €' AS o_orderpriority
FROM orders
"""

ORDERS_TEXT_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_custkey % 7 > 1 THEN CAST(o_custkey AS VARCHAR) END AS o_custkey,
       CASE WHEN o_custkey % 11 <> 0 THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_custkey % 13 <> 0 THEN o_totalprice END AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority || ' café €' AS o_orderpriority
FROM orders
"""


def _text_columns(frame):
    """All cells as text, but for the price: Spark and the check write doubles as text in different ways."""
    return frame.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


# Sources


@query(ORDERS_TEXT_SQL)
def extract_scan(spark, sf_dir):
    """Windows-1252 text cells with missing-value tokens."""
    return _text_columns(extract.read_extract(spark, data.orders_extract(spark, sf_dir)))


@query(ORDERS_TEXT_SQL)
def extract_scan_leading_tab(spark, sf_dir):
    """An empty cell in front of every data row."""
    path = data.orders_extract(spark, sf_dir, leading_tabs=1)
    return _text_columns(extract.read_extract(spark, path, offset=1))


@query(ORDERS_TEXT_SQL)
def extract_scan_trailing_tabs(spark, sf_dir):
    """Two empty cells behind every data row."""
    path = data.orders_extract(spark, sf_dir, trailing_tabs=2)
    return _text_columns(extract.read_extract(spark, path, offset=-2))


@query("""
SELECT 'o_orderkey' AS udi, 0 AS pos, count(o_orderkey) AS non_null FROM orders
UNION ALL SELECT 'o_custkey', 1, count(*) FILTER (WHERE o_custkey % 7 > 1) FROM orders
UNION ALL SELECT 'o_orderstatus', 2, count(*) FILTER (WHERE o_custkey % 11 <> 0) FROM orders
UNION ALL SELECT 'o_totalprice', 3, count(*) FILTER (WHERE o_custkey % 13 <> 0) FROM orders
UNION ALL SELECT 'o_orderdate', 4, count(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderpriority', 5, count(o_orderpriority) FROM orders
""")
def header_scan(spark, sf_dir):
    """Header names with the filled cells below each of them."""
    path = data.orders_extract(spark, sf_dir)
    header = extract.header_frame(spark, extract.read_header(spark, path))
    filled = profile_columns(extract.read_extract(spark, path))
    return header.join(filled.withColumnRenamed("name", "udi"), "udi").select("udi", "pos", "non_null")


@query("""
SELECT CAST(p_partkey // 1000 AS VARCHAR) AS dict_id, k.key, CASE WHEN k.key = 'Data columns:' THEN CAST(count(*) AS VARCHAR)
       ELSE '2020-01-01T00:00:00' END AS value
FROM part, (VALUES ('Date Extracted:'), ('Data columns:')) AS k(key) GROUP BY 1, 2
""")
def dictionary_info(spark, sf_dir):
    """S7."""
    return pages.parse_info(data.dictionary_pages(spark, sf_dir))


@query("""
SELECT CAST(p_partkey // 1000 AS VARCHAR) AS dict_id, p_partkey AS "Column", p_partkey || '-0.0' AS "UDI",
       CAST(p_size AS BIGINT) AS "Count", p_type AS "Type",
       p_brand || ' <x> & y Uses data-coding ' || regexp_replace(p_brand, '[^0-9]', '', 'g')
         || ' comprises 3 Integer-valued members in a simple list.' AS "Description",
       regexp_replace(p_brand, '[^0-9]', '', 'g') AS "Encoding_id", CAST(3 AS BIGINT) AS "Encoding_num_members",
       'Integer' AS "Encoding_type", false AS "Is_hierarchical", false AS "Is_categorical", true AS "Has_encoding"
FROM part
""")
def dictionary_main_table(spark, sf_dir):
    """Main table with row spans, and the derived columns."""
    return pages.parse_dictionary(data.dictionary_pages(spark, sf_dir))


@query("SELECT page_id FROM pages WHERE false")
def pages_without_tables(spark, sf_dir):
    """Web pages that are no dictionaries give no rows."""
    web = data.table(spark, sf_dir, "pages").select(F.col("page_id").alias("dict_id"), "html")
    return pages.parse_dictionary(web).select(F.col("dict_id").alias("page_id"))


@query(f"WITH {CODINGS_SQL} SELECT CAST(CAST(encoding_id AS BIGINT) // 30 AS VARCHAR) AS dict_id, encoding_id, pos, code, meaning FROM e")
def page_codings(spark, sf_dir):
    """S9."""
    return pages.parse_encodings(data.coding_pages(spark, sf_dir))


@query(f"WITH {FILE_CODINGS_SQL} SELECT encoding_id, pos, code, meaning, coalesce(parent_id, '') AS parent_id, coalesce(selectable, '') AS selectable, "
       "CAST(pos + 500 AS VARCHAR) AS node_id FROM e WHERE CAST(encoding_id AS BIGINT) % 3 <> 1")
def file_codings(spark, sf_dir):
    """S10."""
    rows = codings.read_coding_files(spark, data.coding_folder(spark, sf_dir), data.CODING_FOLDER_ID, strict=False)
    return rows.select("encoding_id", "pos", "code", "meaning", "parent_id", "selectable", F.col("others")["node_id"].alias("node_id"))


@query(f"WITH {FILE_CODINGS_SQL} SELECT DISTINCT encoding_id FROM e WHERE CAST(encoding_id AS BIGINT) % 3 = 1")
def rejected_coding_files(spark, sf_dir):
    """S11."""
    texts = codings.read_coding_texts(spark, data.coding_folder(spark, sf_dir), data.CODING_FOLDER_ID)
    return codings.rejected_codings(texts)


ROUTED_SQL = f"""{PART_SQL}, {FILE_CODINGS_SQL},
flags AS (SELECT "Encoding_id" AS encoding_id, arg_min("Is_hierarchical", "Column") AS h FROM d WHERE "Has_encoding" GROUP BY 1),
routed AS (
  SELECT e.encoding_id, pos, code, meaning, h AS is_hierarchical,
         CASE WHEN h THEN coalesce(parent_id, '') END AS parent_id, CASE WHEN h THEN coalesce(selectable, '') END AS selectable
  FROM e JOIN flags USING (encoding_id) WHERE NOT h OR CAST(e.encoding_id AS BIGINT) % 3 <> 1)
"""


def _routed(spark, sf_dir):
    on_page = pages.parse_encodings(data.coding_pages(spark, sf_dir, data.FILE_CODING_SIZE)).drop("dict_id")
    in_files = file_codings(spark, sf_dir).drop("node_id")
    return codings.route_encodings(data.part_dictionary(spark, sf_dir), on_page, in_files)


@query(f"{ROUTED_SQL} SELECT * FROM routed")
def routed_codings(spark, sf_dir):
    """S12."""
    return _routed(spark, sf_dir)


@query(f"{ROUTED_SQL} SELECT encoding_id, h AS is_hierarchical FROM flags WHERE encoding_id NOT IN (SELECT encoding_id FROM routed)")
def unresolved_codings(spark, sf_dir):
    """Codings in use without a table."""
    return codings.unresolved_encodings(data.part_dictionary(spark, sf_dir), _routed(spark, sf_dir))


# Sinks, limits, partitioning


def _written(spark, frame, **options):
    path = data.workspace(spark)
    sink.write_parquet(frame, path, **options)
    return path


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def parquet_round_trip(spark, sf_dir):
    """K1: compressed Parquet, read back."""
    orders = data.table(spark, sf_dir, "orders")
    return spark.read.parquet(_written(spark, orders, settings={"compression": "zstd", "engine": "pyarrow"}))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def guarded_overwrite(spark, sf_dir):
    """K2: a filled folder is refused, then replaced by force."""
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = _written(spark, orders)
    replacement = orders.where("o_orderstatus <> 'F'")
    try:
        sink.write_parquet(replacement, path)
    except OSError:
        sink.write_parquet(replacement, path, force=True)
    return spark.read.parquet(path)


def _orders_scan(spark, path, columns=("o_orderkey", "o_orderdate")):
    names = extract.read_header(spark, path)
    return lambda files: extract.scan_extract(spark, files, names).select(*columns)


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '"' || o_orderpriority ELSE '"' END AS cell
FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def open_quotes(spark, sf_dir):
    """Lines whose last quoted cell has no end; other quoted cells hold tabs and doubled quotes."""
    orders = data.table(spark, sf_dir, "orders")
    last = F.expr("CASE o_orderstatus WHEN 'F' THEN concat('\"', o_orderpriority) WHEN 'O' THEN '\"' ELSE concat('\"', o_orderpriority, '\"') END")
    line = F.concat_ws("\t", F.lit('"tab\t""in"" cell"'), F.lit('""'), F.lit('mid"quote'), last)
    return extract.open_quotes(orders.select("o_orderkey", line.alias("line"))).drop("line")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders ORDER BY orders.o_orderkey LIMIT 100")
def first_rows(spark, sf_dir):
    """K3: the first 100 rows in file order."""
    path = data.orders_extract(spark, sf_dir)
    scan = _orders_scan(spark, path)
    files = first_files(list_files(spark, path), 100, scan)
    return with_row_index(scan(files), "index", 100).drop("index")


@query("SELECT row_number() OVER (ORDER BY orders.o_orderkey) - 1 AS \"index\", CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders")
def row_index(spark, sf_dir):
    """K6: each row's place in file order."""
    path = data.orders_extract(spark, sf_dir)
    return with_row_index(_orders_scan(spark, path, ("o_orderkey",))(path), "index")


@query("SELECT CAST(4 AS BIGINT) AS files, count(*) AS rows FROM orders")
def repartitioned(spark, sf_dir):
    """K4: written as four files."""
    path = _written(spark, sink.repartition(data.table(spark, sf_dir, "orders"), 4))
    return sink.manifest(spark, path).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))


@query("SELECT 'A run' AS description, 'zstd' AS compression, count(*) AS rows FROM orders")
def provenance(spark, sf_dir):
    """K5: settings and row counts, recorded beside the data."""
    path = _written(spark, data.table(spark, sf_dir, "orders"), settings={"compression": "zstd"})
    record = spark.read.json(sink.write_manifest(spark, path, {"compression": "zstd"}, "A run"))
    compression = F.get_json_object("config", "$.compression").alias("compression")
    return record.groupBy("description", compression).agg(F.sum("rows").alias("rows"))


@query(f"""
WITH o AS ({ORDERS_SQL})
SELECT 'values' AS spec, o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM o
UNION ALL
SELECT 'indexed', o_orderkey, CAST(o_custkey AS BIGINT), CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '1' END,
       o_totalprice, o_orderdate, o_orderpriority FROM o
""")
def many_outputs(spark, sf_dir):
    """One extract and its dictionary page, converted twice."""
    base = data.workspace(spark)
    specs = {
        "values": ConversionSpec(f"{base}/values"),
        "indexed": ConversionSpec(f"{base}/indexed", dtype_dict="nullable", index_categories=True),
    }
    written = convert(spark, data.orders_extract(spark, sf_dir), data.orders_page(spark, sf_dir), specs)
    parts = [
        spark.read.parquet(path).selectExpr(
            f"'{name}' AS spec", "o_orderkey", "CAST(o_custkey AS bigint) AS o_custkey",
            "CAST(o_orderstatus AS string) AS o_orderstatus", "o_totalprice",
            "CAST(o_orderdate AS timestamp_ntz) AS o_orderdate", "o_orderpriority",
        )
        for name, path in written.items()
    ]
    return parts[0].unionByName(parts[1])


# Dictionary columns


@query(f'{PART_SQL} SELECT "Column", "UDI", "Count", "Type", "Description", "Encoding_id", "Encoding_num_members", "Encoding_type", '
       '"Is_hierarchical", "Is_categorical", "Has_encoding" FROM d')
def dictionary_columns(spark, sf_dir):
    """D1-D7."""
    return data.part_dictionary(spark, sf_dir)


@query(f'{PART_SQL} SELECT "UDI", field_id, name FROM d')
def field_ids_and_names(spark, sf_dir):
    """D8, D9."""
    return data.part_main_table(spark, sf_dir).select(
        "UDI", describe.field_id(F.col("UDI")).alias("field_id"), describe.readable_name(F.col("Description")).alias("name")
    )


@query(f"WITH {CODINGS_SQL} SELECT encoding_id, pos, code, selectable FROM e WHERE NOT is_hierarchical OR selectable = 'Y'")
def selectable_codes(spark, sf_dir):
    """D10."""
    return codings.selectable_only(data.customer_codings(spark, sf_dir)).select("encoding_id", "pos", "code", "selectable")


# Joins and lookups


def _coding_keys(spark, sf_dir):
    return data.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 97).alias("encoding_id"))


@query(f'{PART_SQL} SELECT DISTINCT CAST(o_custkey % 97 AS VARCHAR) AS key FROM orders WHERE CAST(o_custkey % 97 AS VARCHAR) IN (SELECT "Encoding_id" FROM d)')
def valid_coding_ids(spark, sf_dir):
    """J1."""
    return lookups.valid_encoding_ids(_coding_keys(spark, sf_dir), data.part_dictionary(spark, sf_dir))


@query(f'{PART_SQL} SELECT DISTINCT CAST(o_custkey % 97 AS VARCHAR) AS key FROM orders WHERE NOT EXISTS (SELECT 1 FROM d WHERE "Encoding_id" = CAST(o_custkey % 97 AS VARCHAR))')
def invalid_coding_ids(spark, sf_dir):
    """J1."""
    return lookups.invalid_encoding_ids(_coding_keys(spark, sf_dir), data.part_dictionary(spark, sf_dir))


@query(f'{PART_SQL} SELECT "Encoding_id" AS encoding_id, arg_min("Is_hierarchical", "Column") AS is_hierarchical FROM d WHERE "Encoding_id" IS NOT NULL GROUP BY 1')
def hierarchical_codings(spark, sf_dir):
    """J2."""
    return codings.hierarchical_flags(data.part_dictionary(spark, sf_dir))


@query(f"WITH {CODINGS_SQL} SELECT encoding_id AS key, pos, code, meaning FROM e WHERE CAST(encoding_id AS BIGINT) IN (SELECT o_custkey % 97 FROM orders)")
def coding_tables(spark, sf_dir):
    """J3."""
    found = lookups.encoding_tables(_coding_keys(spark, sf_dir), data.customer_codings(spark, sf_dir))
    return found.select("key", "pos", "code", "meaning")


def _udi_keys(spark, sf_dir):
    part = F.col("l_partkey") * 3
    return data.table(spark, sf_dir, "lineitem").select(
        F.concat(F.floor(part / 4).cast("string"), F.lit("-"), (part % 4).cast("string"), F.lit(".0")).alias("udi")
    )


KEYS_SQL = "keys AS (SELECT DISTINCT (l_partkey * 3 // 4) || '-' || (l_partkey * 3 % 4) || '.0' AS key FROM lineitem)"
FIELD_KEYS_SQL = "keys AS (SELECT DISTINCT CAST(l_partkey * 3 // 4 AS VARCHAR) AS key FROM lineitem)"


@query(f'{BOTH_SQL}, {KEYS_SQL} SELECT key, e.encoding_id, pos, code, meaning FROM keys JOIN d ON key = d."UDI" JOIN e ON e.encoding_id = d."Encoding_id"')
def codings_by_udi(spark, sf_dir):
    """J4."""
    found = lookups.encodings_by_udi(
        _udi_keys(spark, sf_dir), data.part_dictionary(spark, sf_dir), data.customer_codings(spark, sf_dir)
    )
    return found.select("key", "encoding_id", "pos", "code", "meaning")


@query(f'{PART_SQL}, {KEYS_SQL} SELECT key FROM keys WHERE key NOT IN (SELECT "UDI" FROM d)')
def unknown_udis(spark, sf_dir):
    """Column ids the dictionary lacks."""
    keys = _udi_keys(spark, sf_dir)
    return lookups.missing_keys(keys, lookups.encoding_ids_by_udi(keys, data.part_dictionary(spark, sf_dir)), "udi")


FIRST_SQL = """firsts AS (
  SELECT field_id AS key, list("Encoding_id" ORDER BY "Column")[1] AS encoding_id, min("Description") AS low,
         min("Description") <> max("Description") AS ambiguous, min(name) AS name FROM d GROUP BY 1)"""


@query(f"{BOTH_SQL}, {FIELD_KEYS_SQL}, {FIRST_SQL} SELECT key, e.encoding_id, pos, code, meaning FROM keys JOIN firsts USING (key) JOIN e USING (encoding_id)")
def codings_by_field(spark, sf_dir):
    """J5."""
    keys = _udi_keys(spark, sf_dir).select(describe.field_id(F.col("udi")).alias("field_id"))
    found = lookups.encodings_by_field(keys, data.part_dictionary(spark, sf_dir), data.customer_codings(spark, sf_dir))
    return found.select("key", "encoding_id", "pos", "code", "meaning")


@query(f'{PART_SQL}, {KEYS_SQL} SELECT key, name FROM keys JOIN d ON key = "UDI"')
def names_by_udi(spark, sf_dir):
    """J6."""
    return lookups.names_by_udi(_udi_keys(spark, sf_dir), data.part_dictionary(spark, sf_dir))


@query(f"{PART_SQL}, {FIELD_KEYS_SQL}, {FIRST_SQL} SELECT key, CASE WHEN NOT ambiguous THEN name END AS name, ambiguous FROM keys JOIN firsts USING (key)")
def names_by_field(spark, sf_dir):
    """J7."""
    keys = _udi_keys(spark, sf_dir).select(describe.field_id(F.col("udi")).alias("field_id"))
    return lookups.names_by_field(keys, data.part_dictionary(spark, sf_dir))


def _event_header(spark, sf_dir):
    """Header names made of events; brands stand in for dictionary columns."""
    events = data.table(spark, sf_dir, "events")
    header = events.select(F.col("event_id").alias("pos"), F.concat(F.lit("Brand#"), F.col("user_id") % 40).alias("udi"))
    return header


def _brand_dictionary(spark, sf_dir):
    return pages.describe_dictionary(
        data.table(spark, sf_dir, "part").selectExpr(
            "CAST(p_partkey AS string) AS Column", "IF(p_size < 48, concat(p_brand, '/', p_partkey), p_brand) AS UDI",
            "'1' AS Count", "p_type AS Type", "p_name AS Description",
        )
    )


HEADER_SQL = """
WITH h AS (SELECT event_id AS pos, 'Brand#' || (user_id % 40) AS udi FROM events),
b AS (SELECT CASE WHEN p_size < 48 THEN p_brand || '/' || p_partkey ELSE p_brand END AS udi, p_partkey, p_type, p_name FROM part),
n AS (SELECT udi, count(*) AS matches FROM b GROUP BY 1)
"""


@query(f"{HEADER_SQL} SELECT pos, udi, coalesce(matches, 0) AS matches FROM h LEFT JOIN n USING (udi) WHERE coalesce(matches, 0) <> 1")
def header_problems(spark, sf_dir):
    """J8."""
    return validate.header_problems(_event_header(spark, sf_dir), _brand_dictionary(spark, sf_dir))


@query(f'{PART_SQL}, h AS (SELECT event_id AS pos, (event_id // 4) || \'-\' || (event_id % 4) || \'.0\' AS udi FROM events) '
       'SELECT pos, h.udi AS udi, "Column", "Type", "Encoding_id" FROM h JOIN d ON h.udi = d."UDI"')
def header_dictionary_rows(spark, sf_dir):
    """J9."""
    header = data.table(spark, sf_dir, "events").selectExpr(
        "event_id AS pos", "concat(event_id div 4, '-', event_id % 4, '.0') AS udi"
    )
    found = validate.header_rows(header, data.part_dictionary(spark, sf_dir))
    return found.select("pos", "udi", "Column", "Type", "Encoding_id")


def _nation_codings(spark, sf_dir):
    return data.table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").selectExpr(
        "'7' AS encoding_id", "CAST(n_nationkey AS bigint) AS pos", "CAST(n_nationkey AS string) AS code",
        "n_name AS meaning", "false AS is_hierarchical",
    )


DECODE_SQL = """
SELECT c_custkey, c_nationkey, n_name AS c_nationkey_meaning
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) ON c_nationkey = n_nationkey
"""


@query(DECODE_SQL)
def decoded_by_list(spark, sf_dir):
    """A short coding, decoded without a join."""
    customers = data.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return decode_columns(customers, {"c_nationkey": "7"}, _nation_codings(spark, sf_dir))


@query(DECODE_SQL)
def decoded_by_broadcast(spark, sf_dir):
    """A coding that measures small enough to broadcast."""
    customers = data.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return decode_columns(customers, {"c_nationkey": "7"}, _nation_codings(spark, sf_dir), literal_codes=0)


@query("""
SELECT o_orderkey, k AS o_custkey, c_name AS o_custkey_meaning
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS k FROM orders)
LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 5 <> 0) ON k = c_custkey
""")
def decoded_by_shuffle(spark, sf_dir):
    """A coding too large to broadcast, with a third of the rows on one code."""
    orders = data.table(spark, sf_dir, "orders").selectExpr("o_orderkey", "IF(o_orderkey % 3 = 0, 1L, o_custkey) AS o_custkey")
    large = data.table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").selectExpr(
        "'8' AS encoding_id", "c_custkey AS pos", "CAST(c_custkey AS string) AS code", "c_name AS meaning"
    )
    return decode_columns(orders, {"o_custkey": "8"}, large, literal_codes=0, max_broadcast_bytes=0)


SEVEN = {f"k{i}": str(20 + i % 3) for i in range(7)}
SEVEN_SQL = ", ".join(
    f"CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 7 = {i} THEN NULL WHEN o_orderkey % 11 = 0 THEN -1 ELSE (o_custkey * {i + 2}) % 1000 END AS k{i}"
    for i in range(7))


@query(f"""
WITH o AS (SELECT o_orderkey, {SEVEN_SQL} FROM orders),
c AS (SELECT 20 + c_custkey % 3 AS coding, c_custkey AS code, c_name FROM customer)
SELECT o_orderkey, {", ".join(f"o.k{i}, c{i}.c_name AS k{i}_meaning" for i in range(7))}
FROM o {" ".join(f"LEFT JOIN c AS c{i} ON c{i}.coding = {20 + i % 3} AND c{i}.code = o.k{i}" for i in range(7))}
""")
def decoded_seven_by_shuffle(spark, sf_dir):
    """Seven columns of three codings too large to broadcast, with frequent, unknown and missing codes."""
    orders = data.table(spark, sf_dir, "orders").selectExpr("o_orderkey", *[
        f"IF(o_orderkey % 3 = 0, 1L, IF(o_orderkey % 7 = {i}, NULL, IF(o_orderkey % 11 = 0, -1L, (o_custkey * {i + 2}) % 1000))) AS k{i}" for i in range(7)])
    large = data.table(spark, sf_dir, "customer").selectExpr(
        "CAST(20 + c_custkey % 3 AS string) AS encoding_id", "c_custkey AS pos", "CAST(c_custkey AS string) AS code", "c_name AS meaning")
    return decode_columns(orders, SEVEN, large, literal_codes=0, max_broadcast_bytes=0)


# Type resolution


TARGETS_SQL = """
regular AS (SELECT * FROM (VALUES ('Sequence', 'int', NULL), ('Integer', 'float', NULL), ('Continuous', 'float', NULL), ('Text', 'string', NULL),
  ('Date', 'date', '%Y-%m-%d'), ('Time', 'date', '%Y-%m-%d %H:%M:%S'), ('Compound', 'string', NULL), ('Curve', 'string', NULL)) AS t(k, target, fmt)),
coded AS (SELECT * FROM (VALUES ('Integer', 'float', NULL), ('Real', 'float', NULL), ('ERROR', 'date', '%Y-%m-%d'), ('String', 'string', NULL)) AS t(k, target, fmt)),
r AS (
  SELECT "Column" AS pos, "UDI" AS udi, "Encoding_id", "Encoding_num_members" AS n,
         CASE WHEN NOT "Is_categorical" THEN 'regular' WHEN "Encoding_num_members" <= 25 THEN 'categorical' ELSE 'oversize' END AS branch,
         CASE WHEN "Is_categorical" THEN coded.target ELSE regular.target END AS target,
         CASE WHEN "Is_categorical" THEN coded.fmt ELSE regular.fmt END AS fmt
  FROM d LEFT JOIN regular ON regular.k = "Type" LEFT JOIN coded ON coded.k = "Encoding_type"),
s AS (SELECT *, CASE target WHEN 'int' THEN 'bigint' WHEN 'float' THEN 'double' WHEN 'date' THEN 'timestamp_ntz' ELSE 'string' END AS spark_type FROM r)
"""
TYPES_SQL = f"{PART_SQL}, {TARGETS_SQL}"
MAX_CATEGORIES = 25


def _resolved(spark, sf_dir):
    dictionary = data.part_dictionary(spark, sf_dir)
    columns = dictionary.select(F.col("Column").alias("pos"), F.col("UDI").alias("udi"))
    return types.resolve_types(columns, dictionary, types.type_map(spark), max_categories=MAX_CATEGORIES)


@query(f"""{TYPES_SQL} SELECT pos, udi, branch, target, fmt, spark_type,
CASE WHEN branch = 'categorical' THEN CAST(CASE WHEN n <= 256 THEN 8 WHEN n <= 65536 THEN 16 ELSE 32 END AS INT) END AS index_bits,
CASE WHEN branch = 'categorical' THEN CASE WHEN n <= 256 THEN 'smallint' WHEN n <= 65536 THEN 'int' ELSE 'bigint' END END AS index_type
FROM s""")
def resolved_types(spark, sf_dir):
    """T1-T4, T7, T9."""
    return _resolved(spark, sf_dir).select(
        "pos", "udi", "branch", "target", "fmt", "spark_type", "index_bits", "index_type"
    )


@query(f"""{PART_SQL} SELECT "Column" AS pos, "UDI" AS udi, CASE WHEN "Is_categorical" AND "Encoding_type" = 'Real' THEN 'no target for coding type Real'
WHEN "Type" = 'Curve' THEN 'no target for type Curve' ELSE 'categorical without coding metadata' END AS problem
FROM d WHERE ("Is_categorical" AND "Encoding_type" = 'Real') OR "Type" IN ('Curve', 'Text')""")
def type_problems(spark, sf_dir):
    """T5: columns without a type, and why."""
    dictionary = data.part_dictionary(spark, sf_dir)
    columns = dictionary.select(F.col("Column").alias("pos"), F.col("UDI").alias("udi"))
    targets = {kind: {k: v for k, v in level.items() if k not in ("Curve", "Real")} for kind, level in types.DTYPE_TARGETS.items()}
    categorical = (*types.CATEGORICAL_TYPES, "Text")
    resolved = types.resolve_types(columns, dictionary, types.type_map(spark, targets), categorical, MAX_CATEGORIES)
    return resolved.where("problem IS NOT NULL").select("pos", "udi", "problem")


@query(f"""{TYPES_SQL}, {CODINGS_SQL} SELECT e.encoding_id, 0 AS part, string_agg(code, ',' ORDER BY pos) AS codes FROM e
WHERE (NOT is_hierarchical OR selectable = 'Y') AND encoding_id IN (SELECT "Encoding_id" FROM s WHERE branch = 'categorical') GROUP BY 1""")
def category_lists(spark, sf_dir):
    """T6."""
    offered = types.offered_codes(_resolved(spark, sf_dir), data.customer_codings(spark, sf_dir))
    return types.category_lists(offered).select("encoding_id", "part", F.array_join("codes", ",").alias("codes"))


@query("SELECT 'all' AS encoding_id, CAST((c_custkey - (SELECT min(c_custkey) FROM customer)) // 100 AS INT) AS part, "
       "string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS codes FROM customer GROUP BY ALL")
def long_category_lists(spark, sf_dir):
    """One coding of all customers, in parts of a hundred codes."""
    offered = data.table(spark, sf_dir, "customer").selectExpr("'all' AS encoding_id", "c_custkey AS pos", "CAST(c_custkey AS string) AS code")
    return types.category_lists(offered, max_codes=100).select("encoding_id", "part", F.array_join("codes", ",").alias("codes"))


@query(f"""{TYPES_SQL} SELECT pos, udi AS name, CASE WHEN branch = 'categorical' THEN
CASE WHEN n <= 256 THEN 'smallint' WHEN n <= 65536 THEN 'int' ELSE 'bigint' END ELSE spark_type END AS type,
NOT (branch = 'regular' AND target = 'int') AS nullable FROM s""")
def storage_columns(spark, sf_dir):
    """Types and nullability of a typed extract with categories as positions."""
    return types.storage_fields(_resolved(spark, sf_dir), index_categories=True).drop("problem")


@query("""
SELECT 'Type' AS kind, p_type AS source_type, '%d/%m/%Y' AS fmt FROM part GROUP BY p_type HAVING max(p_partkey) % 2 = 0
UNION ALL SELECT * FROM (VALUES ('Type', 'Date', '%Y-%m-%d'), ('Type', 'Time', '%Y-%m-%d %H:%M:%S'), ('Encoding_type', 'ERROR', '%Y-%m-%d')) AS t
""")
def date_typed_keys(spark, sf_dir):
    """Source types that are dates, in any spelling of the word, with their formats."""
    overrides = data.table(spark, sf_dir, "part").selectExpr(
        "'Type' AS kind", "p_type AS source_type", "IF(p_partkey % 2 = 0, 'Date', 'float') AS target",
        "IF(p_partkey % 2 = 0, '%d/%m/%Y', NULL) AS fmt", "CAST(p_partkey + 1 AS int) AS priority",
    )
    return types.date_typed_keys(types.override_type_map(types.type_map(spark), overrides)).select("kind", "source_type", "fmt")


@query(f"{TYPES_SQL} SELECT pos, udi, branch, spark_type FROM s WHERE branch = 'categorical' OR target <> 'date'")
def value_types(spark, sf_dir):
    """Types of the columns that are not parsed as dates."""
    return types.value_types(_resolved(spark, sf_dir)).select("pos", "udi", "branch", "spark_type")


@query(f"{TYPES_SQL} SELECT pos, udi, fmt FROM s WHERE branch <> 'categorical' AND target = 'date'")
def date_formats(spark, sf_dir):
    """T10, T11."""
    return types.date_formats(_resolved(spark, sf_dir))


@query(f'{PART_SQL} SELECT DISTINCT CASE WHEN "Is_categorical" THEN \'Encoding_type\' ELSE \'Type\' END AS kind, '
       'CASE WHEN "Is_categorical" THEN "Encoding_type" ELSE "Type" END AS source_type FROM d')
def required_types(spark, sf_dir):
    """T12."""
    return types.required_types(data.part_dictionary(spark, sf_dir))


@query(f"{PART_SQL} SELECT DISTINCT CASE WHEN \"Is_categorical\" THEN 'Encoding_type' ELSE 'Type' END AS kind, "
       "CASE WHEN \"Is_categorical\" THEN \"Encoding_type\" ELSE \"Type\" END AS source_type FROM d "
       "WHERE CASE WHEN \"Is_categorical\" THEN \"Encoding_type\" ELSE \"Type\" END IN ('Curve', 'Real')")
def missing_types(spark, sf_dir):
    """T13."""
    targets = {kind: {k: v for k, v in level.items() if k not in ("Curve", "Real")} for kind, level in types.DTYPE_TARGETS.items()}
    return types.missing_types(data.part_dictionary(spark, sf_dir), types.type_map(spark, targets))


@query("""
SELECT 'Type' AS kind, p_type AS source_type, arg_max(CASE WHEN p_partkey % 2 = 0 THEN 'float' ELSE 'string' END, p_partkey) AS target, CAST(NULL AS VARCHAR) AS fmt
FROM part GROUP BY p_type
UNION ALL
SELECT * FROM (VALUES ('Type', 'Sequence', 'int', NULL), ('Type', 'Integer', 'float', NULL), ('Type', 'Continuous', 'float', NULL), ('Type', 'Text', 'string', NULL),
  ('Type', 'Date', 'date', '%Y-%m-%d'), ('Type', 'Time', 'date', '%Y-%m-%d %H:%M:%S'), ('Type', 'Compound', 'string', NULL), ('Type', 'Curve', 'string', NULL),
  ('Encoding_type', 'Integer', 'float', NULL), ('Encoding_type', 'Real', 'float', NULL), ('Encoding_type', 'ERROR', 'date', '%Y-%m-%d'),
  ('Encoding_type', 'String', 'string', NULL)) AS t
""")
def type_map_overrides(spark, sf_dir):
    """Later overrides win."""
    overrides = data.table(spark, sf_dir, "part").selectExpr(
        "'Type' AS kind", "p_type AS source_type", "IF(p_partkey % 2 = 0, 'float', 'string') AS target",
        "CAST(NULL AS string) AS fmt", "CAST(p_partkey + 1 AS int) AS priority",
    )
    return types.override_type_map(types.type_map(spark), overrides)


# Casts


def _typed(spark, sf_dir, **options):
    path = data.lineitem_extract(spark, sf_dir)
    names = extract.read_header(spark, path)
    plan = plan_columns(spark, names, data.column_dictionary(spark, data.LINEITEM_TYPES), data.lineitem_codings(spark))
    return cast_extract(extract.scan_extract(spark, path, names), plan, "windows-1252", **options)


LINEITEM_SQL = """
SELECT l_orderkey, CAST(l_partkey AS DOUBLE) AS l_partkey, CAST(l_suppkey AS DOUBLE) AS l_suppkey, {line} AS l_linenumber,
       l_quantity, l_extendedprice, l_discount, l_tax, {flag} AS l_returnflag, l_linestatus,
       CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS l_shipdate{more} FROM lineitem
"""


@query(LINEITEM_SQL.format(
    line="CAST(l_linenumber AS DOUBLE)", flag="CASE WHEN l_returnflag IN ('A', 'R') THEN l_returnflag END",
    more=", 'Line ' || l_linenumber AS l_linenumber_meaning, "
         "CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'R' THEN 'Returned' END AS l_returnflag_meaning"))
def typed_lineitem(spark, sf_dir):
    """Typed load with closed categories, then decoded."""
    return decode_columns(
        _typed(spark, sf_dir), {"l_linenumber": "11", "l_returnflag": "12"}, data.lineitem_codings(spark)
    )


@query(LINEITEM_SQL.format(
    line="CAST(l_linenumber - 1 AS SMALLINT)", flag="CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 END AS SMALLINT)", more=""))
def indexed_lineitem(spark, sf_dir):
    """Categories as positions in their lists."""
    return _typed(spark, sf_dir, index_categories=True)


@query(LINEITEM_SQL.format(
    line="CAST(l_linenumber - 1 AS SMALLINT)", flag="CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 END AS SMALLINT)",
    more=", 'Line ' || l_linenumber AS l_linenumber_meaning, "
         "CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'R' THEN 'Returned' END AS l_returnflag_meaning"))
def decoded_indexed(spark, sf_dir):
    """Positions decoded by their place in the list."""
    typed = _typed(spark, sf_dir, index_categories=True)
    return decode_columns(typed, {"l_linenumber": "11", "l_returnflag": "12"}, data.lineitem_codings(spark))


@query("""
SELECT o_orderkey, CASE WHEN day(o_orderdate) = 1 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS o_orderdate,
       CASE WHEN day(o_orderdate) = 1 THEN 'first of ' || strftime(o_orderdate, '%Y-%m') END AS o_orderdate_meaning FROM orders
""")
def decoded_dates(spark, sf_dir):
    """Dates as codes."""
    kinds = {"o_orderkey": ("Sequence", None), "o_orderdate": ("Categorical (single)", ("31", 200, "ERROR"))}
    cells = data.table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey AS string)", "date_format(o_orderdate, 'yyyy-MM-dd') AS o_orderdate")
    firsts = cells.where("o_orderdate LIKE '%-01'").select("o_orderdate").distinct()
    codes = firsts.selectExpr(
        "'31' AS encoding_id", "CAST(replace(o_orderdate, '-', '') AS bigint) AS pos", "o_orderdate AS code",
        "concat('first of ', left(o_orderdate, 7)) AS meaning", "CAST(NULL AS string) AS selectable", "false AS is_hierarchical")
    plan = plan_columns(spark, cells.columns, data.column_dictionary(spark, kinds), codes)
    return decode_columns(cast_extract(cells, plan, "utf-8"), {"o_orderdate": "31"}, codes)


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS TIMESTAMP) AS moment, CAST(o_custkey AS BIGINT) AS whole, o_totalprice AS number FROM orders")
def cast_cells(spark, sf_dir):
    """Each cast on text made from its column."""
    cells = data.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "date_format(o_orderdate, 'd/M/yyyy') AS day", "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS moment",
        "concat(o_custkey, '.0') AS whole", "CAST(o_totalprice AS string) AS number",
    )
    return cells.selectExpr(
        "o_orderkey", f"{casts.to_day('day', '`day`', '%d/%m/%Y')} AS day",
        f"{casts.to_timestamp('moment', '`moment`', '%Y-%m-%dT%H:%M:%S')} AS moment",
        f"{casts.to_int('whole', '`whole`')} AS whole", f"{casts.to_double('number', '`number`')} AS number",
    )


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag IN ('A', 'R') THEN l_returnflag END AS l_returnflag FROM lineitem")
def closed_domain(spark, sf_dir):
    """C5."""
    literals = casts.category_literals(["A", "R"], "string", "l_returnflag")
    closed = casts.close_domain(casts.category_value("l_returnflag", "string"), literals, "string")
    return data.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{closed} AS l_returnflag")


COPIES = 500


COPIES_SQL = """
WITH cells AS (
  SELECT l_orderkey, l_linenumber, [x FOR x IN [(l_partkey + 7 * i) % 2000 FOR i IN range({0})] IF x < 1024] AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN len(c) > 0 THEN list_sum(c) END AS {1}) AS total, CAST(len(c) AS BIGINT) AS n FROM cells
"""


def _many_columns(spark, sf_dir, index_categories):
    """500 columns of one coding of 1,024 codes; the sum and number of what is kept in a row."""
    names = [f"{i}-0.0" for i in range(COPIES)]
    keys = ["l_orderkey", "l_linenumber"]
    kinds = {k: ("Sequence", None) for k in keys} | {n: ("Categorical (single)", ("41", 1024, "Integer")) for n in names}
    cells = data.table(spark, sf_dir, "lineitem").selectExpr(
        *[f"CAST({k} AS string) AS {k}" for k in keys], *[f"CAST((l_partkey + {7 * i}) % 2000 AS string) AS `{n}`" for i, n in enumerate(names)])
    codes = spark.range(1024).selectExpr(
        "'41' AS encoding_id", "id AS pos", "CAST(id AS string) AS code", "CAST(id AS string) AS meaning", "CAST(NULL AS string) AS selectable",
        "false AS is_hierarchical")
    plan = plan_columns(spark, cells.columns, data.column_dictionary(spark, kinds), codes, max_categories=1024)
    typed = cast_extract(cells, plan, "utf-8", index_categories)
    kind = "bigint" if index_categories else "double"
    total = _added([f"coalesce(CAST({quote_name(n)} AS {kind}), CAST(0 AS {kind}))" for n in names])
    kept = typed.selectExpr(*keys, f"{total} AS total", f"{_added([f'IF({quote_name(n)} IS NULL, 0L, 1L)' for n in names])} AS n")
    return kept.selectExpr(*keys, "IF(n = 0, NULL, total) AS total", "n")


def _added(terms: list[str]) -> str:
    """The sum of the terms, with no deep nesting: it is compiled in small methods, as an array of many columns is not."""
    while len(terms) > 1:
        terms = [f"({' + '.join(terms[i:i + 8])})" for i in range(0, len(terms), 8)]
    return terms[0]


@query(COPIES_SQL.format(COPIES, "DOUBLE"))
def closed_domain_of_many_columns(spark, sf_dir):
    """500 columns of one coding, cast by slices that share its list."""
    return _many_columns(spark, sf_dir, False)


@query(COPIES_SQL.format(COPIES, "BIGINT"))
def positions_of_many_columns(spark, sf_dir):
    """The same columns as positions in the list."""
    return _many_columns(spark, sf_dir, True)


PROFILED = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS name, '{kind}' AS dtype, count({name}) FILTER (WHERE l_linenumber <> {i + 1}) AS non_null FROM lineitem"
    for i, (name, kind) in enumerate(PROFILED.items())))
def column_profile(spark, sf_dir):
    """C8."""
    return profile_columns(data.table(spark, sf_dir, "lineitem").selectExpr(
        *[f"CAST(IF(l_linenumber <> {i + 1}, {name}, NULL) AS {kind}) AS {name}" for i, (name, kind) in enumerate(PROFILED.items())]
    ))


@query("SELECT doc_id, CASE WHEN lang IN ('', 'NA', 'nan', 'null', 'None') THEN NULL ELSE lang END AS lang, "
       "CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN text END AS text FROM documents")
def missing_tokens(spark, sf_dir):
    """Tokens among whole texts."""
    cells = data.table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "lang", "CASE doc_id % 3 WHEN 0 THEN '#N/A' WHEN 1 THEN text ELSE '-1.#IND' END AS text"
    )
    return cells.selectExpr("doc_id", *[f"{missing_to_null(quote_name(c))} AS {c}" for c in ("lang", "text")])
