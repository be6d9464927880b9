"""Lookups in one dictionary, key by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import lookups as L
from .plans.convert import load_dictionary
from .sources.codings import ID_PATTERN
from .sources.dictionary import parse_info, read_pages


class CodedDictionary:
    """A dictionary file and its codings as frames, with single-key lookups."""

    def __init__(
        self, spark: SparkSession, path: str, coding_path: str | None = None, id_pattern: str = ID_PATTERN
    ):
        if not path.endswith(".html"):
            raise ValueError(f"A dictionary is an HTML file, not {path}")
        self.spark = spark
        self.path = path
        self.main_table, self.encodings = load_dictionary(spark, path, coding_path, id_pattern)

    @property
    def info(self) -> dict[str, str]:
        return {r["key"]: r["value"] for r in parse_info(read_pages(self.spark, self.path)).collect()}

    def _key(self, value) -> DataFrame:
        return self.spark.range(1).select(F.lit(str(value)).alias("key"))

    def _table(self, rows: DataFrame, what: str) -> DataFrame:
        first = rows.orderBy("pos").first()
        if first is None:
            raise ValueError(f"No coding table for {what}")
        # A coding from a file has all columns of the file; one on the page has these three.
        more = [F.col(c) for c in ("parent_id", "selectable") if first.asDict().get(c) is not None]
        more += [F.col("others")[name].alias(name) for name in first.asDict().get("others") or {}]
        return rows.orderBy("pos").select(
            F.col("pos").alias("#"), F.col("code").alias("Code"), F.col("meaning").alias("Meaning"), *more)

    def get_encoding_table(self, encoding_id) -> DataFrame:
        """`#, Code, Meaning` of a coding; a number and its text are the same id."""
        return self._table(L.encoding_tables(self._key(encoding_id), self.encodings, "key"), f"encoding id {encoding_id}")

    def get_encoding_by_data_field(self, field_id: str, is_udi: bool = True) -> DataFrame:
        """`#, Code, Meaning` for a column id, or for a field id."""
        lookup = L.encodings_by_udi if is_udi else L.encodings_by_field
        what = f"{'column' if is_udi else 'field'} id {field_id}"
        return self._table(lookup(self._key(field_id), self.main_table, self.encodings, "key"), what)

    def get_human_readable_name(self, field_id: str, is_udi: bool = True) -> str:
        """Readable name of a column id, or of a field id whose columns agree."""
        lookup = L.names_by_udi if is_udi else L.names_by_field
        found = lookup(self._key(field_id), self.main_table, "key").take(2)
        if not found:
            raise ValueError(f"Field ID {field_id} is not in the dictionary")
        if len(found) > 1 or (not is_udi and found[0]["ambiguous"]):
            raise ValueError(f"Field ID {field_id} is ambiguous: its names differ")
        return found[0]["name"]
