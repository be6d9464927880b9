"""Type resolution: which Spark type every column of an extract gets.

All columns are resolved by one plan over dictionary rows; the outcome has one
row per column and is what a schema is made from.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import (
    CATEGORICAL_TYPES,
    DTYPE_TARGETS,
    MAX_CATEGORIES,
    NULLABLE_TARGETS,
    REQUIRED_TARGETS,
    SPARK_TYPES,
)
from ..functions.text import quote_text
from ..sources.codings import selectable_only
from .order import numbered

PROFILES = {"dtype": DTYPE_TARGETS, "nullable": NULLABLE_TARGETS}
LIST_CODES = 1024
MAP_SCHEMA = "kind string, source_type string, target string, fmt string"
KINDS = ("Type", "Encoding_type")


def type_map(spark: SparkSession, targets: Mapping | str = "dtype") -> DataFrame:
    """A two-level mapping, or the name of a default one, as a frame.

    A value is a target name or a pair of a date target and its format. The
    rows are literals of the plan, so Spark knows how small the frame is and
    broadcasts it by itself.
    """
    levels = PROFILES[targets] if isinstance(targets, str) else targets
    unknown = set(levels) - set(KINDS)
    if unknown:
        raise ValueError(f"A type map has the levels {KINDS}, not {sorted(unknown)}")
    rows = [(kind, name, *_target(value)) for kind in KINDS for name, value in levels.get(kind, {}).items()]
    values = ", ".join(f"({', '.join('null' if v is None else quote_text(v) for v in row)})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(kind, source_type, target, fmt)").to(T.StructType.fromDDL(MAP_SCHEMA))


def _target(value) -> tuple[str, str | None]:
    if isinstance(value, str):
        if value not in SPARK_TYPES or value in ("date", "day"):
            raise ValueError(f"Unknown target type {value!r}")
        return value, None
    if len(value) != 2 or value[0].lower() not in ("date", "day"):
        raise ValueError(f"Invalid date target {value!r}; expected ('Date', format)")
    return value[0].lower(), value[1]


def override_targets(targets: Mapping | str, overrides: Mapping) -> dict:
    """A copy of a mapping with some entries replaced or added."""
    levels = PROFILES[targets] if isinstance(targets, str) else targets
    return {kind: {**levels.get(kind, {}), **overrides.get(kind, {})} for kind in KINDS}


def override_type_map(defaults: DataFrame, overrides: DataFrame) -> DataFrame:
    """The same for frames; `overrides` may carry `priority`, highest wins."""
    if "priority" not in overrides.columns:
        overrides = overrides.withColumn("priority", F.lit(1))
    ranked = defaults.withColumn("priority", F.lit(0)).unionByName(overrides)
    best = F.max_by(F.struct("target", "fmt"), "priority")
    return ranked.groupBy("kind", "source_type").agg(best.alias("best")).select("kind", "source_type", "best.*")


def date_typed_keys(mapping: DataFrame) -> DataFrame:
    """Source types that are dates, with their format."""
    return mapping.where(F.lower("target").isin("date", "day"))


def required_types(dictionary: DataFrame, categorical_types: Iterable[str] = CATEGORICAL_TYPES) -> DataFrame:
    """Source types a mapping must know: `kind, source_type`.

    Non-categorical types under `Type`, value types of categorical columns
    under `Encoding_type`.
    """
    categorical = F.coalesce(F.col("Type").isin(*categorical_types), F.lit(False))
    kind = F.when(categorical, "Encoding_type").otherwise("Type")
    name = F.when(categorical, F.col("Encoding_type")).otherwise(F.col("Type"))
    return dictionary.select(kind.alias("kind"), name.alias("source_type")).distinct()


def missing_types(
    dictionary: DataFrame, mapping: DataFrame, categorical_types: Iterable[str] = CATEGORICAL_TYPES
) -> DataFrame:
    """Required types the mapping lacks."""
    required = required_types(dictionary, categorical_types)
    same = required["kind"].eqNullSafe(mapping["kind"]) & required["source_type"].eqNullSafe(mapping["source_type"])
    return required.join(mapping, same, "left_anti")


def index_bits(members: Column) -> Column:
    """Bits an unsigned index needs for a number of categories."""
    return (
        F.when(members < 1, F.lit(None))
        .when(members <= 2**8, 8)
        .when(members <= 2**16, 16)
        .when(members <= 2**32, 32)
        .when(members.isNotNull(), 64)
        .cast("int")
    )


def index_type(bits: Column) -> Column:
    """Signed Spark type that holds the unsigned index."""
    return F.when(bits == 8, "smallint").when(bits == 16, "int").when(bits.isNotNull(), "bigint")


def _spark_type(target: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in SPARK_TYPES.items() for x in pair])
    return F.try_element_at(names, target)


def first_rows(dictionary: DataFrame) -> DataFrame:
    """One row per column id: its number of rows and its first row."""
    scope = [c for c in ("dict_id",) if c in dictionary.columns]
    others = [c for c in dictionary.columns if c not in (*scope, "UDI")]
    return (
        dictionary.groupBy(*scope, F.col("UDI").alias("udi"))
        .agg(F.count("*").alias("matches"), F.min_by(F.struct(*others), "Column").alias("row"))
        .select(*scope, "udi", "matches", "row.*")
    )


def resolve_types(
    columns: DataFrame,
    dictionary: DataFrame,
    mapping: DataFrame,
    categorical_types: Iterable[str] = CATEGORICAL_TYPES,
    max_categories: int = MAX_CATEGORIES,
) -> DataFrame:
    """Resolve every column of `columns` (`pos, udi`).

    `branch` is `regular`, `categorical` (closed value list) or `oversize` (a
    categorical with too many members, stored as its value type). A column
    that cannot be resolved says why in `problem`.
    """
    scope = [c for c in ("dict_id",) if c in columns.columns and c in dictionary.columns]
    by_type = mapping.where("kind = 'Type'").select(
        F.col("source_type").alias("Type"), F.struct("target", "fmt").alias("by_type")
    )
    by_value = mapping.where("kind = 'Encoding_type'").select(
        F.col("source_type").alias("Encoding_type"), F.struct("target", "fmt").alias("by_value")
    )
    members = F.col("Encoding_num_members")
    categorical = F.coalesce(F.col("Type").isin(*categorical_types), F.lit(False))
    branch = (
        F.when(F.col("matches").isNull(), F.lit(None))
        .when(~categorical, "regular")
        .when(members <= max_categories, "categorical")
        .when(members.isNotNull(), "oversize")
    )
    chosen = F.when(categorical, F.col("by_value")).otherwise(F.col("by_type"))
    problem = (
        F.when(F.col("matches").isNull(), "not in the dictionary")
        .when(F.col("matches") > 1, "more than one dictionary row")
        .when(categorical & (members.isNull() | F.col("Encoding_type").isNull()), "categorical without coding metadata")
        .when(chosen.isNull() & categorical, F.concat(F.lit("no target for coding type "), F.col("Encoding_type")))
        .when(chosen.isNull(), F.concat(F.lit("no target for type "), F.coalesce("Type", F.lit("NULL"))))
    )
    dictionary_columns = ("Type", "Encoding_id", "Encoding_num_members", "Encoding_type", "Is_hierarchical")
    return (
        columns.join(first_rows(dictionary), [*scope, "udi"], "left")
        .join(by_type, "Type", "left")
        .join(by_value, "Encoding_type", "left")
        .select(
            *scope,
            "pos",
            "udi",
            *dictionary_columns,
            branch.alias("branch"),
            chosen["target"].alias("target"),
            chosen["fmt"].alias("fmt"),
            _spark_type(chosen["target"]).alias("spark_type"),
            F.when(branch == "categorical", index_bits(members)).alias("index_bits"),
            F.when(branch == "categorical", index_type(index_bits(members))).alias("index_type"),
            problem.alias("problem"),
        )
    )


def _is_date(target: Column) -> Column:
    return F.coalesce(F.lower(target).isin("date", "day"), F.lit(False))


def value_types(resolved: DataFrame) -> DataFrame:
    """Types of the columns that are read as they are; dates are left out."""
    dated = _is_date(F.col("target")) & (F.col("branch") != "categorical")
    return resolved.where(F.col("problem").isNull() & ~dated)


def date_formats(resolved: DataFrame) -> DataFrame:
    """Date columns and their formats: dates by type, and oversize date codings."""
    dated = _is_date(F.col("target")) & F.col("branch").isin("regular", "oversize")
    return resolved.where(F.col("problem").isNull() & dated).select("pos", "udi", "fmt")


def usable_codes(encodings: DataFrame) -> DataFrame:
    """Codes that may occur in data: headings of hierarchical codings cannot."""
    return selectable_only(encodings) if "selectable" in encodings.columns else encodings


def offered_codes(resolved: DataFrame, encodings: DataFrame) -> DataFrame:
    """Code rows of the codings in use as closed value lists."""
    scope = [c for c in ("dict_id",) if c in resolved.columns and c in encodings.columns]
    used = (
        resolved.where("problem is null and branch = 'categorical'")
        .select(*scope, F.col("Encoding_id").alias("encoding_id"))
        .distinct()
    )
    return usable_codes(encodings).join(used, [*scope, "encoding_id"], "left_semi").select(*scope, "encoding_id", "pos", "code")


def category_lists(offered: DataFrame, max_codes: int = LIST_CODES) -> DataFrame:
    """`encoding_id, part, codes`: each coding's codes as lists, in table order.

    A list has at most `max_codes` codes; a longer coding goes on in further
    parts, counted from 0. No coding and no code is left out.
    """
    keys = [c for c in ("dict_id", "encoding_id") if c in offered.columns]
    pairs = F.sort_array(F.collect_list(F.struct("pos", "code")))
    return (
        numbered(offered, keys, ["pos", "code"]).withColumn("part", F.floor(F.col("place") / max_codes).cast("int"))
        .groupBy(*keys, "part")
        .agg(F.transform(pairs, lambda p: p["code"]).alias("codes"))
    )


def storage_fields(resolved: DataFrame, index_categories: bool = False) -> DataFrame:
    """`pos, name, type, nullable, problem` of the typed extract's columns."""
    indexed = (F.col("branch") == "categorical") & F.lit(index_categories)
    required = (F.col("branch") == "regular") & F.col("target").isin(*REQUIRED_TARGETS)
    empty = indexed & F.col("index_type").isNull()
    return resolved.select(
        "pos", F.col("udi").alias("name"), F.when(indexed, F.col("index_type")).otherwise(F.col("spark_type")).alias("type"),
        (~required).alias("nullable"),
        F.coalesce("problem", F.when(empty, "a category index needs at least one category")).alias("problem"),
    )


def storage_schema(resolved: DataFrame, index_categories: bool = False) -> T.StructType:
    """The schema of the typed extract; one small row per column is collected."""
    rows = storage_fields(resolved, index_categories).withColumnRenamed("name", "udi").orderBy("pos").collect()
    raise_problems(rows)
    return schema_of(rows)


def schema_of(rows, metadata: Mapping[str, dict] | None = None) -> T.StructType:
    """The schema that resolved columns (rows of `storage_fields`, by name `udi`) are stored with."""
    kinds = {kind: T.StructType.fromDDL(f"c {kind}").fields[0].dataType for kind in {r["type"] for r in rows}}
    return T.StructType([T.StructField(r["udi"], kinds[r["type"]], r["nullable"], (metadata or {}).get(r["udi"])) for r in rows])


def raise_problems(rows) -> None:
    """Fail on the columns that could not be resolved."""
    bad = [f"{r['udi']}: {r['problem']}" for r in rows if r["problem"]]
    if bad:
        shown = "; ".join(bad[:20])
        raise ValueError(f"{len(bad)} column(s) could not be resolved: {shown}")
