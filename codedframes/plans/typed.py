"""The typed extract: scan, missing values, casts and closed value lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import CATEGORICAL_TYPES, MAX_CATEGORIES
from ..functions.text import quote_name, quote_text
from ..operators.casts import (
    NameAt,
    cast_cell,
    category_index,
    category_literals,
    category_value,
    close_domain,
    code_value,
    hashed,
    whole_category,
)
from ..operators.joins import BROADCAST_BYTES, Ask, lookup_columns
from ..operators.order import numbered
from ..operators.types import (
    LIST_CODES,
    missing_types,
    raise_problems,
    resolve_types,
    schema_of,
    storage_fields,
    type_map,
    usable_codes,
)
from ..sources.extract import header_frame, is_cp1252

RESOLVED = ("pos", "udi", "branch", "target", "spark_type", "fmt", "index_type", "Encoding_id", "problem")
#: Extracts of more columns are cast by slices: cells that are treated alike, so many at a time, in one expression.
#: The first is where Spark stops to compile a stage as a whole.
WIDE, SLICE = 100, 256


@dataclass
class ColumnPlan:
    """What was resolved for the columns of an extract.

    `rows` has one entry per column and `lists` the codes of short codings;
    codings in `long_ids` stay in the frame `codes`.
    """

    rows: list
    lists: dict[str, list[str]]
    long_ids: set[str]
    codes: DataFrame


def check_types(
    dictionary: DataFrame, mapping: DataFrame, categorical_types: Sequence[str] = CATEGORICAL_TYPES
) -> None:
    """Raise when the mapping lacks a type the dictionary uses."""
    lacking = [(r["kind"], r["source_type"]) for r in missing_types(dictionary, mapping, categorical_types).take(50)]
    if lacking:
        raise ValueError(f"The type map lacks {sorted(lacking, key=str)}")


def plan_columns(
    spark: SparkSession,
    names: Sequence[str],
    dictionary: DataFrame,
    encodings: DataFrame,
    mapping: DataFrame | None = None,
    categorical_types: Sequence[str] = CATEGORICAL_TYPES,
    max_categories: int = MAX_CATEGORIES,
) -> ColumnPlan:
    """Resolve the columns and fetch what the casts need on the driver.

    That is one small row per column and the short code lists; a Spark schema
    has to be known before a job runs.
    """
    mapping = type_map(spark) if mapping is None else mapping
    resolved = resolve_types(header_frame(spark, names), dictionary, mapping, categorical_types, max_categories)
    required = storage_fields(resolved).select("pos", "nullable")
    rows = resolved.select(*RESOLVED).join(required, "pos").orderBy("pos").collect()
    raise_problems(rows)
    used = sorted({r["Encoding_id"] for r in rows if r["branch"] == "categorical"})
    codes = usable_codes(encodings).where(F.col("encoding_id").isin(used)).select("encoding_id", "pos", "code")
    sizes = {r["encoding_id"]: r["count"] for r in codes.groupBy("encoding_id").count().collect()} if used else {}
    without = [i for i in used if i not in sizes]
    if without:
        raise ValueError(f"No coding table with usable codes for encoding ids {without[:20]}")
    short = [i for i in used if sizes[i] <= LIST_CODES]
    lists: dict[str, list[str]] = {i: [] for i in short}
    if short:
        for r in codes.where(F.col("encoding_id").isin(short)).orderBy("encoding_id", "pos").collect():
            lists[r["encoding_id"]].append(r["code"])
    return ColumnPlan(rows, lists, set(used) - set(short), codes)


@dataclass(frozen=True)
class Treatment:
    """What happens to the cells of a column. Columns of one coding that are stored alike have equal ones."""

    target: str
    spark_type: str
    fmt: str | None
    latin1: bool
    #: Of a categorical column: its coding, what its codes are compared as, and the type of positions where they are stored.
    encoding_id: str | None = None
    compared: str | None = None
    index_type: str | None = None
    joined: bool = False

    @property
    def dated(self) -> bool:
        return self.target in ("date", "day")

    def expression(self, name: str, cell: str, literals: dict) -> str:
        """The value of one column's raw cell."""
        if self.compared is None:
            return cast_cell(name, cell, self.target, self.spark_type, self.fmt, self.latin1)
        value = category_value(cell, self.compared, self.latin1)
        if self.joined:
            return value
        listed = literals[self.encoding_id, self.compared]
        if self.index_type:
            return category_index(value, listed, self.index_type, self.compared)
        value = close_domain(value, listed, self.compared)
        return cast_cell(name, f"({value})", self.target, self.spark_type, self.fmt) if self.dated else value

    def slice_expression(self, names: Sequence[str], cells: str, literals: dict) -> str:
        """The values of several columns' raw cells, given as one array; its size doesn't depend on their number but for their names."""
        at = NameAt(tuple(names))
        if self.compared is None:
            return f"transform({cells}, (x, i) -> {cast_cell(at, 'x', self.target, self.spark_type, self.fmt, self.latin1)})"
        values = f"transform({cells}, x -> {category_value('x', self.compared, self.latin1)})"
        if not self.joined and self.compared != "string":
            # The second reading of the array also keeps the optimiser from moving it into a lambda, where it isn't compiled.
            values = f"transform(transform({cells}, x -> {whole_category('x')}), (y, i) -> coalesce(CAST(y AS {self.compared}), {category_value(f'{cells}[i]', self.compared)}))"
        if self.joined:
            return values
        listed = literals[self.encoding_id, self.compared]
        if not listed:
            return f"transform({cells}, x -> CAST(NULL AS {self.index_type or self.spark_type}))"
        if self.index_type:
            return f"transform({values}, y -> CAST({hashed(listed, self.compared, 'y', range(len(listed)))} AS {self.index_type}))"
        values = f"transform({values}, y -> {hashed(listed, self.compared, 'y')})"
        return f"transform({values}, (x, i) -> {cast_cell(at, 'x', self.target, self.spark_type, self.fmt)})" if self.dated else values


def cast_extract(
    raw: DataFrame,
    plan: ColumnPlan,
    charset: str,
    index_categories: bool = False,
    keep: Sequence[str] = (),
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Raw text cells to typed columns.

    An extract of up to a hundred columns is cast in one projection. A wider one is cast by slices: columns that are treated
    alike share one expression over an array of their cells, with one constant list for each coding, and a second
    projection takes the arrays apart. Its code grows with the treatments and codes, plus one array access a column; a
    cast of its own for each column is more than the JVM will compile. `keep` names columns of `raw` that pass through
    in front.
    """
    latin1, treatments, literals, metadata = is_cp1252(charset), {}, {}, {}
    for r in plan.rows:
        name, dated = r["udi"], r["target"] in ("date", "day")
        if r["branch"] != "categorical":
            treatments[name] = Treatment(r["target"], r["spark_type"], r["fmt"], latin1)
            continue
        compared, coding = "string" if dated else r["spark_type"], r["Encoding_id"]
        index_type = r["index_type"] if index_categories else None
        long = coding in plan.long_ids
        treatments[name] = Treatment(r["target"], r["spark_type"], r["fmt"], latin1, coding, compared, index_type, long)
        metadata[name] = {
            "encoding_id": coding, "stored": "position" if index_categories else "code", "compared": compared,
            "format": r["fmt"] if dated else None,
        }
        if not long:
            if (coding, compared) not in literals:
                literals[coding, compared] = category_literals(plan.lists[coding], compared, name)
            metadata[name]["categories"] = list(dict.fromkeys(plan.lists[coding]))
            check_width(name, len(literals[coding, compared]), index_type)
    out = _cast(raw, treatments, literals, keep)
    out = _close_by_join(out, {n: t for n, t in treatments.items() if t.joined}, plan.codes, max_broadcast_bytes)
    return _describe(out, plan.rows, index_categories, metadata)


def _cast(raw: DataFrame, treatments: dict[str, Treatment], literals: dict, keep: Sequence[str]) -> DataFrame:
    alike: dict[Treatment, list[str]] = {}
    if len(treatments) > WIDE:
        for name, treatment in treatments.items():
            # Columns that can't be missing are cast by themselves, which keeps them so.
            if treatment.target not in ("int", "int64"):
                alike.setdefault(treatment, []).append(name)
    cells, slices, place = [], [], {}
    for treatment, names in alike.items():
        for at in range(0, len(names) if len(names) > 1 else 0, SLICE):
            part = names[at:at + SLICE]
            place.update({name: f"__slice_{len(slices)}[{i}]" for i, name in enumerate(part)})
            cells.append(f"array({', '.join(quote_name(n) for n in part)}) AS __cells_{len(slices)}")
            slices.append(f"{treatment.slice_expression(part, f'__cells_{len(slices)}', literals)} AS __slice_{len(slices)}")
    if slices:
        single = [quote_name(n) for n in [*keep, *treatments] if n not in place]
        raw = raw.selectExpr(*single, *cells).selectExpr(*single, *slices)
    values = [
        f"{place.get(name) or treatment.expression(name, quote_name(name), literals)} AS {quote_name(name)}"
        for name, treatment in treatments.items()
    ]
    return raw.selectExpr(*[quote_name(k) for k in keep], *values)


def _close_by_join(frame: DataFrame, columns: dict[str, Treatment], codes: DataFrame, max_broadcast_bytes: int) -> DataFrame:
    """Closed lists that are too long for literals: one lookup of codes' places for each, joined together."""
    if not columns:
        return frame
    lookups, asks, sizes = {}, [], {}
    for name, t in columns.items():
        kind, of = t.compared, (t.encoding_id, t.compared, t.index_type)
        if of not in lookups:
            message = f"concat({quote_text(f'Column {name}: code ')}, coalesce(code, 'NULL'), {quote_text(' does not fit its coding')})"
            listed = (
                codes.where(F.col("encoding_id") == t.encoding_id)
                .selectExpr(f"coalesce({code_value(kind)}, raise_error({message})) AS value", "pos")
                .groupBy("value").agg(F.min("pos").alias("pos"))
            )
            if t.index_type:
                listed = numbered(listed, [], ["pos"]).select("value", F.col("place").alias("pos"))
                sizes[of] = listed.count()
            lookups[of] = listed.select(_text_key("value", kind).alias("code"), F.col("pos").cast("string").alias("value"))
        if t.index_type:
            check_width(name, sizes[of], t.index_type)
        asks.append(Ask(f"__place {name}", _text_key(quote_name(name), kind), of))
    joined = lookup_columns(frame, asks, lookups, max_broadcast_bytes)
    closed = []
    for name in frame.columns:
        cell, place, value = quote_name(name), quote_name(f"__place {name}"), quote_name(name)
        if t := columns.get(name):
            if t.index_type:
                value = f"CAST({place} AS {t.index_type})"
            else:
                value = f"CASE WHEN {place} IS NOT NULL THEN {cell} END"
                value = cast_cell(name, f"({value})", t.target, t.spark_type, t.fmt) if t.dated else value
        closed.append(f"{value} AS {cell}")
    return joined.selectExpr(*closed)


def _text_key(value: str, kind: str) -> Column:
    return (F.col(value) + F.lit(0.0) if kind == "double" else F.col(value)).cast("string")


INDEX_LIMITS = {"smallint": 1 << 15, "int": 1 << 31, "bigint": 1 << 63}


def check_width(name: str, codes: int, index_type: str | None) -> None:
    """Refuse a list that is longer than the positions of its declared size can hold."""
    if index_type and codes > INDEX_LIMITS[index_type]:
        raise ValueError(f"Column {name}: {codes} codes do not fit positions of type {index_type}; the dictionary declares fewer")


def _describe(frame: DataFrame, rows: Sequence, index_categories: bool, metadata: dict) -> DataFrame:
    """Give the columns their types of the storage schema, and their category lists as metadata.

    The schema and the casts come from the same resolved rows; a cast that gave another type would fail here. The
    aliases on top keep the optimiser from dropping a projection that changes nothing but metadata.
    """
    kinds = [r.asDict() | {"type": r["index_type"] if index_categories and r["branch"] == "categorical" else r["spark_type"]} for r in rows]
    stored = {f.name: f for f in schema_of(kinds, metadata).fields}
    schema = T.StructType([
        T.StructField(f.name, stored[f.name].dataType, True, stored[f.name].metadata) if f.name in stored else f for f in frame.schema.fields
    ])
    names = [quote_name(n) for n in schema.names]
    return frame.to(schema).selectExpr(*[f"{n} AS {n}" for n in names])
