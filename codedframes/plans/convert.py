"""From a tab-separated extract and its dictionary to typed Parquet."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.order import first_files, list_files, with_row_index
from ..operators.types import type_map
from ..sinks.parquet import check_output, check_outputs_apart, repartition, write_manifest, write_parquet
from ..sources.codings import ID_PATTERN, read_coding_files, route_encodings
from ..sources.dictionary import parse_dictionary, parse_encodings, read_pages
from ..sources.extract import check_quotes, read_header, scan_extract
from .spec import ConversionSpec
from .typed import ColumnPlan, cast_extract, check_types, plan_columns

INDEX = "index"


def load_dictionary(
    spark: SparkSession, dictionary_path: str, coding_path: str | None = None, id_pattern: str = ID_PATTERN
) -> tuple[DataFrame, DataFrame]:
    """Dictionary and coding tables as two small cached frames."""
    pages = read_pages(spark, dictionary_path)
    dictionary = parse_dictionary(pages).drop("dict_id").persist()
    on_page = parse_encodings(pages).drop("dict_id")
    if coding_path is None:
        in_files = spark.sql(
            "SELECT '' AS encoding_id, 0L AS pos, '' AS code, '' AS meaning, '' AS parent_id, '' AS selectable WHERE false"
        )
    else:
        in_files = read_coding_files(spark, coding_path, id_pattern)
    return dictionary, route_encodings(dictionary, on_page, in_files).persist()


def resolution_key(names: Sequence[str], spec: ConversionSpec) -> str:
    """Specs of equal keys resolve the columns alike: same names, type map, categorical types and largest list."""
    return json.dumps([list(names), spec.dtype_dict, list(spec.categorical_type), spec.max_categories], sort_keys=True, default=list)


def resolve(spark: SparkSession, names: Sequence[str], dictionary: DataFrame, encodings: DataFrame, spec: ConversionSpec) -> ColumnPlan:
    """What a spec needs of dictionary and codings to type the columns; it holds no rows of the extract."""
    mapping = type_map(spark, spec.dtype_dict)
    check_types(dictionary, mapping, spec.categorical_type)
    return plan_columns(spark, names, dictionary, encodings, mapping, spec.categorical_type, spec.max_categories)


def typed_extract(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Sequence[str],
    dictionary: DataFrame,
    encodings: DataFrame,
    spec: ConversionSpec,
    plan: ColumnPlan | None = None,
    checked: set[str] | None = None,
) -> DataFrame:
    """The extract with all types applied, lazily; first rows and index if asked for.

    `plan` is a resolution made before, `checked` holds the charsets in which all lines' quotes were checked before.
    """
    plan = plan or resolve(spark, names, dictionary, encodings, spec)

    def scan(files):
        return scan_extract(spark, files, names, spec.tab_offset, spec.encoding)

    keep = [INDEX] if spec.row_index else []
    files = first_files(list_files(spark, path), spec.nrows, scan) if spec.nrows else path
    if spec.check_quotes and spec.encoding not in (checked or ()):
        # Every file begins with its header; a cut last line lies behind the first rows.
        check_quotes(spark, files, spec.encoding, spec.nrows + len(files) if spec.nrows else 0)
        if checked is not None and not spec.nrows:
            checked.add(spec.encoding)
    if spec.nrows:
        raw = with_row_index(scan(files), INDEX, spec.nrows)
    elif spec.row_index:
        raw = with_row_index(scan(path), INDEX)
    else:
        raw = scan(path)
    return cast_extract(raw, plan, spec.encoding, spec.index_categories, keep)


def convert(
    spark: SparkSession,
    extract_path: str,
    dictionary_path: str,
    specs: Mapping[str, ConversionSpec] | Sequence[ConversionSpec],
    coding_path: str | None = None,
    id_pattern: str = ID_PATTERN,
) -> dict[str, str]:
    """Write one Parquet folder per spec and return `name: folder`.

    Dictionary, codings and header are read once for all specs, specs with the
    same types are resolved once, and every spec is resolved and every output
    folder checked before the first write. The
    extract itself is scanned per spec: keeping a copy of its text would cost
    more than reading it again.
    """
    named = dict(specs) if isinstance(specs, Mapping) else {str(i): s for i, s in enumerate(specs)}
    inputs = tuple(p for p in (extract_path, dictionary_path, coding_path) if p)
    check_outputs_apart(spark, {name: spec.out_path for name, spec in named.items()})
    for spec in named.values():
        check_output(spark, spec.out_path, spec.force, inputs)
    dictionary, encodings = load_dictionary(spark, dictionary_path, coding_path, id_pattern)
    headers: dict[str, list[str]] = {}
    try:
        typed, plans, checked = {}, {}, set()
        for name, spec in named.items():
            if spec.encoding not in headers:
                headers[spec.encoding] = read_header(spark, extract_path, spec.encoding)
            names = headers[spec.encoding]
            key = resolution_key(names, spec)
            if key not in plans:
                plans[key] = resolve(spark, names, dictionary, encodings, spec)
            typed[name] = typed_extract(spark, extract_path, names, dictionary, encodings, spec, plans[key], checked)
        for name, spec in named.items():
            frame = repartition(typed[name], spec.npartitions)
            write_parquet(frame, spec.out_path, spec.settings, spec.force, inputs)
            record = {"extract": extract_path, "dictionary": dictionary_path, "codings": coding_path, **spec.as_config()}
            write_manifest(spark, spec.out_path, record, spec.description)
    finally:
        dictionary.unpersist()
        encodings.unpersist()
    return {name: spec.out_path for name, spec in named.items()}
