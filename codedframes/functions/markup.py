"""HTML table pieces as Column expressions (no parser, no Python per row)."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import CP1252_BYTES, CP1252_TEXT

_ENTITY = r"^&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);$"


def _named_entities() -> Column:
    """Map of the HTML 4 entity names, built from the standard library."""
    names = {**name2codepoint, "apos": ord("'")}
    text = "\x02".join(f"{name}\x01{chr(code)}" for name, code in names.items())
    return F.str_to_map(F.lit(text), F.lit("\x02"), F.lit("\x01"))


def _character(code_point: Column) -> Column:
    known = ~(code_point.between(0xD800, 0xDFFF) | (code_point > 0x10FFFF) | (code_point == 0))
    safe = F.when(known, code_point).otherwise(F.lit(0xFFFD))
    char = F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")
    return F.translate(char, CP1252_BYTES, CP1252_TEXT)


def unescape(text: Column) -> Column:
    """Replace character references once, from left to right."""
    named = _named_entities()

    def decode(piece: Column) -> Column:
        name = F.regexp_extract(piece, _ENTITY, 1)
        return (
            F.when(name == "", piece)
            .when(F.lower(name).startswith("#x"), _character(F.conv(F.substr(name, F.lit(3)), 16, 10).cast("bigint")))
            .when(name.startswith("#"), _character(F.substr(name, F.lit(2)).try_cast("bigint")))
            .otherwise(F.coalesce(F.try_element_at(named, name), piece))
        )

    pieces = F.split(text, r"(?=&)|(?<=;)")
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, decode), "")).otherwise(text)


def cell_text(raw: Column) -> Column:
    """Text of a cell: breaks become blanks, tags go, blanks collapse."""
    spaced = F.regexp_replace(raw, r"(?i)<br\b[^>]*>", " ")
    bare = F.regexp_replace(spaced, r"</?[A-Za-z][^>]*>", "")
    return F.trim(F.regexp_replace(unescape(bare), r"(?U)\s+", " "))


def tables(html: Column) -> Column:
    """All tables of a page, in order, each from its opening tag on."""
    visible = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    return F.regexp_extract_all(visible, F.lit(r"(?is)<table\b.*?(?=</table|<table\b|\z)"), F.lit(0))


def rows(table: Column) -> Column:
    """Row bodies. Splitting on the opening tag also copes with unclosed rows."""
    parts = F.split(table, r"(?i)<tr\b[^>]*>")
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))


def cells(row: Column) -> Column:
    """Cells of a row as an array of (span, text)."""
    pattern = r"(?is)<t[dh]\b([^>]*)>(.*?)(?=<t[dh]\b|</t[dhr]\b|\z)"
    attributes = F.regexp_extract_all(row, F.lit(pattern), F.lit(1))
    bodies = F.regexp_extract_all(row, F.lit(pattern), F.lit(2))

    def cell(attribute: Column, body: Column) -> Column:
        span = F.regexp_extract(attribute, r"(?i)\browspan\s*=\s*[\"']?\s*(\d{1,9})", 1)
        return F.named_struct(
            F.lit("span"), F.coalesce(span.try_cast("int"), F.lit(1)), F.lit("text"), cell_text(body)
        )

    return F.zip_with(attributes, bodies, cell)


def texts(row: Column) -> Column:
    return F.transform(cells(row), lambda c: c["text"])


def is_data_row(row: Column) -> Column:
    return row.rlike(r"(?i)<td\b")


def header_names(table_rows: Column) -> Column:
    """Cell texts of the first row that has header cells."""
    heads = F.filter(table_rows, lambda r: r.rlike(r"(?i)<th\b"))
    return F.coalesce(texts(F.try_element_at(heads, F.lit(1))), F.array().cast("array<string>"))


def attribute(table: Column, name: str) -> Column:
    """Attribute of a table's opening tag, '' when absent."""
    return F.regexp_extract(table, rf"(?is)^<table\b[^>]*\b{name}\s*=\s*[\"']([^\"']*)[\"']", 1)


def pick(values: Column, names: Column, name: str) -> Column:
    """The value under the header `name`, NULL when there is none."""
    at = F.array_position(names, name).cast("int")
    return F.try_element_at(values, F.when(at > 0, at))


def span_groups(data_rows: Column, width: Column) -> Column:
    """Cut rows into runs that start with a full row.

    A row span cannot reach into a row that has all its own cells, so every run
    can be expanded on its own.
    """
    starts = F.filter(
        F.transform(data_rows, lambda r, i: F.when((i == 0) | (F.size(r) >= width), i + 1)),
        lambda i: i.isNotNull(),
    )
    ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.size(data_rows) + 1))
    runs = F.zip_with(starts, ends, lambda a, b: F.slice(data_rows, a, b - a))
    return F.when((width > 0) & (F.size(data_rows) > 0), runs)


def expand_spans(group: str, width: str) -> Column:
    """Give every row of a run all its cells, copying spanned ones downward.

    `group` and `width` are column names: array<array<struct<span,text>>> and int.
    """
    slot = "array<struct<span:int,text:string>>"
    return F.expr(f"""
        aggregate(
          {group},
          named_struct('held', cast(transform(sequence(1, {width}),
                                    i -> named_struct('span', 0, 'text', cast(null as string))) as {slot}),
                       'done', cast(array() as array<array<string>>)),
          (state, own) -> transform(array(
              aggregate(
                sequence(1, {width}),
                named_struct('next', 1, 'held', cast(array() as {slot})),
                (walk, i) -> IF(
                  state.held[i - 1].span > 0,
                  named_struct('next', walk.next,
                    'held', cast(concat(walk.held, array(named_struct(
                        'span', state.held[i - 1].span - 1, 'text', state.held[i - 1].text))) as {slot})),
                  named_struct('next', walk.next + 1,
                    'held', cast(concat(walk.held, array(named_struct(
                        'span', coalesce(try_element_at(own, walk.next).span, 1) - 1,
                        'text', try_element_at(own, walk.next).text))) as {slot}))))),
            walked -> named_struct(
              'held', walked.held,
              'done', cast(concat(state.done, array(transform(walked.held, c -> c.text))) as array<array<string>>)))[0],
          state -> state.done)
    """)
