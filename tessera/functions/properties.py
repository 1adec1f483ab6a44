"""Typed page properties (JSON objects whose type names the member that holds the value), read and written.

A property is read as a VARIANT and dispatched by its type, so that a value keeps its kind; what is built for writing is
JSON text.  All are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import text as X

#: The types that can be written, and the texts that a checkbox takes as true.
WRITABLE = ("title", "rich_text", "number", "select", "multi_select", "date", "url", "checkbox")
TRUE = ("true", "yes", "si", "sì", "1")

_PARTS = "array<struct<plain_text: string, text: struct<content: string>>>"
_NULLS = {"ignoreNullFields": "false"}


def _let(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _type(prop: Column) -> Column:
    return F.try_variant_get(prop, "$.type", "string")


def _held(prop: Column) -> Column:
    """The member that the type names; types are plain words, anything else names nothing."""
    kind = _type(prop)
    return F.try_variant_get(prop, F.when(kind.rlike(r"^\w+$"), F.concat(F.lit("$."), kind)), "variant")


def _plain(value: Column) -> Column:
    parts = F.coalesce(F.try_variant_get(value, "$", _PARTS), F.array().cast(_PARTS))
    return F.array_join(F.transform(parts, lambda p: F.coalesce(F.nullif(p["plain_text"], F.lit("")), p["text"]["content"], F.lit(""))), "")


def _names(value: Column) -> Column:
    named = F.coalesce(F.try_variant_get(value, "$", "array<struct<name: string>>"), F.array().cast("array<struct<name: string>>"))
    return F.transform(named, lambda x: F.coalesce(x["name"], F.lit("")))


def _ids(value: Column) -> Column:
    named = F.coalesce(F.try_variant_get(value, "$", "array<struct<id: string>>"), F.array().cast("array<struct<id: string>>"))
    return F.filter(F.transform(named, lambda x: x["id"]), lambda x: F.coalesce(x != "", F.lit(False)))


def _decoded(prop: Column, formulas: int) -> Column:
    return _let(_held(prop), lambda value: _of_type(_type(prop), value, formulas))


def _of_type(kind: Column, value: Column, formulas: int) -> Column:
    out = (
        F.when(kind.isin("title", "rich_text"), _plain(value).cast("variant"))
        .when(kind.isin("select", "status"), F.coalesce(F.try_variant_get(value, "$.name", "string"), F.lit("")).cast("variant"))
        .when(kind == "multi_select", _names(value).cast("variant"))
        .when(kind == "relation", _ids(value).cast("variant"))
        .when(kind == "date", F.when(value.isNull() | F.is_variant_null(value), F.parse_json(F.lit("{}"))).otherwise(value))
    )
    if formulas:
        out = out.when(kind == "formula", _decoded(value, formulas - 1))
    return out.otherwise(F.when(~F.is_variant_null(value), value))


def decoded(prop: Column) -> Column:
    """The value of a property (JSON text) as a VARIANT.  title and rich_text: their parts joined (of a part its plain text,
    where that is empty or missing its content); select and status: the name, '' without one; multi_select: the names;
    relation: the ids that aren't empty; date: the object, {} without one; formula: the value of the property it holds,
    itself perhaps a formula; any other type (number, checkbox, url, people, files, ...): the value as it is.  Null where
    the value is null, the type is missing or the text isn't JSON."""
    return _let(F.try_parse_json(prop), lambda p: _decoded(p, 2))


def decoded_text(prop: Column) -> Column:
    """The decoded value as text for comparisons: strings as they are, lists joined by ', ', dates by their start, others
    as JSON."""
    return _let(decoded(prop), _as_text)


def _as_text(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    listed = F.array_join(F.try_variant_get(value, "$", "array<string>"), ", ")
    return (
        F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
        .when(kind.startswith("ARRAY"), F.coalesce(listed, F.to_json(value)))
        .when(kind.startswith("OBJECT"), F.coalesce(F.try_variant_get(value, "$.start", "string"), F.nullif(F.to_json(value), F.lit("{}"))))
        .otherwise(F.to_json(value))
    )


def payload(kind: Column, value: Column) -> Column:
    """What writes a value (text) to a property of a type that can be written, as JSON text; null for other types, and for
    a number that isn't one.  A null title or text is the word None; an empty number, select, date or url is null; a
    multi_select is split at , ; • | and /; a checkbox is true for the fixed words in any case."""
    js = lambda c: F.to_json(c, _NULLS)
    some = F.nullif(value, F.lit(""))
    content = F.array(F.struct(F.lit("text").alias("type"), F.struct(F.coalesce(value, F.lit("None")).alias("content")).alias("text")))
    number = X.strip(value).try_cast("double")
    named = F.transform(X.split_multi(F.coalesce(value, F.lit("None"))), lambda x: F.struct(x.alias("name")))
    start = F.when(some.isNotNull(), F.struct(some.alias("start")))
    choice = F.when(some.isNotNull(), F.struct(some.alias("name")))
    true = F.coalesce(F.lower(X.strip(value)).isin(*TRUE), F.lit(False))
    return (
        F.when(kind == "title", js(F.struct(content.alias("title"))))
        .when(kind == "rich_text", js(F.struct(content.alias("rich_text"))))
        .when((kind == "number") & (some.isNull() | (number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf")))), js(F.struct(number.alias("number"))))
        .when(kind == "select", js(F.struct(choice.alias("select"))))
        .when(kind == "multi_select", js(F.struct(named.alias("multi_select"))))
        .when(kind == "date", js(F.struct(start.alias("date"))))
        .when(kind == "url", js(F.struct(some.alias("url"))))
        .when(kind == "checkbox", js(F.struct(true.alias("checkbox"))))
    )


def typed(kind: Column, written: Column) -> Column:
    """A written property as a page shows it: with its type."""
    return F.concat(F.lit('{"type":"'), kind, F.lit('",'), F.substr(written, F.lit(2)))
