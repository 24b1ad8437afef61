"""JSON columns, parsed once into VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

JSON_TYPE = "application/json"


def json_rep(content_type: Column, raw: Column) -> Column:
    """Parsed body of a JSON record; null for other types and for broken JSON."""
    return F.when(content_type == JSON_TYPE, F.try_parse_json(raw))


def broken_json(content_type: Column, raw: Column) -> Column:
    """True where a record claims JSON but does not parse."""
    return (content_type == JSON_TYPE) & raw.isNotNull() & F.try_parse_json(raw).isNull()


def text_at(rep: Column, path: str) -> Column:
    """String at a dotted path; null when missing or empty."""
    return F.nullif(F.try_variant_get(rep, "$." + path, "string"), F.lit(""))


def is_array(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("ARRAY"))


def is_object(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))


def as_array(rep: Column, path: str) -> Column:
    """Scalar-or-list at a path as ``ARRAY<VARIANT>``; null when missing."""
    value = F.try_variant_get(rep, path, "variant")
    listed = F.try_variant_get(rep, path, "array<variant>")
    return F.when(value.isNull(), F.lit(None)).when(listed.isNotNull(), listed).otherwise(F.array(value))


def strings_at(rep: Column, path: str) -> Column:
    """Scalar-or-list of strings at a path as ``ARRAY<STRING>``."""
    return F.transform(as_array(rep, path), lambda v: F.try_variant_get(v, "$", "string"))


def blank_fields(raw: Column, *names: str) -> Column:
    """Empty the named top-level fields where present; the rest is untouched.

    Text that is not a JSON object stays as it is.
    """
    body = F.from_json(raw, "map<string,variant>")
    blank = F.parse_json(F.lit('""'))
    blanked = F.to_json(F.transform_values(body, lambda k, v: F.when(k.isin(*names), blank).otherwise(v)))
    return F.coalesce(blanked, raw)


def json_text(value: Column) -> Column:
    """A string as a quoted JSON literal."""
    wrapped = F.to_json(F.array(value))
    return F.substr(wrapped, F.lit(2), F.length(wrapped) - 2)


def json_list(items: Column) -> Column:
    """An array of strings as JSON with ``', '`` between items."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, json_text), ", "), F.lit("]"))
