"""JSON fragments: a value as the text that stands for it inside a JSON document.

Maps of fragments tell three states apart: a key that is absent, the fragment ``null``, and a value.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def fragment(value: Column) -> Column:
    """The value as JSON; null for null."""
    wrapped = F.to_json(F.struct(value.alias("v")), _OPTIONS)  # {"v":...}
    return F.when(value.isNotNull(), wrapped.substr(F.lit(6), F.length(wrapped) - 6))


def unfragment(text: Column) -> Column:
    """A fragment of a scalar as plain text; null for null and ``null``.

    Whole numbers and strings without escapes, as keys mostly are, need no parser.
    """
    plain = F.rlike(text, F.lit(r'\A(?:-?[0-9]+|true|false|"[^"\\]*")\z'))
    parsed = F.get_json_object(F.concat(F.lit('{"v":'), text, F.lit("}")), "$.v")
    return F.when(plain, F.trim(text, F.lit('"'))).otherwise(parsed)


def quoted(text: Column) -> Column:
    """A string as a JSON string."""
    escaped = F.to_json(F.array(text))  # ["..."]
    special = F.rlike(text, F.lit(r'["\\\x00-\x1f\x7f\u2028\u2029]'))
    return F.when(special, escaped.substr(F.lit(2), F.length(escaped) - 2)).otherwise(F.concat(F.lit('"'), text, F.lit('"')))


def key_text(value: Column) -> Column:
    """A key column as text; an empty string for null."""
    return F.coalesce(value.cast("string"), F.lit(""))


def doc_id(table: str, prefix: bool, pk: Column) -> Column:
    return F.concat(F.lit(f"{table}_"), pk) if prefix else pk


def routing(value: Column | None) -> Column:
    """Empty routing is none."""
    return F.nullif(value, F.lit("")) if value is not None else F.lit(None).cast("string")


def object_of(fields: Column) -> Column:
    """A map of fragments as a JSON object, keys in order."""

    def pair(e: Column) -> Column:
        return F.concat(quoted(e["key"]), F.lit(":"), e["value"])

    parts = F.transform(F.array_sort(F.map_entries(fields)), pair)
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def present(entries: dict[str, Column], keep_null: bool) -> Column:
    """Map of field name to fragment; nulls are ``null`` or absent. No lambdas, so that all of it is compiled."""
    none = F.array().cast("array<struct<key:string,value:string>>")
    values = [F.coalesce(v, F.lit("null")) if keep_null else v for v in entries.values()]
    pairs = [F.when(v.isNotNull(), F.array(F.struct(F.lit(k).alias("key"), v.alias("value")))).otherwise(none) for k, v in zip(entries, values, strict=True)]
    return F.map_from_entries(F.flatten(F.array(*pairs)) if pairs else none)


def object_text(entries: dict[str, Column]) -> Column:
    """The JSON object of fields known by name, keys in order; null fragments are left out."""
    parts = [F.concat(F.lit(json.dumps(k, ensure_ascii=False) + ":"), entries[k]) for k in sorted(entries, key=str.encode)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
