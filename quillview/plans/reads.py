"""Queries over maintained documents: parents with children, inner hits, lookup, typed views."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def has_child(parents: DataFrame, children: DataFrame, parent_key: str, child_parent: str, min_children: int = 1, condition: Column | None = None) -> DataFrame:
    """Parents with at least ``min_children`` children that meet the condition."""
    rows = children.filter(condition) if condition is not None else children
    if min_children <= 1:
        return parents.join(rows, parents[parent_key] == rows[child_parent], "left_semi")
    enough = rows.groupBy(F.col(child_parent).alias("__parent")).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= min_children)
    return parents.join(enough, parents[parent_key] == enough["__parent"], "left_semi")


def inner_hits(parents: DataFrame, children: DataFrame, parent_key: str, child_parent: str, order: list[str | Column], size: int = 3) -> DataFrame:
    """Each parent with its first ``size`` children in the given order, a row per hit.

    The rank is bounded, so Spark keeps only ``size`` rows per parent before the shuffle.
    """
    w = Window.partitionBy(child_parent).orderBy(*order)
    best = children.withColumn("hit", F.row_number().over(w)).filter(F.col("hit") <= size)
    return parents.join(best, parents[parent_key] == best[child_parent])


def should(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that meet at least one of the conditions."""
    any_of = conditions[0]
    for c in conditions[1:]:
        any_of = any_of | c
    return df.filter(any_of)


def get_source(documents: DataFrame, id_: str, routing: str | None = None) -> DataFrame:
    """The document of an id and routing; no row if there is none."""
    return documents.filter((F.col("id") == id_) & (F.col("route") == (routing or id_)))


def same_multiset(left: Column, right: Column) -> Column:
    """Arrays that hold the same elements equally often."""
    return F.array_sort(left).eqNullSafe(F.array_sort(right))


def with_children(parents: DataFrame, key: str, kinds: dict[str, tuple[DataFrame, str, list[str], list[str]]]) -> DataFrame:
    """Each parent with its children of several kinds, an array of objects per kind (empty if it has none).

    ``kinds``: name of the array -> children, their column with the parent's key, columns kept, columns that order
    them. Children are grouped by the parent's key before the joins, which are all on that key: every table is
    shuffled once. A column of the parent with the name of an array gives way.
    """
    out = parents.drop(*kinds)
    for name, (rows, parent, columns, order) in kinds.items():
        member = F.struct(F.struct(*order).alias("o"), F.struct(*columns).alias("v"))
        mine = rows.filter(F.col(parent).isNotNull()).groupBy(F.col(parent).alias("__parent")).agg(F.transform(F.array_sort(F.collect_list(member)), lambda x: x["v"]).alias(name))
        out = out.join(mine, out[key] == mine["__parent"], "left").drop("__parent").withColumn(name, F.coalesce(name, F.array().cast(mine.schema[name].dataType)))
    return out


#: Types of an index mapping as types of columns.
TYPES = {
    "keyword": "string", "text": "string", "boolean": "boolean", "byte": "tinyint", "short": "smallint", "integer": "int", "long": "bigint",
    "float": "float", "double": "double", "date": "timestamp",
}


@dataclass(frozen=True)
class Mapped:
    """A field of an index mapping. ``members``: of a nested field; a longer text than ``longest`` is not searched."""

    kind: str
    searched: bool = True
    longest: int | None = None
    members: dict[str, Mapped] | None = None
    relations: dict[str, list[str]] | None = None  # of a join field: type of the parent -> types of its children


def index_mapping(text: str) -> dict[str, Mapped]:
    """The fields of an index mapping: ``{"mappings": {"properties": {...}}}``."""

    def fields(properties: dict) -> dict[str, Mapped]:
        out = {}
        for name, p in properties.items():
            kind = p.get("type", "nested" if "properties" in p else None)
            if kind not in TYPES and kind not in ("nested", "join"):
                raise ValueError(f"field {name} has an unknown type {kind!r}")
            relations = {k: [v] if isinstance(v, str) else list(v) for k, v in p.get("relations", {}).items()}
            members = fields(p.get("properties", {})) if kind == "nested" else None
            out[name] = Mapped(kind, p.get("index", True), p.get("ignore_above"), members, relations if kind == "join" else None)
        return out

    return fields(json.loads(text)["mappings"]["properties"])


def _under_type(text: Column, m: Mapped) -> Column:
    """A value's text under its type; values that don't fit are null."""
    value = text.try_cast(TYPES[m.kind])
    return F.when(F.length(text) <= m.longest, value) if m.longest is not None else value


def _nested(objects: Column, members: dict[str, Mapped]) -> Column:
    """JSON objects as structs, each parsed once."""
    texts = ", ".join(f"`{k}` string" for k in members)
    parsed = F.transform(objects, lambda o: F.from_json(o, texts))
    return F.transform(parsed, lambda o: F.struct(*[_under_type(o[k], x).alias(k) for k, x in members.items()]))


def searchable(documents: DataFrame, mapping: dict[str, Mapped]) -> DataFrame:
    """Documents as an index with this mapping searches them: a column per searched field under its type.

    Nested fields are arrays of structs, from the documents' arrays; a join field is a struct of the type's name
    and the parent, null for types that the mapping doesn't relate. Fields with ``index: false`` and members of
    nested fields that are not searched are left out; values that don't fit their type are null.
    """
    columns = []
    for name, m in mapping.items():
        object_ = F.concat(F.lit('{"v":'), F.col("fields")[name], F.lit("}"))
        if not m.searched:
            continue
        if m.kind == "nested":
            members = {k: x for k, x in m.members.items() if x.searched}
            columns.append(_nested(F.col("inlines")[name], members).alias(name))
        elif m.kind == "join":
            known = list(dict.fromkeys([*m.relations, *(c for children in m.relations.values() for c in children)]))
            type_, parent = F.get_json_object(object_, "$.v.name"), F.get_json_object(object_, "$.v.parent")
            columns.append(F.when(type_.isin(*known), F.struct(type_.alias("name"), parent.alias("parent"))).alias(name))
        else:
            columns.append(_under_type(F.get_json_object(object_, "$.v"), m).alias(name))
    return documents.select(F.col("id").alias("_id"), F.col("route").alias("_routing"), *columns)


def typed(documents: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Fields of documents under the types of an index mapping; values that don't fit are null."""
    raw = lambda f: F.get_json_object(F.concat(F.lit('{"v":'), F.col("fields")[f], F.lit("}")), "$.v")
    return documents.select("id", *[raw(f).try_cast(kind).alias(f) for f, kind in mapping.items()])
