"""Fold an op log into current documents, as set operations keyed by document.

For each document: the last ``index``, ``insert`` or ``delete`` resets it; it exists from its creation, a
reset that writes it or the first ``inline_add`` after (which brings the stub). From there, a field has its
last written value, and an array holds, per key, the last object added after the key's last removal, in
the order in which the objects' places were taken. An array that had additions but lost them all is
empty, not absent. Updates and removals on a missing document do nothing.

Scripts with other effects (:mod:`quillview.operators.scripts`) keep a key's first object, move a key that is
added again to the end, or make an object by key instead of an array.

Operations are shuffled once, by document; windows and aggregations within a document reuse that
partitioning. A document is one row in the end, so its operations may meet in one task; windows spill.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillview.operators.scripts import ARRAYS, Script, named

RESETS = ("index", "insert", "delete")
KEY = ["index", "route", "id"]
#: A member of an array: the array's name, the member's key and object (null once it was removed), the script that added it.
ITEM = "struct<name:string,pk:string,value:string,script:string>"
#: Before the position of any snapshot or change.
BEFORE_LOG = -(1 << 62)


def _keyed(ops: DataFrame, scripts: Mapping[str, Script]) -> DataFrame:
    # Resets of one change sort before its additions through op_ord; pk tells additions of a snapshot apart.
    op = F.col("op")
    unknown = F.raise_error(F.concat(F.lit("no script is declared for the operation "), op))
    kind = F.when(op.isin(*named(scripts, adds=True)), "add").when(op.isin(*named(scripts, adds=False)), "del").when(op.isin(*RESETS, "update"), op).otherwise(unknown)
    return ops.withColumn("route", F.coalesce("routing", "id")).withColumn("kind", kind).withColumn(
        "ord", F.struct("seq", "op_ord", F.coalesce("pk", F.lit("")).alias("pk"))
    )


def alive(ops: DataFrame) -> DataFrame:
    """Operations from the creation of each existing document on, with ``born`` (their order key)."""
    w = Window.partitionBy(*KEY)
    reset = F.col("kind").isin(*RESETS)
    last = F.max(F.when(reset, F.struct("ord", "kind"))).over(w)
    after = ops.withColumn("last", last).filter(F.col("last").isNull() | (F.col("ord") >= F.col("last.ord")))
    written = F.coalesce(F.col("last.kind").isin("index", "insert"), F.lit(False))
    first_add = F.min(F.when(F.col("kind") == "add", F.col("ord"))).over(w)
    return after.withColumn("born", F.when(written, F.col("last.ord")).otherwise(first_add)).filter(F.col("ord") >= F.col("born")).drop("last")


def facts(living: DataFrame) -> DataFrame:
    """What operations say, a row each: a field's value, an object added (by which script) or removed, that the document exists."""
    kind = "array<struct<type:string,name:string,pk:string,value:string,gone:boolean,script:string>>"
    none, no = F.lit(None).cast("string"), F.lit(False)
    fields = lambda m: F.transform(F.map_entries(m), lambda e: F.struct(F.lit("f"), e["key"], none, e["value"], no, none)).cast(kind)
    added = F.col("kind") == "add"
    item = F.array(F.struct(F.lit("a"), F.col("inline"), F.col("pk"), F.col("obj"), ~added, F.when(added, F.col("op")))).cast(kind)
    empty = F.array().cast(kind)
    said = F.concat(
        F.array(F.struct(F.lit("x"), none, none, none, no, none)).cast(kind),
        F.coalesce(F.when(F.col("kind").isin("index", "insert", "update"), fields(F.col("fields"))), empty),
        F.coalesce(F.when(added & (F.col("ord") == F.col("born")), fields(F.col("stub"))), empty),
        F.when(F.col("kind").isin("add", "del"), item).otherwise(empty),
    )
    return living.select(*KEY, "ord", F.inline(said))


def fold(ops: DataFrame, scripts: Mapping[str, Script] = ARRAYS, keep_items: bool = False) -> DataFrame:
    """``index, route, id, fields (map of fragments), inlines (map of name to array of JSON objects)``.

    Scripts of shape ``map`` add ``maps`` (map of name to map of key to JSON object). ``keep_items`` adds
    ``items``, the arrays' members with their keys in order, from which :func:`ops_of_versions` makes the
    document again.
    """
    firsts, movers, mapped = named(scripts, adds=True, value="first"), named(scripts, adds=True, place="last"), named(scripts, adds=True, shape="map")
    said = facts(alive(_keyed(ops, scripts)))
    one = [*KEY, "type", "name", "pk"]
    removed = F.max(F.when(F.col("gone"), F.col("ord"))).over(Window.partitionBy(*one))
    live = ~F.col("gone") & (F.col("removed").isNull() | (F.col("ord") > F.col("removed")))
    # What only some scripts need is left out without them.
    by = lambda names, theirs, others: F.when(F.max("script").isin(*names), theirs).otherwise(others) if names else others
    scripted = [F.max("script").alias("script")] if mapped or keep_items else []
    last = said.withColumn("removed", removed).withColumn("live", F.when(live, F.col("ord"))).groupBy(*one).agg(
        by(firsts, F.min_by("value", "live"), F.max_by("value", "live")).alias("value"),
        by(movers, F.max("live"), F.min("live")).alias("place"), F.bool_or(~F.col("gone")).alias("had"), *scripted,
    )
    field = F.when(F.col("type") == "f", F.struct(F.col("name").alias("key"), "value"))
    item = F.when((F.col("type") == "a") & F.col("had"), F.struct("name", "place", "pk", "value", *(["script"] if scripted else [])))
    docs = last.groupBy(*KEY).agg(F.collect_list(field).alias("pairs"), F.array_sort(F.collect_list(item)).alias("items"))

    def by_name(items: Column, members: Callable[[Column], Column]) -> Column:
        names = F.array_distinct(F.transform(items, lambda x: x["name"]))
        mine = lambda name: F.filter(items, lambda x: (x["name"] == name) & x["place"].isNotNull())
        return F.when(F.size(items) > 0, F.map_from_arrays(names, F.transform(names, lambda name: members(mine(name)))))

    is_map = lambda x: x["script"].isin(*mapped)
    arrays = F.filter("items", lambda x: ~is_map(x)) if mapped else F.col("items")
    more = [by_name(F.filter("items", is_map), lambda xs: F.map_from_entries(F.transform(xs, lambda x: F.struct(x["pk"], x["value"])))).alias("maps")] if mapped else []
    if keep_items:
        kept = F.transform("items", lambda x: F.struct(x["name"], x["pk"], F.when(x["place"].isNotNull(), x["value"]), x["script"]))
        more.append(kept.cast(f"array<{ITEM}>").alias("items"))
    inlines = by_name(arrays, lambda xs: F.transform(xs, lambda x: x["value"]))
    return docs.select(*KEY, F.map_from_entries("pairs").alias("fields"), inlines.alias("inlines"), *more)


def ops_of_versions(versions: DataFrame, add: str = "inline_add", remove: str = "inline_del") -> DataFrame:
    """Operations that make documents (``KEY, fields, items``) again, before any operation of a log.

    Members are added by the script that added them before, by ``add`` where it isn't known. A member without a value stands for a key that was added and removed: it keeps an array that is empty.
    """
    none, maps = F.lit(None).cast("string"), F.lit(None).cast("map<string,string>")
    row = lambda ord_, op, fields, inline, pk, obj: F.struct(
        ord_.cast("int").alias("op_ord"), op.alias("op"), fields.alias("fields"), inline.alias("inline"), pk.alias("pk"), obj.alias("obj")
    )
    made = F.array(row(F.lit(0), F.lit("index"), F.col("fields"), none, none, none))
    added = F.transform("items", lambda x, i: row(2 * i + 1, F.coalesce(x["script"], F.lit(add)), maps, x["name"], x["pk"], F.coalesce(x["value"], F.lit("null"))))
    removed = F.transform("items", lambda x, i: F.when(x["value"].isNull(), row(2 * i + 2, F.lit(remove), maps, x["name"], x["pk"], none)))
    ops = F.filter(F.concat(made, added, removed), lambda x: x.isNotNull())
    empty = F.create_map().cast("map<string,string>")
    return versions.select("index", F.col("route"), "id", F.explode(ops).alias("o")).select(
        F.lit(BEFORE_LOG).alias("seq"), "o.op_ord", "index", "id", F.nullif("route", "id").alias("routing"), "o.op", "o.fields", "o.inline", "o.pk", "o.obj",
        F.when(~F.col("o.op").isin("index", remove), empty).alias("stub"), F.lit("").alias("table"),
    )


def body(documents: DataFrame) -> Column:
    """The document as JSON: its fields, arrays and objects by key, keys in order. Arrays hide fields of their name."""
    from quillview.functions.fragments import object_of

    none = F.create_map().cast("map<string,string>")
    made = [F.coalesce(F.transform_values("inlines", lambda _, v: F.concat(F.lit("["), F.array_join(v, ","), F.lit("]"))), none)]
    if "maps" in documents.columns:
        made.append(F.coalesce(F.transform_values("maps", lambda _, v: object_of(v)), none))
    arrays = F.map_concat(*made)
    return object_of(F.map_concat(F.map_filter("fields", lambda k, _: ~F.array_contains(F.map_keys(arrays), k)), arrays))


def nest(parents: DataFrame, parent_key: str, sources: DataFrame, source_parent: str, source_columns: list[str], field: str, order: list[str]) -> DataFrame:
    """Rebuild without history: each parent row with the array of its source rows (null if it has none)."""
    items = sources.groupBy(F.col(source_parent).alias("__parent")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), F.struct(*source_columns).alias("v")))), lambda x: x["v"]
        ).alias(field)
    )
    return parents.join(items, parents[parent_key] == items["__parent"], "left").drop("__parent")
