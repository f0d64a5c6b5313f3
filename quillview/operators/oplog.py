"""The op log: ordered document operations from snapshots and from change records.

One row is one operation on one document:
``seq, op_ord, index, id, routing, op, fields, inline, pk, obj, stub, table``. Operations on a document
are ordered by ``(seq, op_ord, pk)``. Operations are ``index``, ``insert``, ``update``, ``delete``, ``inline_add``
and ``inline_del`` (or the names an inline declares).

A change record is ``seq, xid, kind (I, U, D; others carry no rows), schema, table, old, new`` and ``ordinal``;
``old`` and ``new`` map column names to JSON fragments, an absent key is a value that the log doesn't have.
``ordinal`` (0 where it is absent) tells records of one ``seq`` apart, in their order; it becomes part of
``op_ord``, so that operations stay in a total order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillview.config import Config, InlineSpec, TableSpec
from quillview.functions.fragments import doc_id, fragment, key_text, object_text, present, quoted, routing, unfragment

OP = (
    "struct<op_ord:int,index:string,id:string,routing:string,op:string,fields:map<string,string>,"
    "inline:string,pk:string,obj:string,stub:map<string,string>>"
)
OPLOG = (
    "seq long, op_ord int, index string, id string, routing string, op string, fields map<string,string>, "
    "inline string, pk string, obj string, stub map<string,string>, table string"
)
CHANGE = "seq long, xid long, kind string, schema string, table string, old map<string,string>, new map<string,string>"
ORDERED_CHANGE = f"{CHANGE}, ordinal int"
#: Kinds that carry no rows and need none: begin, commit, relation, origin, type.
HOUSEKEEPING = ("B", "C", "R", "O", "Y")
SNAPSHOT_SEQ = 0


def _op(order: int, index: str, op: str | Column, id_: Column, route: Column, fields: Column | None = None, inline: str | None = None,
        pk: Column | None = None, obj: Column | None = None, stub: Column | None = None) -> Column:
    none = F.lit(None)
    maps = F.lit(None).cast("map<string,string>")
    return F.struct(
        F.lit(order).alias("op_ord"),
        F.lit(index).alias("index"),
        id_.alias("id"),
        route.alias("routing"),
        (F.lit(op) if isinstance(op, str) else op).alias("op"),
        (fields if fields is not None else maps).alias("fields"),
        F.lit(inline).cast("string").alias("inline"),
        (pk if pk is not None else none.cast("string")).alias("pk"),
        (obj if obj is not None else none.cast("string")).alias("obj"),
        (stub if stub is not None else maps).alias("stub"),
    ).cast(OP)


class _Values:
    """Where a table's values come from: columns of a snapshot, or a map of a change record."""

    def __init__(self, snapshot: bool, maps: list[Column] = ()) -> None:
        self.snapshot, self.maps = snapshot, list(maps)

    def json(self, column: str) -> Column:
        if self.snapshot:
            return fragment(F.col(column))
        return F.coalesce(*[m[column] for m in self.maps])

    def present(self, column: str) -> Column:
        """For documents: snapshots keep nulls, the log leaves them out."""
        if self.snapshot:
            return F.coalesce(self.json(column), F.lit("null"))
        return F.nullif(self.json(column), F.lit("null"))

    def key(self, column: str) -> Column:
        if self.snapshot:
            return key_text(F.col(column))
        return F.coalesce(unfragment(self.json(column)), F.lit(""))


def document_fields(t: TableSpec, v: _Values) -> Column:
    """Fields of a row's document: its columns, the join object, the type."""
    entries = {c.field: v.present(c.name) for c in t.document_columns}
    if t.join:
        entries[t.join.field] = join_fragment(t, v)
    entries["docType"] = quoted(F.lit(t.doc_type))
    return present(entries, keep_null=False)


def join_fragment(t: TableSpec, v: _Values) -> Column:
    name = quoted(v.key(t.join.type_column) if t.join.type_column else F.lit(t.join.type_name))
    if not t.join.parent_column:
        return F.concat(F.lit('{"name":'), name, F.lit("}"))
    parent = v.key(t.join.parent_column)
    rest = F.when(parent == "", F.lit("}")).otherwise(F.concat(F.lit(',"parent":'), quoted(parent), F.lit("}")))
    return F.concat(F.lit('{"name":'), name, rest)


def _document(config: Config, t: TableSpec, v: _Values, op: str | Column, order: int, with_fields: bool = True) -> Column:
    id_ = doc_id(t.name, t.prefix_id, v.key(t.pk))
    route = routing(v.key(t.routing)) if t.routing else routing(None)
    return _op(order, config.index_name(t.schema), op, id_, route, document_fields(t, v) if with_fields else None)


def _inline(config: Config, t: TableSpec, i: InlineSpec, v: _Values, add: bool, order: int) -> Column:
    parent = config.table(i.parent, t.schema)
    target = v.key(i.parent_column)
    id_ = doc_id(parent.name, parent.prefix_id, target)
    route = routing(v.key(i.routing)) if i.routing else routing(None)
    obj = stub = None
    if add:
        obj = object_text({t.columns[c].field: v.present(c) for c in dict.fromkeys(i.columns)})
        # The stub names the parent's table and key column, not its document type and field.
        stub = present({"docType": quoted(F.lit(parent.name)), parent.pk: fragment(target)}, keep_null=False)
    return _op(order, config.index_name(t.schema), i.add if add else i.remove, id_, route, None, i.field, v.key(i.pk), obj, stub)


def _expand(df: DataFrame, ops: list[Column], table: str, seq: Column) -> DataFrame:
    return df.select(seq.alias("seq"), F.explode(F.array(*ops)).alias("o")).select("seq", "o.*", F.lit(table).alias("table"))


def snapshot_ops(config: Config, t: TableSpec, rows: DataFrame, rank: int = 0) -> DataFrame:
    """One ``index`` operation for each row of an indexed table and one ``inline_add`` for each inline it feeds."""
    v = _Values(snapshot=True)
    ops = [_document(config, t, v, "index", rank)] if t.indexed else []
    ops += [_inline(config, t, i, v, True, rank) for i in t.inlined_in]
    return _expand(rows.select(*t.needed_columns), ops, t.name, F.lit(SNAPSHOT_SEQ).cast("long"))


def snapshot_all(config: Config, tables: dict[str, DataFrame], schema: str = "public") -> DataFrame:
    """Every table's snapshot, parents before the sources of their inlines."""
    parts = [snapshot_ops(config, t, tables[t.name], rank) for rank, t in enumerate(config.ordered()) if t.schema == schema and t.name in tables]
    return reduce(DataFrame.unionByName, parts)


def keys_changed(old: Column, new: Column, columns: list[str]) -> Column:
    """Some key differs; a key that the new tuple doesn't have is unchanged. False without an old tuple."""
    parts = [new[c].isNotNull() & ~old[c].eqNullSafe(new[c]) for c in columns]
    return old.isNotNull() & reduce(lambda a, b: a | b, parts)


def change_ops(config: Config, changes: DataFrame, null_mode: str = "omit") -> DataFrame:
    """Operations of change records; a record of a table that the config doesn't have gives none, nor does
    one without a value for a key that its table's operations need (:func:`bad_changes` has those).

    One pass over the records, however many tables there are: each record's array of operations is made
    once, by its table, and then exploded. ``null_mode``: ``omit`` leaves null values out of updates,
    ``explicit`` writes them.
    """
    ordinal = F.coalesce("ordinal", F.lit(0)) if "ordinal" in changes.columns else F.lit(0)
    tables = config.ordered()
    slots = 2 + 2 * max((len(t.inlined_in) for t in tables), default=0)
    # Key columns are read by their place in the record's table, so their cost doesn't grow with the number of tables.
    known = {_place(t): _key_columns(t) for t in tables}
    names = [
        reduce(lambda found, t: F.when(_is(t), F.lit(known[_place(t)][k])).otherwise(found), [t for t in tables if k < len(known[_place(t)])], F.lit(None).cast("string"))
        for k in range(max(map(len, known.values()), default=0))
    ]
    old, new = F.col("old"), F.col("new")
    named = changes.select("seq", ordinal.alias("ordinal"), "kind", "schema", "table", "old", "new", *[n.alias(f"__n{k}") for k, n in enumerate(names)])
    texts = [
        text.alias(f"__{side}{k}") for k in range(len(names))
        for side, text in (("b", unfragment(old[F.col(f"__n{k}")])), ("a", unfragment(F.coalesce(new[F.col(f"__n{k}")], old[F.col(f"__n{k}")]))))
    ]
    keyed = named.select("seq", "ordinal", "kind", "schema", "table", "old", "new", *texts)
    none = F.lit(None).cast(f"array<{OP}>")
    ops = reduce(lambda found, t: F.when(_is(t) & _complete(t), F.array(*_table_changes(config, t, null_mode))).otherwise(found), reversed(tables), none)
    made = keyed.select("seq", "ordinal", "table", ops.alias("ops"))
    # An outer generator: for an inner one the optimizer would make the arrays a second time, to filter them.
    rows = made.select("seq", "ordinal", "table", F.explode_outer("ops").alias("o")).filter(F.col("o").isNotNull())
    op_ord = (F.col("ordinal") * slots + F.col("o.op_ord")).cast("int").alias("op_ord")
    return rows.select("seq", op_ord, *[F.col(f"o.{n}") for n in ("index", "id", "routing", "op", "fields", "inline", "pk", "obj", "stub")], "table")


def _is(t: TableSpec) -> Column:
    return (F.col("schema") == t.schema) & (F.col("table") == t.name)


def _place(t: TableSpec) -> tuple[str, str]:
    return t.schema, t.name


def _needed_keys(t: TableSpec) -> list[str]:
    return list(dict.fromkeys([*([t.pk] if t.indexed else []), *(c for i in t.inlined_in for c in (i.pk, i.parent_column))]))


def _key_columns(t: TableSpec) -> list[str]:
    """Columns that ids, routing and joins are made of; the needed ones come first."""
    more = [t.routing, *((t.join.type_column, t.join.parent_column) if t.join else ())] if t.indexed else []
    return list(dict.fromkeys([*_needed_keys(t), *(c for c in more if c), *(i.routing for i in t.inlined_in if i.routing)]))


def _complete(t: TableSpec) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"__a{k}").isNotNull() for k in range(len(_needed_keys(t)))])


def has_keys(t: TableSpec) -> Column:
    """Whether a change record has a value for each key that the operations of its table need."""
    known = [F.coalesce(F.col("new")[c], F.col("old")[c]) for c in _needed_keys(t)]
    return F.coalesce(reduce(lambda a, b: a & b, [k.isNotNull() & (k != "null") for k in known]), F.lit(False))


class _Change(_Values):
    """A change record's values: keys from the columns made before, fields from the tuples."""

    def __init__(self, t: TableSpec, side: str, fields: Callable[[str], Column], explicit: bool) -> None:
        super().__init__(False)
        self.place = {c: F.col(f"__{side}{k}") for k, c in enumerate(_key_columns(t))}
        self.fields, self.explicit = fields, explicit

    def json(self, column: str) -> Column:
        return self.fields(column)

    def present(self, column: str) -> Column:
        return self.json(column) if self.explicit else F.nullif(self.json(column), F.lit("null"))

    def key(self, column: str) -> Column:
        return F.coalesce(self.place[column], F.lit(""))


def _table_changes(config: Config, t: TableSpec, null_mode: str) -> list[Column]:
    """The operations of a record of this table, each null where the record doesn't call for it."""
    kind, old, new = F.col("kind"), F.col("old"), F.col("new")
    explicit = null_mode == "explicit"
    ops: list[Column] = []
    n = len(t.inlined_in)
    # Keys that the new tuple lacks are unchanged; fields of an update are those of the new tuple alone.
    either = lambda c: F.coalesce(new[c], old[c])
    before = _Change(t, "b", lambda c: old[c], explicit)
    if t.indexed:
        keys = [c for c in (t.pk, t.routing) if c]
        moved = F.lit(False) if t.upsert_only else keys_changed(old, new, keys)
        same = (kind == "U") & ~moved
        op = F.when(kind == "I", "index").when(same, "update").otherwise("insert")
        after = _Change(t, "a", lambda c: F.coalesce(new[c], F.when(~same, old[c])), explicit)
        ops.append(F.when(kind.isin("I", "U"), _document(config, t, after, op, 1 + n)))
        if not t.upsert_only:
            ops.append(F.when((kind == "D") | (kind == "U") & moved, _document(config, t, before, "delete", 0, False)))
    after = _Change(t, "a", either, explicit)
    for k, i in enumerate(t.inlined_in):
        if not i.upsert_only:
            moved = keys_changed(old, new, [c for c in (i.parent_column, i.pk, i.routing) if c])
            ops.append(F.when((kind == "D") | (kind == "U") & moved, _inline(config, t, i, before, False, 1 + k)))
        ops.append(F.when(kind.isin("I", "U"), _inline(config, t, i, after, True, 2 + n + k)))
    return ops


def unsupported(changes: DataFrame) -> DataFrame:
    """Records that make no operation and are not housekeeping: truncations and unknown kinds, counted."""
    return changes.filter(~F.col("kind").isin("I", "U", "D", *HOUSEKEEPING)).groupBy("schema", "table", "kind").count()


def bad_changes(config: Config, changes: DataFrame) -> DataFrame:
    """Records whose tuples lack a key that an operation needs, or a null there, with the reason; one pass."""
    reason = F.lit(None).cast("string")
    for t in config.ordered():
        reason = F.when(_is(t) & ~has_keys(t), F.lit(f"no value for a key of {t.name}")).otherwise(reason)
    rows = changes.filter(F.col("kind").isin("I", "U", "D")).withColumn("reason", reason).filter(F.col("reason").isNotNull())
    return rows.select("seq", "kind", "schema", "table", "reason")


def rows_as_changes(rows: DataFrame, table: str, kind: Column, seq: Column, old: dict[str, Column] | None, new: dict[str, Column] | None, schema: str = "public") -> DataFrame:
    """Change records from rows whose columns hold old and new values."""

    def tuple_of(values: dict[str, Column] | None) -> Column:
        if values is None:
            return F.lit(None).cast("map<string,string>")
        return present({k: fragment(v) for k, v in values.items()}, keep_null=True)

    return rows.select(
        seq.cast("long").alias("seq"), F.lit(0).cast("long").alias("xid"), kind.alias("kind"), F.lit(schema).alias("schema"),
        F.lit(table).alias("table"), tuple_of(old).alias("old"), tuple_of(new).alias("new"),
    )


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], OPLOG)
