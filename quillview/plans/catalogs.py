"""Registered catalog queries over a small literal catalog that covers every case."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillview.plans import catalog, demo
from quillview.plans.registry import query, table

#: name: (columns with Spark types, rows)
LITERAL: dict[str, tuple[str, list[tuple]]] = {
    "pg_publication_tables": ("pubname string, schemaname string, tablename string", [("pub", "public", t) for t in ("nothing", "keyed", "indexed", "full", "a_view", "gone")] + [("other", "public", "outside"), ("pub", "pg_catalog", "keyed")]),
    "pg_namespace": ("oid long, nspname string", [(1, "public"), (2, "pg_catalog"), (3, "information_schema"), (4, "sales")]),
    "pg_class": (
        "oid long, relname string, relnamespace long, relkind string, relreplident string",
        [(10, "nothing", 1, "r", "n"), (11, "keyed", 1, "r", "d"), (12, "indexed", 1, "p", "i"), (13, "full", 1, "r", "f"), (14, "a_view", 1, "v", "d"), (15, "outside", 1, "r", "d"), (16, "keyed", 2, "r", "d")],
    ),
    "pg_attribute": (
        "attrelid long, attname string, attnum int, atttypid long, attisdropped boolean",
        [(r, c, n, 20 + n, c == "dropped") for r in range(10, 17) for n, c in enumerate(["id", "part", "value", "dropped"], 1)] + [(11, "ctid", -1, 27, False), (90, "x", 1, 20, False), (90, "y", 2, 25, True)],
    ),
    "pg_index": (
        "indrelid long, indkey array<int>, indnkeyatts int, indisprimary boolean, indisreplident boolean",
        [(10, [1], 1, True, False), (11, [1], 1, True, False), (12, [1], 1, True, False), (12, [1, 2, 3], 2, False, True), (13, [1], 1, True, False), (13, [3], 1, False, False)],
    ),
    "pg_description": ("objoid long, objsubid int, description string", [(11, 0, 'index:"k,all"'), (11, 1, 'index:",id"'), (12, 2, "free text"), (13, 0, 'index:"-"')]),
    "pg_type": (
        "oid long, typname string, typtype string, typcategory string, typarray long, typelem long, typrelid long, typnamespace long",
        [(100, "mood", "e", "E", 101, 0, 0, 1), (101, "_mood", "b", "A", 0, 100, 0, 1), (102, "pair", "c", "C", 103, 0, 90, 4), (103, "_pair", "b", "A", 0, 102, 0, 4), (20, "int8", "b", "N", 1016, 0, 0, 2)],
    ),
    "pg_enum": ("oid long, enumtypid long, enumlabel string", [(200, 100, "sad"), (201, 100, "ok"), (202, 100, "happy")]),
}


def literal(spark: SparkSession) -> catalog.Catalog:
    return {name: spark.createDataFrame(rows, ddl) for name, (ddl, rows) in LITERAL.items()}


def _value(v: object) -> str:
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, list):
        return "[" + ", ".join(map(str, v)) + "]"
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _with() -> str:
    parts = []
    for name, (ddl, rows) in LITERAL.items():
        columns = ", ".join(c.split()[0] for c in ddl.split(", "))
        parts.append(f"{name}({columns}) AS (VALUES " + ", ".join("(" + ", ".join(map(_value, r)) + ")" for r in rows) + ")")
    return "WITH " + ",\n".join(parts)


W = _with()
S = SparkSession
KEYS = "(SELECT indrelid, a, bool_or(indisprimary) AS p, bool_or(indisreplident) AS r FROM (SELECT indrelid, indisprimary, indisreplident, unnest(indkey[1:indnkeyatts]) AS a FROM pg_index WHERE indisprimary OR indisreplident) GROUP BY ALL)"
COLUMNS = f"""FROM pg_class c, pg_namespace n, pg_attribute a LEFT JOIN {KEYS} k ON k.indrelid = a.attrelid AND k.a = a.attnum
WHERE c.relnamespace = n.oid AND a.attrelid = c.oid AND a.attnum > 0 AND NOT a.attisdropped AND c.relkind IN ('r', 'p') AND n.nspname NOT IN ('information_schema', 'pg_catalog', 'pg_toast')
AND EXISTS (SELECT 1 FROM pg_publication_tables t WHERE t.pubname = 'pub' AND t.schemaname = n.nspname AND t.tablename = c.relname)"""
SAVED = "c.relreplident = 'f' OR c.relreplident = 'd' AND coalesce(k.p, FALSE) OR c.relreplident = 'i' AND coalesce(k.r, FALSE)"


@query(
    "catalog_discover",
    f"""{W} SELECT n.nspname AS schema, c.relname AS "table", a.attname AS "column", CAST(a.attnum AS INTEGER) AS attnum,
    (SELECT description FROM pg_description d WHERE d.objoid = c.oid AND objsubid = 0) AS table_comment, (SELECT description FROM pg_description d WHERE d.objoid = c.oid AND objsubid = a.attnum) AS column_comment,
    coalesce(k.p, FALSE) AS pk, CAST(a.atttypid AS BIGINT) AS type_oid, {SAVED} AS old_in_log {COLUMNS}""",
)
def catalog_discover(spark: S, sf: str) -> DataFrame:
    return catalog.discover(literal(spark), "pub")


@query("catalog_replica_identity_case", f"""{W} SELECT c.relname AS "table", c.relreplident AS identity, count(*) FILTER (WHERE {SAVED}) AS n_saved {COLUMNS} GROUP BY ALL""")
def catalog_replica_identity_case(spark: S, sf: str) -> DataFrame:
    c = literal(spark)
    identity = c["pg_class"].select(F.col("relname").alias("table"), F.col("relreplident").alias("identity")).filter("table <> 'a_view'").distinct()
    saved = catalog.discover(c, "pub").groupBy("table").agg(F.count_if("old_in_log").alias("n_saved"))
    return saved.join(identity, "table").select("table", "identity", "n_saved")


@query("catalog_index_columns_bool_or", f"{W} SELECT CAST(indrelid AS BIGINT) AS indrelid, CAST(a AS INTEGER) AS attnum, p AS in_primary, r AS in_replica FROM {KEYS}")
def catalog_index_columns_bool_or(spark: S, sf: str) -> DataFrame:
    return catalog.index_columns(literal(spark))


@query("catalog_type_by_oid", f"{W} SELECT CAST(oid AS BIGINT) AS oid, typname, typtype, typcategory, CAST(typarray AS BIGINT) AS typarray, CAST(typelem AS BIGINT) AS typelem, CAST(typrelid AS BIGINT) AS typrelid FROM pg_type WHERE oid = 102")
def catalog_type_by_oid(spark: S, sf: str) -> DataFrame:
    c = literal(spark)
    return catalog.type_by_oid(c, 102).unionByName(catalog.type_by_oid(c, 20))


@query("catalog_composite_attrs", f"{W} SELECT attname, CAST(atttypid AS BIGINT) AS atttypid, CAST(attnum AS INTEGER) AS attnum FROM pg_attribute WHERE attrelid = 90")
def catalog_composite_attrs(spark: S, sf: str) -> DataFrame:
    return catalog.composite_attributes(literal(spark), 90)


@query(
    "catalog_enum_members",
    f"{W} SELECT CAST(e.oid AS BIGINT) AS value_oid, CAST(e.enumtypid AS BIGINT) AS enum_oid, enumlabel AS value_text, typname AS enum_name, nspname AS namespace FROM pg_enum e, pg_type t, pg_namespace n WHERE t.oid = e.enumtypid AND n.oid = t.typnamespace",
)
def catalog_enum_members(spark: S, sf: str) -> DataFrame:
    return catalog.enum_members(literal(spark))


@query("catalog_enum_array_semi", f"{W} SELECT CAST(oid AS BIGINT) AS array_typ, CAST(typelem AS BIGINT) AS enum_typ FROM pg_type WHERE typcategory = 'A' AND typelem IN (SELECT enumtypid FROM pg_enum)")
def catalog_enum_array_semi(spark: S, sf: str) -> DataFrame:
    return catalog.enum_array_types(literal(spark))


@query("catalog_enum_labels", f"{W} SELECT enumlabel FROM pg_enum WHERE enumtypid = 100")
def catalog_enum_labels(spark: S, sf: str) -> DataFrame:
    return catalog.enum_labels(literal(spark), 100)


@query(
    "slot_lag",
    """SELECT 'slot' AS slot_name, (SELECT max(event_id) FROM events) AS end_seq, CAST(10 AS BIGINT) AS confirmed, (SELECT max(event_id) FROM events) - 10 AS lag,
    CASE WHEN (SELECT max(event_id) FROM events) - 10 >= 10240 THEN CAST(CAST(round(((SELECT max(event_id) FROM events) - 10) / 1024.0) AS BIGINT) AS VARCHAR) || ' kB' ELSE ((SELECT max(event_id) FROM events) - 10) || ' bytes' END AS size, 'reserved' AS status""",
)
def slot_lag(spark: S, sf: str) -> DataFrame:
    slots = spark.createDataFrame([("slot", 10, "reserved")], "slot_name string, confirmed long, status string")
    return catalog.slot_lag(demo.event_ops(spark, sf), slots)


@query("describe_config", """SELECT * FROM (VALUES ('customer', 'customer', TRUE, 'c_custkey'), ('orders', 'order', TRUE, 'o_orderkey'), ('lineitem', 'lineitem', FALSE, NULL)) t("table", doc_type, indexed, pk)""")
def describe_config(spark: S, sf: str) -> DataFrame:
    return spark.createDataFrame(demo.config().describe(), "schema string, table string, doc_type string, indexed boolean, pk string, routing string, fields string, upsert_only boolean, inlines string, inlined_in string").select("table", "doc_type", "indexed", "pk")


@query("synthetic_children_per_parent", None)
def synthetic_children_per_parent(spark: S, sf: str) -> DataFrame:
    from quillview.sources import synthetic

    parents = synthetic.parents(spark)
    return synthetic.children(parents).groupBy("parent_id").agg(F.count(F.lit(1)).alias("n_children"))


@query("conversation_turns_nested", "SELECT conv_id, count(*) AS n_turns, min(turn) AS first_turn, arg_min(role, turn) AS first_role FROM conversations GROUP BY conv_id")
def conversation_turns_nested(spark: S, sf: str) -> DataFrame:
    """Ordered children nested under a parent that has no table of its own."""
    c = table(spark, sf, "conversations")
    turns = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.element_at("turns", 1)["turn"].alias("first_turn"), F.element_at("turns", 1)["role"].alias("first_role"))
