"""Registered queries: snapshots, projection, documents, changes and the fold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillview.functions.fragments import doc_id, fragment, key_text, object_of, present, routing, unfragment
from quillview.operators import bulk, fold, oplog
from quillview.plans import demo, reads
from quillview.plans.registry import query, table

S = SparkSession
NO_COLUMN = "docType"


def _snapshot(spark: S, sf: str, name: str) -> DataFrame:
    c = demo.config()
    rows = demo.items(spark, sf) if name == "lineitem" else table(spark, sf, name)
    if name == "lineitem":
        rows = rows.withColumn("l_shipmode", F.lit(""))
    return oplog.snapshot_ops(c, c.table(name), rows)


def _fields(ops: DataFrame) -> DataFrame:
    return ops.select("id", "op", F.explode("fields").alias("field", "value")).select("id", "op", "field", unfragment(F.col("value")).alias("value"))


def _joined_field(ops: DataFrame, field: str) -> DataFrame:
    join = F.col("fields")[field]
    return ops.select("id", F.get_json_object(join, "$.name").alias("name"), F.get_json_object(join, "$.parent").alias("parent"))


# --- snapshots ---------------------------------------------------------------------------------


@query(
    "snapshot_index_ops",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, 'index' AS op, u.field, u.value FROM customer,
    LATERAL (VALUES ('key', CAST(c_custkey AS VARCHAR)), ('name', c_name), ('c_nationkey', CAST(c_nationkey AS VARCHAR)), ('segment', c_mktsegment), ('docType', 'customer')) u(field, value)""",
)
def snapshot_index_ops(spark: S, sf: str) -> DataFrame:
    return _fields(_snapshot(spark, sf, "customer")).filter("field <> 'join'")


@query(
    "snapshot_inline_ops",
    f"""SELECT 'orders_' || l_orderkey AS id, 'inline_add' AS op, 'items' AS inline, l_item AS pk, l_partkey AS part, l_quantity AS quantity, l_returnflag AS flag,
    CAST(l_orderkey AS VARCHAR) AS stub_key, 'orders' AS stub_type FROM ({demo.ITEMS_SQL})""",
)
def snapshot_inline_ops(spark: S, sf: str) -> DataFrame:
    get = lambda p, t: F.get_json_object("obj", p).cast(t)
    return _snapshot(spark, sf, "lineitem").select(
        "id", "op", "inline", "pk", get("$.part", "long").alias("part"), get("$.quantity", "double").alias("quantity"), get("$.flag", "string").alias("flag"),
        unfragment(F.col("stub")["o_orderkey"]).alias("stub_key"), unfragment(F.col("stub")["docType"]).alias("stub_type"),
    )


@query(
    "snapshot_union_order",
    """SELECT 'customer' AS "table", CAST(0 AS INTEGER) AS rank, count(*) AS n FROM customer UNION ALL SELECT 'orders', 1, count(*) FROM orders
    UNION ALL SELECT 'lineitem', 2, count(*) FROM lineitem""",
)
def snapshot_union_order(spark: S, sf: str) -> DataFrame:
    tables = {"customer": table(spark, sf, "customer"), "orders": table(spark, sf, "orders"), "lineitem": demo.items(spark, sf).withColumn("l_shipmode", F.lit(""))}
    return oplog.snapshot_all(demo.config(), tables).groupBy("table", F.col("op_ord").alias("rank")).agg(F.count(F.lit(1)).alias("n"))


@query("column_prune_project", "SELECT o_orderkey AS key, o_custkey AS customer, o_orderstatus AS status FROM orders")
def column_prune_project(spark: S, sf: str) -> DataFrame:
    t = demo.config().table("orders")
    rows = table(spark, sf, "orders").select(*t.needed_columns)
    return rows.select(*[F.col(c.name).alias(c.field) for c in t.document_columns if c.field in ("key", "customer", "status")])


# --- keys, headers, JSON -----------------------------------------------------------------------


@query("doc_id_prefixed", "SELECT 'orders_' || o_orderkey AS id FROM orders")
def doc_id_prefixed(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(doc_id("orders", True, key_text(F.col("o_orderkey"))).alias("id"))


@query("doc_id_raw", "SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer")
def doc_id_raw(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(doc_id("customer", False, key_text(F.col("c_custkey"))).alias("id"))


@query("routing_omit_empty", "SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS routing FROM orders")
def routing_omit_empty(spark: S, sf: str) -> DataFrame:
    value = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey"))
    return table(spark, sf, "orders").select("o_orderkey", routing(key_text(value)).alias("routing"))


@query("index_name_by_schema", "SELECT r_name, CASE WHEN r_regionkey = 0 THEN 'shop' ELSE 'shop_' || lower(r_name) END AS index_name FROM region")
def index_name_by_schema(spark: S, sf: str) -> DataFrame:
    config = demo.config()
    r = table(spark, sf, "region")
    schema = F.when(F.col("r_regionkey") == 0, "public").otherwise(F.lower("r_name"))
    name = F.when(schema == "public", config.index_name("public")).otherwise(F.concat(F.lit(config.index_name("")), schema))
    return r.select("r_name", name.alias("index_name"))


@query("doctype_const", "SELECT 'orders_' || o_orderkey AS id, 'order' AS doc_type FROM orders")
def doctype_const(spark: S, sf: str) -> DataFrame:
    return _snapshot(spark, sf, "orders").select("id", unfragment(F.col("fields")[NO_COLUMN]).alias("doc_type"))


def _nullable(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))


@query("json_omit_null", "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 1 ELSE 2 END AS n_keys, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events")
def json_omit_null(spark: S, sf: str) -> DataFrame:
    made = object_of(present({"type": fragment(F.col("event_type")), "value": fragment(F.col("value"))}, keep_null=False))
    return _nullable(spark, sf).select("event_id", F.json_object_keys(made).alias("keys"), F.get_json_object(made, "$.value").cast("double").alias("value")).select(
        "event_id", F.size("keys").alias("n_keys"), "value"
    )


@query("json_keep_null", "SELECT event_id, 2 AS n_keys, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events")
def json_keep_null(spark: S, sf: str) -> DataFrame:
    made = object_of(present({"type": fragment(F.col("event_type")), "value": fragment(F.col("value"))}, keep_null=True))
    return _nullable(spark, sf).select("event_id", F.size(F.json_object_keys(made)).alias("n_keys"), F.get_json_object(made, "$.value").cast("double").alias("value"))


@query("jsonb_variant_extract", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 1 AS n_keys FROM events")
def jsonb_variant_extract(spark: S, sf: str) -> DataFrame:
    made = object_of(present({"props": fragment(F.parse_json("props"))}, keep_null=False))
    return table(spark, sf, "events").select(
        "event_id", F.variant_get(F.parse_json("props"), "$.k", "long").alias("k"), F.size(F.json_object_keys(F.get_json_object(made, "$.props"))).alias("n_keys")
    )


@query("partial_update_envelope", "SELECT o_orderkey + 1 AS seq, 'orders_' || o_orderkey AS id, 'X' AS status, CAST(o_custkey AS BIGINT) AS customer FROM orders")
def partial_update_envelope(spark: S, sf: str) -> DataFrame:
    ops = oplog.change_ops(demo.config(), demo.order_changes(spark, sf, "U"))
    doc = bulk.payload()
    return ops.select("seq", "id", F.get_json_object(doc, "$.doc.status").alias("status"), F.get_json_object(doc, "$.doc.customer").cast("long").alias("customer"))


@query(
    "ndjson_render",
    """SELECT 'orders_' || o_orderkey AS id, 2 AS n_lines, 'orders_' || o_orderkey AS header_id, CAST(o_custkey AS VARCHAR) AS header_routing, 'shop' AS header_index,
    o_orderstatus AS status FROM orders""",
)
def ndjson_render(spark: S, sf: str) -> DataFrame:
    lines = F.split("ndjson", "\n")
    head = lambda k: F.get_json_object(F.element_at(lines, 1), f"$.index.{k}")
    return bulk.render(_snapshot(spark, sf, "orders")).select(
        "id", F.size(lines).alias("n_lines"), head("_id").alias("header_id"), head("routing").alias("header_routing"), head("_index").alias("header_index"),
        F.get_json_object(F.element_at(lines, 2), "$.status").alias("status"),
    )


# --- joins and nesting -------------------------------------------------------------------------


@query("join_field_parent", "SELECT CAST(c_custkey AS VARCHAR) AS id, 'customer' AS name, CAST(NULL AS VARCHAR) AS parent FROM customer")
def join_field_parent(spark: S, sf: str) -> DataFrame:
    return _joined_field(_snapshot(spark, sf, "customer"), "join")


@query("join_field_child", "SELECT 'orders_' || o_orderkey AS id, 'order' AS name, CAST(o_custkey AS VARCHAR) AS parent FROM orders")
def join_field_child(spark: S, sf: str) -> DataFrame:
    return _joined_field(_snapshot(spark, sf, "orders"), "join")


@query("join_field_polymorphic", "SELECT 'events_' || event_id AS id, event_type AS name, CAST(user_id AS VARCHAR) AS parent FROM events")
def join_field_polymorphic(spark: S, sf: str) -> DataFrame:
    from quillview.config import build_config

    notes = {"event_id": 'index:"id,pk"', "user_id": 'join:"parent"', "event_type": 'join:"name"'}
    c = build_config("app", demo.catalog_rows({"events": ('index:"event"', notes, ("event_id",))}))
    return _joined_field(oplog.snapshot_ops(c, c.table("events"), table(spark, sf, "events")), "join")


@query(
    "nest_inline_full",
    f"""SELECT o.o_orderkey, o.o_orderstatus, CAST(count(i.l_item) AS INTEGER) AS n_items, sum(i.l_quantity) AS quantity, min(i.l_item) AS first_item
    FROM orders o LEFT JOIN ({demo.ITEMS_SQL}) i ON o.o_orderkey = i.l_orderkey GROUP BY ALL""",
)
def nest_inline_full(spark: S, sf: str) -> DataFrame:
    docs = fold.nest(table(spark, sf, "orders"), "o_orderkey", demo.items(spark, sf), "l_orderkey", ["l_item", "l_partkey", "l_quantity"], "items", ["l_item"])
    total = F.aggregate(F.transform("items", lambda x: x["l_quantity"]), F.lit(0.0), lambda a, b: a + b)
    return docs.select("o_orderkey", "o_orderstatus", F.coalesce(F.size("items"), F.lit(0)).alias("n_items"), total.alias("quantity"), F.element_at("items", 1)["l_item"].alias("first_item"))


@query("inline_map_variant", f"SELECT l_orderkey, l_item AS pk, l_partkey FROM ({demo.ITEMS_SQL})")
def inline_map_variant(spark: S, sf: str) -> DataFrame:
    pair = F.struct(F.col("l_item").alias("key"), F.col("l_partkey").alias("value"))
    maps = demo.items(spark, sf).groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(pair)).alias("items"))
    return maps.select("l_orderkey", F.explode("items").alias("pk", "l_partkey"))


# --- changes -----------------------------------------------------------------------------------

FLAT = ["seq", "op_ord", "id", "routing", "op"]


def _flat(ops: DataFrame) -> DataFrame:
    return ops.select(*FLAT, unfragment(F.col("fields")["status"]).alias("status"))


@query("change_insert_ops", "SELECT o_orderkey + 1 AS seq, 1 AS op_ord, 'orders_' || o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS routing, 'index' AS op, o_orderstatus AS status FROM orders")
def change_insert_ops(spark: S, sf: str) -> DataFrame:
    return _flat(oplog.change_ops(demo.config(), demo.order_changes(spark, sf, "I")))


@query("change_update_same_key", "SELECT o_orderkey + 1 AS seq, 1 AS op_ord, 'orders_' || o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS routing, 'update' AS op, 'X' AS status FROM orders")
def change_update_same_key(spark: S, sf: str) -> DataFrame:
    return _flat(oplog.change_ops(demo.config(), demo.order_changes(spark, sf, "U")))


@query(
    "change_update_key_changed",
    """SELECT o_orderkey + 1 AS seq, 0 AS op_ord, 'orders_' || o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS routing, 'delete' AS op, CAST(NULL AS VARCHAR) AS status
    FROM orders WHERE o_orderkey % 5 = 0
    UNION ALL SELECT o_orderkey + 1, 1, 'orders_' || (o_orderkey + CASE WHEN o_orderkey % 5 = 0 THEN 100000000 ELSE 0 END), CAST(o_custkey + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS VARCHAR),
    CASE WHEN o_orderkey % 5 = 0 THEN 'insert' ELSE 'update' END, 'X' FROM orders""",
)
def change_update_key_changed(spark: S, sf: str) -> DataFrame:
    return _flat(oplog.change_ops(demo.config(), demo.order_changes(spark, sf, "U", moved=True)))


@query(
    "change_update_inline_moved",
    f"""SELECT l_orderkey + 1 AS seq, CASE WHEN k = 0 THEN 1 ELSE 3 END AS op_ord, 'orders_' || (l_orderkey + CASE WHEN k = 1 AND l_orderkey % 7 = 0 THEN 1 ELSE 0 END) AS id,
    CASE WHEN k = 0 THEN 'inline_del' ELSE 'inline_add' END AS op, l_item AS pk, CASE WHEN k = 1 THEN l_partkey END AS part
    FROM ({demo.ITEMS_SQL}), (VALUES (0), (1)) v(k) WHERE k = 1 OR l_orderkey % 7 = 0""",
)
def change_update_inline_moved(spark: S, sf: str) -> DataFrame:
    ops = oplog.change_ops(demo.config(), demo.item_changes(spark, sf, "U"))
    return ops.select("seq", "op_ord", "id", "op", "pk", F.get_json_object("obj", "$.part").cast("long").alias("part"))


@query(
    "change_delete_ops",
    f"""SELECT o_orderkey + 1 AS seq, 'orders_' || o_orderkey AS id, 'delete' AS op, CAST(NULL AS VARCHAR) AS pk FROM orders
    UNION ALL SELECT l_orderkey + 1, 'orders_' || l_orderkey, 'inline_del', l_item FROM ({demo.ITEMS_SQL})""",
)
def change_delete_ops(spark: S, sf: str) -> DataFrame:
    changes = demo.order_changes(spark, sf, "D").unionByName(demo.item_changes(spark, sf, "D"))
    return oplog.change_ops(demo.config(), changes).select("seq", "id", "op", "pk")


@query("change_upsert_only", "SELECT 'U' AS kind, 'update' AS op, count(*) AS n FROM orders UNION ALL SELECT 'I', 'index', count(*) FROM orders")
def change_upsert_only(spark: S, sf: str) -> DataFrame:
    """Without old values in the log neither deletions nor moves can be told: only updates remain."""
    from quillview.config import build_config

    comment, columns, _ = demo.COMMENTS["orders"]
    c = build_config("shop", demo.catalog_rows({"orders": (comment, columns, ())}))
    parts = [oplog.change_ops(c, demo.order_changes(spark, sf, k, moved=k == "U")).select(F.lit(k).alias("kind"), "op") for k in "UDI"]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("kind", "op").agg(F.count(F.lit(1)).alias("n"))


# --- fold --------------------------------------------------------------------------------------

#: Living operations by window functions, stated apart from the engine's aggregations.
LIVE_SQL = """
o AS (SELECT event_id AS s, CAST(user_id AS VARCHAR) AS id, event_type AS t, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
r AS (SELECT *, max(CASE WHEN t IN ('signup', 'error') THEN s END) OVER (PARTITION BY id) AS rs FROM o),
r2 AS (SELECT *, max(CASE WHEN s = rs THEN t END) OVER (PARTITION BY id) AS rt FROM r),
b AS (SELECT *, CASE WHEN rt = 'signup' THEN rs ELSE min(CASE WHEN t = 'click' AND (rs IS NULL OR s > rs) THEN s END) OVER (PARTITION BY id) END AS born FROM r2),
live AS (SELECT * FROM b WHERE born IS NOT NULL AND s >= born)
"""


@query(
    "fold_documents_fields",
    f"""WITH {LIVE_SQL},
    f AS (
      SELECT id, s, 'value' AS field, CASE WHEN s % 7 = 1 THEN NULL ELSE value END AS v FROM live WHERE t IN ('signup', 'view') AND s % 7 <> 0
      UNION ALL SELECT id, s, 'k', k FROM live WHERE t = 'signup' UNION ALL SELECT id, s, 'last', s FROM live WHERE t IN ('signup', 'view')
    )
    SELECT id, field, CAST(v AS DOUBLE) AS value FROM (SELECT *, row_number() OVER (PARTITION BY id, field ORDER BY s DESC) AS n FROM f) WHERE n = 1""",
)
def fold_documents_fields(spark: S, sf: str) -> DataFrame:
    docs = fold.fold(demo.event_ops(spark, sf))
    return docs.select("id", F.explode("fields").alias("field", "value")).filter("field <> 'docType'").select("id", "field", unfragment(F.col("value")).cast("double").alias("value"))


@query(
    "fold_documents_inlines",
    f"""WITH {LIVE_SQL},
    g AS (SELECT *, max(CASE WHEN t = 'purchase' THEN s END) OVER (PARTITION BY id, k % 5) AS gone FROM live),
    a AS (SELECT id, k % 5 AS pk, min(s) AS place, max(s) AS event_id FROM g WHERE t = 'click' AND (gone IS NULL OR s > gone) GROUP BY ALL)
    SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY place) AS INTEGER) AS position, pk, event_id FROM a""",
)
def fold_documents_inlines(spark: S, sf: str) -> DataFrame:
    docs = fold.fold(demo.event_ops(spark, sf))
    items = docs.select("id", F.posexplode(F.col("inlines")["items"]).alias("p", "obj"))
    return items.select("id", (F.col("p") + 1).alias("position"), (F.get_json_object("obj", "$.k").cast("long") % 5).alias("pk"), F.get_json_object("obj", "$.event_id").cast("long").alias("event_id"))


@query(
    "fold_existence",
    f"""WITH {LIVE_SQL}, g AS (SELECT *, max(CASE WHEN t = 'purchase' THEN s END) OVER (PARTITION BY id, k % 5) AS gone FROM live)
    SELECT id, max(CASE WHEN t = 'click' THEN 1 ELSE 0 END) = 1 AS has_array, CAST(count(DISTINCT CASE WHEN t = 'click' AND (gone IS NULL OR s > gone) THEN k % 5 END) AS INTEGER) AS n_items
    FROM g GROUP BY id""",
)
def fold_existence(spark: S, sf: str) -> DataFrame:
    found = F.col("inlines")["items"]
    return fold.fold(demo.event_ops(spark, sf)).select("id", found.isNotNull().alias("has_array"), F.coalesce(F.size(found), F.lit(0)).alias("n_items"))


@query("fold_null_update_keeps_old", "SELECT 'orders_' || o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def fold_null_update_keeps_old(spark: S, sf: str) -> DataFrame:
    changes = demo.order_changes(spark, sf, "I").unionByName(demo.order_changes(spark, sf, "U", null_status=True).withColumn("seq", F.col("seq") + 1_000_000_000))
    docs = fold.fold(oplog.change_ops(demo.config(), changes))
    return docs.select("id", unfragment(F.col("fields")["status"]).alias("status"), unfragment(F.col("fields")["o_orderpriority"]).alias("priority"))


@query("fold_null_update_explicit", "SELECT 'orders_' || o_orderkey AS id, TRUE AS has_status, CAST(NULL AS VARCHAR) AS status FROM orders")
def fold_null_update_explicit(spark: S, sf: str) -> DataFrame:
    changes = demo.order_changes(spark, sf, "I").unionByName(demo.order_changes(spark, sf, "U", null_status=True).withColumn("seq", F.col("seq") + 1_000_000_000))
    docs = fold.fold(oplog.change_ops(demo.config(), changes, null_mode="explicit"))
    return docs.select("id", F.map_contains_key("fields", "status").alias("has_status"), unfragment(F.col("fields")["status"]).alias("status"))


# --- reads -------------------------------------------------------------------------------------


@query("has_child", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def has_child(spark: S, sf: str) -> DataFrame:
    return reads.has_child(table(spark, sf, "customer"), table(spark, sf, "orders"), "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("has_child_min_n", "SELECT o_orderkey FROM orders WHERE (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) >= 4")
def has_child_min_n(spark: S, sf: str) -> DataFrame:
    return reads.has_child(table(spark, sf, "orders"), table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey", 4).select("o_orderkey")


@query(
    "has_child_inner_hits",
    """SELECT c_custkey, o_orderkey, CAST(hit AS INTEGER) AS hit FROM customer JOIN
    (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS hit FROM orders) ON o_custkey = c_custkey WHERE hit <= 3""",
)
def has_child_inner_hits(spark: S, sf: str) -> DataFrame:
    return reads.inner_hits(table(spark, sf, "customer"), table(spark, sf, "orders"), "c_custkey", "o_custkey", [F.desc("o_totalprice"), F.col("o_orderkey")]).select("c_custkey", "o_orderkey", "hit")


@query("should_disjunction", "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' OR c_nationkey < 5")
def should_disjunction(spark: S, sf: str) -> DataFrame:
    return reads.should(table(spark, sf, "customer"), F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey") < 5).select("c_custkey")


@query("get_source_by_id", "SELECT 'orders_' || o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderkey = 7")
def get_source_by_id(spark: S, sf: str) -> DataFrame:
    ops = _snapshot(spark, sf, "orders").filter("id = 'orders_7'")
    docs = fold.fold(ops)
    route = table(spark, sf, "orders").filter("o_orderkey = 7").select(F.col("o_custkey").cast("string").alias("route"))
    return docs.join(route, "route", "left_semi").select("id", unfragment(F.col("fields")["status"]).alias("status"))


@query("multiset_equality_check", f"SELECT o_orderkey, TRUE AS same FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM ({demo.ITEMS_SQL}))")
def multiset_equality_check(spark: S, sf: str) -> DataFrame:
    """The arrays of folded documents against the arrays of a rebuild."""
    folded = fold.fold(_snapshot(spark, sf, "orders").unionByName(_snapshot(spark, sf, "lineitem").withColumn("op_ord", F.lit(1)).withColumn("routing", F.lit(None).cast("string"))).withColumn("routing", F.lit(None).cast("string")))
    parts = folded.select("id", F.transform(F.col("inlines")["items"], lambda x: F.get_json_object(x, "$.part").cast("long")).alias("a"))
    rebuilt = fold.nest(table(spark, sf, "orders"), "o_orderkey", demo.items(spark, sf), "l_orderkey", ["l_partkey"], "items", ["l_item"]).filter("items IS NOT NULL")
    b = rebuilt.select("o_orderkey", F.concat(F.lit("orders_"), "o_orderkey").alias("id"), F.transform("items", lambda x: x["l_partkey"]).alias("b"))
    return b.join(parts, "id", "left").select("o_orderkey", reads.same_multiset(F.col("a"), F.col("b")).alias("same"))


@query("mapping_typed_view", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey AS key, c_name AS name, CAST(c_nationkey AS DOUBLE) AS c_nationkey, CAST(NULL AS INTEGER) AS segment FROM customer")
def mapping_typed_view(spark: S, sf: str) -> DataFrame:
    return reads.typed(_snapshot(spark, sf, "customer"), {"key": "bigint", "name": "string", "c_nationkey": "double", "segment": "int"})


# --- sink --------------------------------------------------------------------------------------


@query(
    "metrics_by_operation",
    """SELECT 'orders' AS "table", 'index' AS op, count(*) AS n_ops FROM orders UNION ALL SELECT 'lineitem', 'inline_add', count(*) FROM lineitem""",
)
def metrics_by_operation(spark: S, sf: str) -> DataFrame:
    return bulk.metrics(_snapshot(spark, sf, "orders").unionByName(_snapshot(spark, sf, "lineitem"))).drop("n_bytes")


@query(
    "bulk_bytes_per_table",
    """SELECT 'customer' AS "table", CAST(sum(strlen('{"index":{"_index":"shop","_id":"' || c_custkey || '"}}' || chr(10) || '{"c_nationkey":' || c_nationkey || ',"docType":"customer","join":{"name":"customer"},"key":' || c_custkey
    || ',"name":"' || c_name || '","segment":"' || c_mktsegment || '"}') + 1) AS BIGINT) AS n_bytes FROM customer""",
)
def bulk_bytes_per_table(spark: S, sf: str) -> DataFrame:
    return bulk.metrics(_snapshot(spark, sf, "customer")).select("table", "n_bytes")


@query(
    "bulk_greedy_batches",
    """WITH RECURSIVE rows AS (
      SELECT row_number() OVER (ORDER BY c_custkey) AS n, c_custkey, strlen('{"index":{"_index":"shop","_id":"' || c_custkey || '"}}' || chr(10) || '{"c_nationkey":' || c_nationkey
      || ',"docType":"customer","join":{"name":"customer"},"key":' || c_custkey || ',"name":"' || c_name || '","segment":"' || c_mktsegment || '"}') + 1 AS size FROM customer
    ), packed(n, used, batch) AS (
      SELECT n, size, CAST(0 AS BIGINT) FROM rows WHERE n = 1
      UNION ALL SELECT r.n, CASE WHEN p.used + r.size > 4096 THEN r.size ELSE p.used + r.size END, p.batch + CASE WHEN p.used + r.size > 4096 THEN 1 ELSE 0 END FROM packed p JOIN rows r ON r.n = p.n + 1
    ) SELECT batch, count(*) AS n_ops, CAST(sum(size) AS BIGINT) AS n_bytes FROM packed JOIN rows USING (n) GROUP BY batch""",
)
def bulk_greedy_batches(spark: S, sf: str) -> DataFrame:
    rows = bulk.render(_snapshot(spark, sf, "customer")).withColumn("key", F.col("id").cast("long"))
    packed = bulk.greedy_batches(rows, ["key"], capacity=4096, partitions=1)
    return packed.groupBy("batch").agg(F.count(F.lit(1)).alias("n_ops"), F.sum("size").alias("n_bytes"))
