"""Registered queries: scripts of arrays, reads of nested and related documents, sending, and status."""

from __future__ import annotations

import urllib.error

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillview.functions.fragments import unfragment
from quillview.operators import fold, oplog
from quillview.operators.scripts import STANDARD, Script
from quillview.plans import demo, reads
from quillview.plans.documents import LIVE_SQL
from quillview.plans.registry import query, table
from quillview.sources import scratch
from quillview.streaming import sink
from quillview.streaming.maintain import MaintainedView
from quillview.streaming.status import Reporter, Status

S = SparkSession


# --- scripts -----------------------------------------------------------------------------------


def _scripted(spark: S, sf: str, name: str, script: Script) -> DataFrame:
    """The documents of events whose additions go by a script."""
    ops = demo.event_ops(spark, sf).withColumn("op", F.when(F.col("op") == "inline_add", name).otherwise(F.col("op")))
    return fold.fold(ops, {**STANDARD, name: script})


def _members(docs: DataFrame) -> DataFrame:
    items = docs.select("id", F.posexplode(F.col("inlines")["items"]).alias("p", "obj"))
    return items.select("id", (F.col("p") + 1).alias("position"), F.get_json_object("obj", "$.event_id").cast("long").alias("event_id"))


def _members_sql(place: str, event: str) -> str:
    return f"""WITH {LIVE_SQL},
    g AS (SELECT *, max(CASE WHEN t = 'purchase' THEN s END) OVER (PARTITION BY id, k % 5) AS gone FROM live),
    a AS (SELECT id, k % 5 AS pk, {place}(s) AS place, {event}(s) AS event_id FROM g WHERE t = 'click' AND (gone IS NULL OR s > gone) GROUP BY ALL)
    SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY place) AS INTEGER) AS position, event_id FROM a"""


@query(
    "fold_arrays_as_maps",
    f"""WITH {LIVE_SQL},
    g AS (SELECT *, max(CASE WHEN t = 'purchase' THEN s END) OVER (PARTITION BY id, k % 5) AS gone FROM live)
    SELECT id, CAST(k % 5 AS VARCHAR) AS pk, max(s) AS event_id FROM g WHERE t = 'click' AND (gone IS NULL OR s > gone) GROUP BY ALL""",
)
def fold_arrays_as_maps(spark: S, sf: str) -> DataFrame:
    docs = _scripted(spark, sf, "inline_add_map", STANDARD["inline_add_map"])
    return docs.select("id", F.explode(F.col("maps")["items"]).alias("pk", "obj")).select("id", "pk", F.get_json_object("obj", "$.event_id").cast("long").alias("event_id"))


@query("fold_first_object_stays", _members_sql("min", "min"))
def fold_first_object_stays(spark: S, sf: str) -> DataFrame:
    return _members(_scripted(spark, sf, "add_once", Script(value="first")))


@query("fold_added_again_goes_last", _members_sql("max", "max"))
def fold_added_again_goes_last(spark: S, sf: str) -> DataFrame:
    return _members(_scripted(spark, sf, "add_last", Script(place="last")))


@query("fold_replayed_ops", _members_sql("min", "max"))
def fold_replayed_ops(spark: S, sf: str) -> DataFrame:
    """Delivery is at least once: operations that come twice make the same documents."""
    ops = demo.event_ops(spark, sf)
    return _members(fold.fold(ops.unionByName(ops)))


# --- reads -------------------------------------------------------------------------------------


@query(
    "children_of_several_kinds",
    """SELECT c_custkey, coalesce(o.n, 0) AS n_orders, o.first_key AS first_order, coalesce(e.n, 0) AS n_events, e.first_key AS first_event FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n, arg_min(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS first_key FROM orders GROUP BY 1) o ON o_custkey = c_custkey
    LEFT JOIN (SELECT user_id, count(*) AS n, min(event_id) AS first_key FROM events GROUP BY 1) e ON user_id = c_custkey""",
)
def children_of_several_kinds(spark: S, sf: str) -> DataFrame:
    kinds = {
        "orders": (table(spark, sf, "orders"), "o_custkey", ["o_orderkey", "o_totalprice"], ["o_orderdate", "o_orderkey"]),
        "events": (table(spark, sf, "events"), "user_id", ["event_id", "event_type"], ["event_id"]),
    }
    docs = reads.with_children(table(spark, sf, "customer").select("c_custkey"), "c_custkey", kinds)
    size, head = lambda c: F.size(c).cast("long"), lambda c, f: F.get(c, F.lit(0))[f]
    return docs.select("c_custkey", size("orders").alias("n_orders"), head("orders", "o_orderkey").alias("first_order"), size("events").alias("n_events"), head("events", "event_id").alias("first_event"))


MAPPING = """{"mappings": {"properties": {
  "status": {"type": "keyword"}, "priority": {"type": "keyword", "index": false}, "date": {"type": "date"}, "customer": {"type": "boolean"},
  "items": {"type": "nested", "properties": {"part": {"type": "long"}, "quantity": {"type": "double"}, "flag": {"type": "keyword", "ignore_above": 0}, "l_item": {"type": "keyword"}}},
  "join": {"type": "join", "relations": {"customer": "order"}}}}}"""


@query(
    "mapping_nested_and_join",
    f"""SELECT 'orders_' || o_orderkey AS id, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS date, 'order' AS type, CAST(o_custkey AS VARCHAR) AS parent,
    l_partkey AS part, CAST(l_quantity AS DOUBLE) AS quantity, CAST(NULL AS VARCHAR) AS flag, l_item FROM orders JOIN ({demo.ITEMS_SQL}) ON l_orderkey = o_orderkey""",
)
def mapping_nested_and_join(spark: S, sf: str) -> DataFrame:
    c = demo.config()
    snapshot = oplog.snapshot_all(c, {"orders": table(spark, sf, "orders"), "lineitem": demo.items(spark, sf)})
    docs = fold.fold(snapshot.withColumn("routing", F.lit(None).cast("string")))
    seen = reads.searchable(docs, reads.index_mapping(MAPPING)).filter("status IS NOT NULL")
    return seen.select(F.col("_id").alias("id"), "status", F.col("date").cast("date").alias("date"), F.col("join.name").alias("type"), F.col("join.parent").alias("parent"), F.inline("items"))


@query("response_projection", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer WHERE c_nationkey < 5")
def response_projection(spark: S, sf: str) -> DataFrame:
    """Two fields of the documents that match; the scan reads the columns of these and of the filter only."""
    ops = oplog.snapshot_ops(demo.config(), demo.config().table("customer"), table(spark, sf, "customer").filter("c_nationkey < 5"))
    return ops.select("id", unfragment(F.col("fields")["name"]).alias("name"))


# --- sending -----------------------------------------------------------------------------------


@query(
    "file_sink_lines",
    """SELECT line FROM (SELECT unnest(['{"index":{"_index":"shop","_id":"' || c_custkey || '"}}', '{"c_nationkey":' || c_nationkey || ',"docType":"customer","join":{"name":"customer"},"key":' || c_custkey
    || ',"name":"' || c_name || '","segment":"' || c_mktsegment || '"}']) AS line FROM customer)""",
)
def file_sink_lines(spark: S, sf: str) -> DataFrame:
    path = scratch.folder(spark, "lines")
    sink.write_files(oplog.snapshot_ops(demo.config(), demo.config().table("customer"), table(spark, sf, "customer")), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def _literal(value: object) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, (int, float)) else "'" + value.replace("'", "''") + "'"


def _values(rows: tuple, names: str) -> str:
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows) + f") v({names})"


ANSWERS = (
    ("", "taken"), ("{}", "taken"), ('{"errors":true,"items":[{"update":{"error":{"type":"document_missing_exception"}}}]}', "taken"),
    ('{"errors":true,"items":[{"index":{"error":{"type":"mapper_parsing_exception"}}}]}', "refused"),
    ('{"errors":true,"items":[{"update":{"error":{"type":"document_missing_exception"}}},{"delete":{"error":{"type":"other"}}}]}', "refused"),
)


@query("sink_answers", _values(ANSWERS, "answer, result"))
def sink_answers(spark: S, sf: str) -> DataFrame:
    def result(answer: str) -> str:
        try:
            sink.check(answer)
        except sink.BulkError:
            return "refused"
        return "taken"

    return spark.createDataFrame([(a, result(a)) for a, _ in ANSWERS], "answer string, result string")


ADDRESSES = (
    ("store:9200", "https://store:9200", None), ("http://store/", "http://store", None), ("https://me:secret@store:1/x/", "https://store:1/x", "Basic bWU6c2VjcmV0"),
)


@query("sink_addresses", _values(ADDRESSES, "address, url, auth"))
def sink_addresses(spark: S, sf: str) -> DataFrame:
    found = [(a, c.url, c.headers().get("Authorization")) for a, _, _ in ADDRESSES for c in (sink.Client.connect(a),)]
    return spark.createDataFrame(found, "address string, url string, auth string")


#: What the store says to a request, the requests it gets and the seconds that the sender waits, with a throttle of 2 s.
PACES = (("ok", "sent", 1, 0), ("503 ok", "sent", 2, 4), ("429 503 ok", "sent", 3, 12), ("503 503 503 503", "failed", 4, 28), ("400 ok", "failed", 1, 0))


@query("sender_attempts", _values(PACES, "says, result, requests, waited"))
def sender_attempts(spark: S, sf: str) -> DataFrame:
    class Store:
        def __init__(self, says: str) -> None:
            self.says, self.requests, self.now = says.split(), 0, 0.0

        def send(self, lines: list[str]) -> None:
            said = self.says[self.requests]
            self.requests += 1
            if said != "ok":
                raise urllib.error.HTTPError("http://store", int(said), said, None, None)

        def sleep(self, seconds: float) -> None:
            self.now += seconds

    def row(says: str) -> tuple:
        store = Store(says)
        try:
            sink.Sender(store, sink.SinkOptions(throttle=2.0), lambda: store.now, store.sleep).send(["x"])
            result = "sent"
        except urllib.error.HTTPError:
            result = "failed"
        return says, result, store.requests, int(store.now)

    return spark.createDataFrame([row(p[0]) for p in PACES], "says string, result string, requests int, waited int")


# --- status ------------------------------------------------------------------------------------


@query(
    "status_of_a_view",
    """SELECT 'streaming_messages' AS name, 'orders' AS "table", 'insert' AS operation, CAST(count(*) AS DOUBLE) AS value FROM orders
    UNION ALL SELECT 'streaming_messages', 'orders', 'delete', CAST(count(*) AS DOUBLE) FROM orders WHERE o_orderkey < 100
    UNION ALL SELECT 'committed_position', NULL, NULL, CAST(1000000000 + max(o_orderkey) + 1 AS DOUBLE) FROM orders WHERE o_orderkey < 100
    UNION ALL SELECT 'reported', NULL, NULL, CAST(max(o_orderkey) + 1 AS DOUBLE) FROM orders""",
)
def status_of_a_view(spark: S, sf: str) -> DataFrame:
    """Counters and positions after two batches; the second is committed within the interval, so it isn't reported yet."""
    status, reported = Status(), []
    view = MaintainedView(spark, demo.config(), scratch.folder(spark, "status"), status=status)
    reporter = Reporter(view.position_of, reported.append, status, clock=lambda: 0.0)
    gone = demo.order_changes(spark, sf, "D").filter("seq <= 100").withColumn("seq", F.col("seq") + 1_000_000_000)
    for n, changes in enumerate((demo.order_changes(spark, sf, "I"), gone)):
        view.apply_changes(changes, n)
        reporter.committed(view.position_of(n))
    rows = [(name, labels.get("table"), labels.get("operation"), value) for name, labels, value in status.rows()]
    return spark.createDataFrame([*rows, *(("reported", None, None, float(p)) for p in reported)], "name string, table string, operation string, value double")
