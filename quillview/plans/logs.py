"""Registered queries: other sources, wire messages, quarantine, the tag language, and the maintained view."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillview import config, engine
from quillview.functions.fragments import unfragment
from quillview.operators import oplog
from quillview.plans import demo
from quillview.plans.registry import query, table
from quillview.sources import binary_copy, changelog, scratch, tables
from quillview.streaming.maintain import MaintainedView
from quillview.streaming.sink import SinkOptions

S = SparkSession
#: Ten orders share a position of the log; from this position on the table has one more column.
WIDER_FROM = 100


def _messages(spark: S, sf: str) -> DataFrame:
    """Wire messages of a log that inserts every order, several tuples to a position."""
    o = table(spark, sf, "orders")
    cell = lambda c: F.struct(F.lit("t").alias("kind"), c.alias("value"))
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    lsn = F.floor(F.col("o_orderkey") / 10) + 1
    first = F.array(cell(F.col("o_orderkey").cast("string")), cell(text(F.col("o_orderstatus"))))
    wide = F.concat(first, F.array(cell(F.col("o_custkey").cast("string"))))
    none = F.lit(None)
    rows = o.select(
        lsn.alias("lsn"), F.lit(1).cast("long").alias("xid"), F.lit("I").alias("message"), F.lit(7).cast("long").alias("relation"), none.cast("string").alias("namespace"),
        none.cast("string").alias("name"), none.cast("array<string>").alias("columns"), none.cast("array<struct<kind:string,value:string>>").alias("old"),
        F.when(lsn >= WIDER_FROM, wide).otherwise(first).alias("new"), (F.col("o_orderkey") % 10 + 1).cast("int").alias("ordinal"),
    )
    told = [(0, ["o_orderkey", "o_orderstatus"]), (50, ["o_orderkey", "o_orderstatus"]), (WIDER_FROM, ["o_orderkey", "o_orderstatus", "o_custkey"])]
    more = [(at, 1, "R", 7, "public", "orders", names, None, None, 0) for at, names in told]
    more += [(3, 1, kind, None, None, None, None, None, None, 20 + k) for k, kind in enumerate("BOYC")] + [(10**9, 2, "T", 7, None, None, None, None, None, 1)]
    return rows.unionByName(spark.createDataFrame(more, changelog.ORDERED_MESSAGE))


@query(
    "wire_decode",
    f"""SELECT o_orderkey // 10 + 1 AS seq, CAST(o_orderkey % 10 + 1 AS INTEGER) AS ordinal, 'I' AS kind, 'orders' AS "table", CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS status,
    CASE WHEN o_orderkey // 10 + 1 >= {WIDER_FROM} THEN CAST(o_custkey AS VARCHAR) END AS customer FROM orders
    UNION ALL SELECT 1000000000, 1, 'T', 'orders', NULL, NULL, NULL""",
)
def wire_decode(spark: S, sf: str) -> DataFrame:
    value = lambda c: unfragment(F.col("new")[c])
    return changelog.decode(_messages(spark, sf)).select(
        "seq", "ordinal", "kind", "table", value("o_orderkey").alias("key"), value("o_orderstatus").alias("status"), value("o_custkey").alias("customer")
    )


@query(
    "wire_ops_in_order",
    """SELECT 'orders_' || o_orderkey AS id, o_orderkey // 10 + 1 AS seq, row_number() OVER (PARTITION BY o_orderkey // 10 ORDER BY o_orderkey) AS place FROM orders""",
)
def wire_ops_in_order(spark: S, sf: str) -> DataFrame:
    """Operations of tuples of one position keep the tuples' order."""
    from pyspark.sql import Window

    ops = oplog.change_ops(demo.config(), changelog.decode(_messages(spark, sf)))
    return ops.select("id", "seq", F.row_number().over(Window.partitionBy("seq").orderBy("op_ord")).cast("long").alias("place"))


@query("heartbeat_position", "SELECT CAST(1000000000 AS BIGINT) AS position")
def heartbeat_position(spark: S, sf: str) -> DataFrame:
    return changelog.heartbeat(_messages(spark, sf))


@query("unsupported_records", """SELECT 'public' AS schema, 'orders' AS "table", 'T' AS kind, CAST(1 AS BIGINT) AS n""")
def unsupported_records(spark: S, sf: str) -> DataFrame:
    return oplog.unsupported(changelog.decode(_messages(spark, sf))).withColumnRenamed("count", "n")


@query("log_cut_at_snapshot", "SELECT o_orderkey + 1 AS seq, 'U' AS kind FROM orders WHERE o_orderkey + 1 > 700")
def log_cut_at_snapshot(spark: S, sf: str) -> DataFrame:
    return changelog.after_snapshot(demo.order_changes(spark, sf, "U"), 700).select("seq", "kind")


def _keyless(spark: S, sf: str) -> DataFrame:
    """Every tenth inserted order comes without its key."""
    lost = (F.col("seq") - 1) % 10 == 0
    return demo.order_changes(spark, sf, "I").withColumn("new", F.map_filter("new", lambda k, _: ~(lost & (k == "o_orderkey"))))


@query("quarantine_keyless", "SELECT o_orderkey + 1 AS seq, 'no value for a key of orders' AS reason FROM orders WHERE o_orderkey % 10 = 0")
def quarantine_keyless(spark: S, sf: str) -> DataFrame:
    return oplog.bad_changes(demo.config(), _keyless(spark, sf)).select("seq", "reason")


@query("keyless_make_no_operation", "SELECT 'orders_' || o_orderkey AS id FROM orders WHERE o_orderkey % 10 <> 0")
def keyless_make_no_operation(spark: S, sf: str) -> DataFrame:
    return oplog.change_ops(demo.config(), _keyless(spark, sf)).select("id")


@query("csv_snapshot", "SELECT n_nationkey, n_name || ', \"the\"' AS name, n_regionkey FROM nation")
def csv_snapshot(spark: S, sf: str) -> DataFrame:
    path = scratch.folder(spark, "csv")
    rows = table(spark, sf, "nation").select("n_nationkey", F.concat("n_name", F.lit(', "the"')).alias("name"), "n_regionkey")
    rows.write.option("header", False).option("escape", '"').csv(path)
    return tables.csv(spark, path, "n_nationkey int, name string, n_regionkey int")


@query("binary_copy_snapshot", "SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END AS c_nationkey FROM customer")
def binary_copy_snapshot(spark: S, sf: str) -> DataFrame:
    """Customers as files of the binary format, read again."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")).alias("c_nationkey"))

    def export(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = lambda kind, v: None if v is None else struct.pack(kind, v)
        for b in batches:
            cells = [[pack(">q", k), n and n.encode(), pack(">d", x), pack(">i", c)] for k, n, x, c in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            yield pa.RecordBatch.from_pydict({"content": pa.array([binary_copy.write(cells)], pa.binary())})

    files = rows.mapInArrow(export, "content binary")
    return binary_copy.parse(files, {"c_custkey": "bigint", "c_name": "string", "c_acctbal": "double", "c_nationkey": "int"})


@query(
    "maintained_view_of_a_stream",
    """SELECT 'orders_' || (o_orderkey + CASE WHEN o_orderkey % 5 = 0 THEN 100000000 ELSE 0 END) AS id, 'X' AS status,
    CAST(o_custkey + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS VARCHAR) AS route FROM orders""",
)
def maintained_view_of_a_stream(spark: S, sf: str) -> DataFrame:
    """A snapshot and a stream of records from files, some of which the snapshot holds, kept as a view."""
    path = scratch.folder(spark, "view")
    moved = demo.order_changes(spark, sf, "U", moved=True).withColumn("seq", F.col("seq") + 1_000_000_000)
    moved.unionByName(demo.order_changes(spark, sf, "D")).write.parquet(f"{path}/log")
    options = engine.Options("shop", "pub", f"{path}/state")
    snapshot = {"orders": table(spark, sf, "orders")}
    following = engine.run(spark, demo.config(), options, "snapshot+stream", snapshot, changelog.stream(spark, f"{path}/log"), snapshot_position=1_000_000_000)
    following.awaitTermination()
    view = MaintainedView(spark, demo.config(), options.path).view()
    return view.select("id", unfragment(F.col("fields")["status"]).alias("status"), "route")


@query(
    "view_of_wire_messages",
    f"""SELECT 'orders_' || o_orderkey AS id, o_orderstatus AS status, CASE WHEN o_orderkey // 10 + 1 >= {WIDER_FROM} THEN CAST(o_custkey AS VARCHAR) END AS customer FROM orders""",
)
def view_of_wire_messages(spark: S, sf: str) -> DataFrame:
    """Messages in two parts: the second's tuples are named by relations that the first told."""
    path = scratch.folder(spark, "wire")
    view = MaintainedView(spark, demo.config(), path)
    messages = _messages(spark, sf)
    for n, part in enumerate((F.col("lsn") <= WIDER_FROM, F.col("lsn") > WIDER_FROM)):
        view.apply_messages(messages.filter(part), n)
    return view.view().select("id", unfragment(F.col("fields")["status"]).alias("status"), unfragment(F.col("fields")["customer"]).alias("customer"))


CASES = (
    ("", "no tags"), ('tag:"value"', "tag=value"), ('tag:"a"tag2:"b"', "tag=a tag2=b"), ('a:"x,y" a:"z"', "a=x,y a=z"), ('tag:"v" # note', "tag=v"),
    ('tag:"v"    note', "tag=v"), ('tag:"v"   note', "error"), ("currency is a code", "error"), ('index:"-"', "index=-"), ('index:",id"', "index=,id"),
    (r'tag:"a\"b"', 'tag=a"b'), ('tag:"open', "error"), ('tag:"\\x41\\102\\a"', "tag=AB\a"), ('tag:"\\u00e9\\U0001F600"', "tag=é😀"), ('tag:"\\q"', "error"),
)


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query("tag_parse_cases", "SELECT * FROM (VALUES " + ", ".join(f"({_literal(c)}, {_literal(r)})" for c, r in CASES) + ") v(comment, result)")
def tag_parse_cases(spark: S, sf: str) -> DataFrame:
    def result(comment: str) -> str:
        try:
            return " ".join(f"{t.name}={','.join(t.values)}" for t in config.parse_tags(comment)) or "no tags"
        except config.TagSyntaxError:
            return "error"

    return spark.createDataFrame([(c, result(c)) for c, _ in CASES], "comment string, result string")


CONFIGS = (
    ("key from the table", {"t": ('index:"doc"', {"id": "", "v": 'index:"v"'}, ("id",))}, "pk=id routing=None prefix=True upsert_only=False"),
    ("option id", {"t": ('index:"doc"', {"id": 'index:",id"'}, ("id",))}, "pk=id routing=None prefix=False upsert_only=False"),
    ("option routing", {"t": ('index:"doc"', {"id": 'index:",pk"', "r": 'index:",routing"'}, ("id",))}, "pk=id routing=r prefix=True upsert_only=True"),
    ("unknown option", {"t": ('index:"doc"', {"id": 'index:",what"'}, ("id",))}, "error"),
    ("inline without parent column", {"t": ('inline:"i,f"', {"id": ""}, ("id",)), "u": ('index:"-"', {"id": 'inline:"i,pk"'}, ("id",))}, "error"),
    ("inline nobody declared", {"t": ('index:"doc"', {"id": 'inline:"i,pk"'}, ("id",))}, "error"),
    ("inline declared twice", {"t": ('inline:"i"', {"id": ""}, ("id",)), "u": ('inline:"i"', {"id": ""}, ("id",))}, "error"),
    ("join with a bad word", {"t": ('join:"join"', {"id": 'join:"child"'}, ("id",))}, "error"),
)


@query("config_cases", "SELECT * FROM (VALUES " + ", ".join(f"({_literal(n)}, {_literal(r)})" for n, _, r in CONFIGS) + ') v("case", result)')
def config_cases(spark: S, sf: str) -> DataFrame:
    def result(comments: dict) -> str:
        try:
            t = config.build_config("db", demo.catalog_rows(comments)).table("t")
        except config.ConfigError:
            return "error"
        return f"pk={t.pk} routing={t.routing} prefix={t.prefix_id} upsert_only={t.upsert_only}"

    return spark.createDataFrame([(n, result(c)) for n, c, _ in CONFIGS], "case string, result string")


@query(
    "sink_option_ranges",
    "SELECT * FROM (VALUES (0, 0.2, 0.0, 0.0, 4194304, 5.0, 0.5, 0.1), (100, 1.0, 2.0, 0.3, 104857600, 1.0, 2.0, 0.3), (101, 30.0, -1.0, -1.0, 4194304, 30.0, 0.5, 0.1)) v(mib, idle, throttle, debounce, bytes, idle_s, throttle_s, debounce_s)",
)
def sink_option_ranges(spark: S, sf: str) -> DataFrame:
    given = [(0, 0.2, 0.0, 0.0), (100, 1.0, 2.0, 0.3), (101, 30.0, -1.0, -1.0)]
    found = [(*g, o.bulk_size, o.idle, o.throttle, o.debounce) for g in given for o in (SinkOptions.clamped(*g),)]
    return spark.createDataFrame(found, "mib int, idle double, throttle double, debounce double, bytes int, idle_s double, throttle_s double, debounce_s double")
