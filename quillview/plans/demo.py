"""The test tables in the roles that the engine knows: comments with tags, and change records made from them."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillview.config import Config, build_config
from quillview.operators.oplog import OPLOG, rows_as_changes
from quillview.plans.registry import table

#: table: (table comment, {column: column comment}, columns whose old value is in the log)
COMMENTS: dict[str, tuple[str, dict[str, str], tuple[str, ...]]] = {
    "customer": (
        'index:"customer,all" join:"join,customer"',
        {"c_custkey": 'index:"key,id"', "c_name": 'index:"name"', "c_nationkey": "", "c_acctbal": 'index:"-"', "c_mktsegment": 'index:"segment"    market'},
        ("c_custkey",),
    ),
    "orders": (
        'index:"order" join:"join,order" inline:"items,items"',
        {"o_orderkey": 'index:"key,pk"', "o_custkey": 'index:"customer,routing" join:"parent"', "o_orderstatus": 'index:"status"', "o_totalprice": "price of all",
         "o_orderdate": 'index:"date"', "o_orderpriority": 'index:""'},
        ("o_orderkey", "o_custkey"),
    ),
    "lineitem": (
        'index:"-"',
        {"l_orderkey": 'inline:"items,parent"', "l_item": 'inline:"items,pk"', "l_partkey": 'inline:"items" index:"part"', "l_quantity": 'inline:"items" index:"quantity"',
         "l_returnflag": 'inline:"items" index:"flag"', "l_shipmode": ""},
        ("l_orderkey", "l_item"),
    ),
}


def catalog_rows(comments: dict = COMMENTS) -> list[dict]:
    return [
        {"schema": "public", "table": t, "column": c, "table_comment": own, "column_comment": note, "pk": k == 0, "old_in_log": c in old}
        for t, (own, columns, old) in comments.items()
        for k, (c, note) in enumerate(columns.items())
    ]


@cache
def config() -> Config:
    return build_config("shop", catalog_rows())


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a key of their own: (order, line number) repeats, so repeats are numbered."""
    df = table(spark, sf_dir, "lineitem")
    rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    n = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*rest))
    return df.withColumn("l_item", F.concat_ws("-", "l_linenumber", n))


#: The same in SQL, for statements that check results.
ITEMS_SQL = """
SELECT *, l_linenumber || '-' || row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS l_item FROM lineitem
"""


def order_changes(spark: SparkSession, sf_dir: str, kind: str, moved: bool = False, null_status: bool = False) -> DataFrame:
    """Changes of orders: ``U`` sets the status to X; with ``moved`` every fifth order gets another customer and key."""
    o = table(spark, sf_dir, "orders")
    old = {"o_orderkey": F.col("o_orderkey"), "o_custkey": F.col("o_custkey")}
    move = (F.col("o_orderkey") % 5 == 0) & F.lit(moved)
    key: Column = F.when(move, F.col("o_orderkey") + 100_000_000).otherwise(F.col("o_orderkey"))
    cust = F.when(move, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    status = F.when(F.lit(null_status), F.lit(None).cast("string")).otherwise(F.lit("X"))
    new = {"o_orderkey": key, "o_custkey": cust, "o_orderstatus": status, "o_orderdate": F.col("o_orderdate"), "o_orderpriority": F.col("o_orderpriority")}
    full = {c: F.col(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")}
    return rows_as_changes(
        o, "orders", F.lit(kind), F.col("o_orderkey") + 1, None if kind == "I" else old, {"I": full, "U": new, "D": None}[kind]
    )


def item_changes(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Changes of line items; updates move every seventh order's items to the next order."""
    rows = items(spark, sf_dir)
    old = {"l_orderkey": F.col("l_orderkey"), "l_item": F.col("l_item")}
    parent = F.when(F.col("l_orderkey") % 7 == 0, F.col("l_orderkey") + 1).otherwise(F.col("l_orderkey"))
    new = {"l_orderkey": parent, "l_item": F.col("l_item"), "l_partkey": F.col("l_partkey"), "l_quantity": F.col("l_quantity"), "l_returnflag": F.col("l_returnflag")}
    return rows_as_changes(rows, "lineitem", F.lit(kind), F.col("l_orderkey") + 1, None if kind == "I" else old, None if kind == "D" else new)


def event_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as operations on a document per user: sign-ups write it, errors delete it, views update
    it, clicks and purchases add and remove objects of its array."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    op = F.expr("CASE event_type WHEN 'signup' THEN 'index' WHEN 'view' THEN 'update' WHEN 'click' THEN 'inline_add' WHEN 'error' THEN 'delete' ELSE 'inline_del' END")
    value = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 7 == 1, "null").otherwise(F.col("value").cast("string"))
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    fields = F.map_from_entries(F.filter(F.array(pair("value", value), pair("k", F.when(op == "index", F.col("k").cast("string"))), pair("last", F.col("event_id").cast("string"))), lambda x: x["value"].isNotNull()))
    none = F.lit(None)
    arrays = op.isin("inline_add", "inline_del")
    return e.select(
        F.col("event_id").alias("seq"), F.lit(0).alias("op_ord"), F.lit("app").alias("index"), F.col("user_id").cast("string").alias("id"), none.cast("string").alias("routing"),
        op.alias("op"), F.when(op.isin("index", "update"), fields).alias("fields"), F.when(arrays, F.lit("items")).alias("inline"),
        F.when(arrays, (F.col("k") % 5).cast("string")).alias("pk"),
        F.when(op == "inline_add", F.to_json(F.struct("event_id", "k"))).alias("obj"),
        F.when(op == "inline_add", F.create_map(F.lit("docType"), F.lit('"user"'))).alias("stub"), F.lit("events").alias("table"),
    ).to(spark.createDataFrame([], OPLOG).schema)
