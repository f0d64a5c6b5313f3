"""Rendering operations as newline-delimited JSON, packing them into requests, and metrics."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillview.functions.fragments import object_of, quoted

#: Names that the document store knows for operations.
ACTIONS = {"insert": "index"}
MIB = 1 << 20


def header(wire: bool = True) -> Column:
    """``{"action":{"_index":..,"_id":..,"routing":..}}``; with ``wire`` only actions that the store accepts."""
    op = F.when(F.col("op").isin("index", "insert", "update", "delete"), F.col("op")).otherwise("update")
    if wire:
        for ours, theirs in ACTIONS.items():
            op = F.when(F.col("op") == ours, theirs).otherwise(op)
    meta = F.to_json(F.struct(F.col("index").alias("_index"), F.col("id").alias("_id"), F.nullif(F.col("routing"), F.lit("")).alias("routing")))
    return F.concat(F.lit('{"'), op, F.lit('":'), meta, F.lit("}"))


def payload() -> Column:
    """The second line of an operation; null for deletions."""
    doc = object_of(F.coalesce("fields", F.create_map().cast("map<string,string>")))
    params = F.concat(F.lit('"params":{"inline":'), _quoted("inline"), F.lit(',"pk":'), _quoted("pk"))
    script = lambda extra: F.concat(F.lit('{"script":{"id":'), _quoted("op"), F.lit(","), params, extra, F.lit("}}"))
    added = F.concat(
        F.lit('{"script":{"id":'), _quoted("op"), F.lit(","), params, F.lit(',"obj":'), F.col("obj"), F.lit('}},"upsert":'),
        object_of(F.map_concat("stub", F.create_map(F.col("inline"), F.concat(F.lit("["), F.col("obj"), F.lit("]"))))), F.lit("}"),
    )
    return (
        F.when(F.col("op") == "delete", None)
        .when(F.col("op") == "update", F.concat(F.lit('{"doc":'), doc, F.lit("}")))
        .when(F.col("op").isin("index", "insert"), doc)
        .when(F.col("obj").isNotNull(), added)
        .otherwise(script(F.lit("")))
    )


def _quoted(column: str) -> Column:
    return quoted(F.coalesce(F.col(column), F.lit("")))


def render(ops: DataFrame, wire: bool = True) -> DataFrame:
    """``seq, op_ord, table, op, ndjson``: header and payload in one value, so that they stay together."""
    return ops.select("seq", "op_ord", "table", "op", "id", "pk", F.concat_ws("\n", header(wire), payload()).alias("ndjson"))


def greedy_batches(rows: DataFrame, order: list[str], capacity: int = 4 * MIB, partitions: int | None = None) -> DataFrame:
    """Number requests: a row joins the open request if it still fits, else the request is closed.

    A reset sum is sequential, so each partition of the order is packed on its own, in one pass over
    its sorted rows; requests never cross partitions. ``partitions=1`` gives the one sequence of a
    single sender. A row larger than the capacity is a request of its own.
    """
    n = partitions or rows.sparkSession.sparkContext.defaultParallelism
    dealt = (rows.coalesce(1) if n == 1 else rows.repartitionByRange(n, *order)).sortWithinPartitions(*order)
    sized = dealt.withColumn("part", F.spark_partition_id()).withColumn("size", (F.octet_length("ndjson") + 1).cast("long"))

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch, used = 0, 0
        for p in parts:
            numbers = []
            for size in p["size"].tolist():
                if used and used + size > capacity:
                    batch, used = batch + 1, 0
                used += size
                numbers.append(batch)
            yield p.assign(batch=numbers)

    return sized.mapInPandas(pack, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.schema) + ", batch long")


def metrics(ops: DataFrame) -> DataFrame:
    """Operations by table and kind, with the bytes that they take on the wire."""
    return (
        render(ops).groupBy("table", "op").agg(F.count(F.lit(1)).alias("n_ops"), F.sum(F.octet_length("ndjson") + 1).cast("long").alias("n_bytes"))
    )


def running_size(rows: DataFrame, order: list[str], key: str) -> DataFrame:
    """Bytes sent before and with each row of a key, for progress displays."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("sent", F.sum(F.octet_length("ndjson") + 1).over(w))
