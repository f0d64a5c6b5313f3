"""Change records from files, in batch and as a stream; wire messages to change records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillview.operators.oplog import HOUSEKEEPING, ORDERED_CHANGE

#: A message of the log with its tuples as arrays in column order. ``relation`` names the table;
#: ``ordinal`` (0 where the column is absent) is its place among messages of the same position.
MESSAGE = (
    "lsn long, xid long, message string, relation long, namespace string, name string, columns array<string>, "
    "old array<struct<kind:string,value:string>>, new array<struct<kind:string,value:string>>"
)
ORDERED_MESSAGE = f"{MESSAGE}, ordinal int"
#: Relations whose versions are broadcast; more of them are joined by shuffling.
MOST_RELATIONS = 20_000
#: A table's columns from a position on.
RELATIONS = "relation long, lsn long, ordinal int, namespace string, name string, columns array<string>"


def read(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(ORDERED_CHANGE).format(fmt).load(path)


def stream(spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int | None = None, schema: str = ORDERED_CHANGE) -> DataFrame:
    """Files of change records (or, by ``schema``, messages) as they arrive; the checkpoint remembers which were taken."""
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def after_snapshot(changes: DataFrame, snapshot_seq: int) -> DataFrame:
    """Records that the snapshot doesn't hold yet."""
    return changes.filter(F.col("seq") > snapshot_seq)


def _ordinal(messages: DataFrame) -> Column:
    return F.coalesce("ordinal", F.lit(0)) if "ordinal" in messages.columns else F.lit(0)


def relations(messages: DataFrame) -> DataFrame:
    """Versions of the tables' columns that a log's relation messages tell; repeats of a version are left out."""
    found = messages.filter("message = 'R'").select("relation", "lsn", _ordinal(messages).alias("ordinal"), "namespace", "name", "columns")
    return _without_repeats(found)


def _without_repeats(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("relation").orderBy("lsn", "ordinal")
    said = F.struct("namespace", "name", "columns")
    return found.withColumn("__last", F.lag(said).over(order)).filter(F.col("__last").isNull() | (F.col("__last") != said)).drop("__last")


def decode(messages: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Messages to change records, one for each: tuples are named by the latest relation message before them.

    ``known``: versions (:func:`relations`) that earlier parts of the log told, as a walker over parts
    keeps them. Messages of one position keep their ``ordinal``. Tuple cells are ``t`` (a value as a JSON
    fragment), ``n`` (null) or ``u`` (unchanged, so absent). Begin, commit, origin and type messages carry
    no rows; other kinds pass with no tuples. A relation that nothing told leaves table and tuples null.

    A relation's versions are one row, broadcast after a check of their number, so that a hot table's
    messages are not gathered to be named.
    """
    versions = relations(messages)
    if known is not None:
        versions = _without_repeats(versions.unionByName(known))
    told = versions.groupBy("relation").agg(F.array_sort(F.collect_list(F.struct("lsn", "ordinal", "namespace", "name", "columns"))).alias("__versions"))
    if told.limit(MOST_RELATIONS + 1).count() <= MOST_RELATIONS:
        told = F.broadcast(told)
    rows = messages.filter(~F.col("message").isin(*HOUSEKEEPING)).select("lsn", "xid", "message", "relation", "old", "new", _ordinal(messages).alias("ordinal"))
    before = F.filter("__versions", lambda v: (v["lsn"] < F.col("lsn")) | (v["lsn"] == F.col("lsn")) & (v["ordinal"] <= F.col("ordinal")))
    latest = rows.join(told, "relation", "left").withColumn("r", F.get(before, F.size(before) - 1)).drop("__versions")

    def cells(side: str) -> Column:
        zipped = F.arrays_zip(F.col("r.columns").alias("k"), F.col(side).alias("c"))
        have = F.filter(zipped, lambda z: z["k"].isNotNull() & z["c"].isNotNull() & z["c"]["kind"].isin("t", "n"))
        pairs = F.transform(have, lambda z: F.struct(z["k"].alias("key"), F.when(z["c"]["kind"] == "n", F.lit("null")).otherwise(z["c"]["value"]).alias("value")))
        return F.when(F.col(side).isNotNull(), F.map_from_entries(pairs))

    return latest.select(
        F.col("lsn").alias("seq"), "xid", F.col("message").alias("kind"), F.col("r.namespace").alias("schema"), F.col("r.name").alias("table"),
        cells("old").alias("old"), cells("new").alias("new"), "ordinal",
    )


class Decoder:
    """Decodes a log part by part, keeping the relations' versions in a folder: a relation told in an
    earlier micro-batch names the tuples of later ones. A part decoded again overwrites what it told."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, f"{path}/relations"

    def decode(self, messages: DataFrame, batch: int) -> DataFrame:
        relations(messages).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        found = self.spark.read.schema(f"{RELATIONS}, batch long").option("basePath", self.path).parquet(self.path)
        return decode(messages, found.filter(F.col("batch") < batch).drop("batch"))


def heartbeat(messages: DataFrame) -> DataFrame:
    """The position that may be committed when no rows came."""
    return messages.agg(F.max("lsn").alias("position"))
