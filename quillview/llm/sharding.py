"""Sharding by vector bin packing: bytes, tokens and rows of the shards are balanced jointly.

Equal texts form a group. A group's demand is its bytes, tokens and rows, each as a part of one shard's
capacity, and the largest groups (by their greatest demand of the three) are packed first, each into the shard where
the dot product of its demand with the shard's residual capacity is highest. Bytes, whose law holds,
weigh four times in it; tokens and rows weigh the same.

Groups above 1/``bins`` of all rows or bytes are packed on the driver: there can be at most twice ``bins``
of them. Every other group is packed in a task of its own part of the groups, dealt by hash into parts of
about ``part_groups`` groups; the capacities of a part are what the large groups left of each shard,
scaled to the part. So each group is packed by itself by the same rule at every size, and what a
task or the driver holds is bounded. A part is left balanced to within one of its last, smallest
groups.

The law that holds is ``bytes``: shard sizes near equal. It needs one way out: a group with more bytes,
tokens or rows than a shard's equal share fits in no shard. It is dealt by id into as many pieces as
there are shards, packed before all else, so that its texts stand in several shards. Every other group
is whole in one shard. Ties of the dot product go to the smallest shard; groups of equal demand are
packed in the order of their digests.

Slots are numbered without gaps: a shard is a run of parts, each numbered by itself and offset by the
rows of the parts before; no task ever holds a shard. Groups are told apart by 128 bits of hash.

Defined results: a null text has size 8, CRC-32 0 and forms a group with the other null and empty
texts. Null ids come first within their part. Repeated rows get a slot each. An empty table gives
an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: What a row adds to a shard besides its text.
ROW_BYTES = 8
#: Of bytes, tokens and rows in the dot product.
WEIGHTS = (4.0, 1.0, 1.0)


def pack(demands: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Shard of each unit, the largest first; ``demands`` and ``residual`` (a row a shard, spent here): bytes, tokens, rows."""
    out = np.empty(len(demands), np.int64)
    weighted = demands * WEIGHTS
    for i in np.argsort(-demands.max(1), kind="stable").tolist():
        at = int(np.argmax(residual @ weighted[i]))
        out[i] = at
        residual[at] -= demands[i]
    return out


def _packed_parts(groups: DataFrame, shares: list[list[float]]) -> DataFrame:
    """``group, part, shard`` of every group; ``shares``: each shard's part of what is left, by kind."""
    share = np.array(shares)

    def place(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("g1", "ascending"), ("g2", "ascending")])
        demands = np.stack([rows.column(c).to_numpy().astype(np.float64) for c in ("bytes", "tokens", "rows")], 1)
        total = demands.sum(0)
        # One shard's capacity is the unit of each kind.
        unit = np.where(total > 0, total / len(share), 1.0)
        shard = pack(demands / unit, share * len(share))
        return pa.Table.from_arrays([rows.column("g1"), rows.column("g2"), rows.column("part"), pa.array(shard, pa.int32())], names=["g1", "g2", "part", "shard"])

    return groups.select("g1", "g2", "part", "bytes", "tokens", "rows").groupBy("part").applyInArrow(place, "g1 long, g2 long, part long, shard int")


def shard(
    docs: DataFrame,
    shards: int = 24,
    bins: int = 4096,
    part_groups: int = 32768,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Each row's size, text checksum, shard and slot.

    ``bins``: groups above 1/``bins`` of the rows or bytes are packed on the driver; ``part_groups``: groups
    that a task packs.
    """
    spark = docs.sparkSession
    text = common.text_or_empty(docs, text_column)
    rows = common.materialize(
        docs.select(
            docs[id_column].alias("doc_id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.regexp_count(text, F.lit("[^ \\t-\\r]+")).cast("long").alias("tokens"),
            F.xxhash64(text).alias("g1"),
            F.xxhash64(F.lit(1), text).alias("g2"),
        ),
        "sharding-rows",
    )
    one = ["g1", "g2"]
    groups = common.materialize(rows.groupBy(*one).agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens")), "sharding-groups")
    kinds = ("bytes", "tokens", "rows")
    n_groups, *found = groups.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(k), F.lit(0)) for k in kinds]).first()
    total = np.array(found, float)
    unit = np.where(total > 0, total / shards, 1.0)
    large = (F.col("rows") * bins > int(total[2])) | (F.col("bytes") * bins > int(total[0]))
    over = reduce(lambda a, b: a | b, [F.col(k) * shards > int(t) for k, t in zip(kinds, total, strict=True)])
    # At most 2 * bins above 1 / bins, and under three times the shards above a share.
    heavy = groups.filter(large | over).withColumn("over", over).orderBy(F.desc("over"), *one).collect()
    # A whole group is a unit, and so is a piece of one that doesn't fit: under 3 * shards * shards pieces.
    table, first = [], 0
    for h in heavy:
        pieces = shards if h.over else 1
        table.append((h.g1, h.g2, first, pieces))
        first += pieces
    named = F.broadcast(spark.createDataFrame(table, "g1 long, g2 long, first int, pieces int"))
    piece = F.col("first") + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("pieces")).cast("int")
    in_units = rows.join(named, one).withColumn("unit", piece)
    demands = np.zeros((first, 3))
    for u in in_units.groupBy("unit").agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).collect():
        demands[u[0]] = np.array(u[1:], float) / unit
    residual = np.ones((shards, 3))
    n_pieces = sum(n for *_, n in table if n > 1)
    where = [*pack(demands[:n_pieces], residual).tolist(), *pack(demands[n_pieces:], residual).tolist()]
    left = np.maximum(residual, 0.0)
    left /= np.maximum(left.sum(0), 1e-12)
    parts = max(1, -(-n_groups // part_groups))
    light = groups.filter(~(large | over)).withColumn("part", F.pmod("g1", F.lit(parts)))
    placed = _packed_parts(light, left.tolist())
    units = F.broadcast(spark.createDataFrame([(-k - 1, k, s) for k, s in enumerate(where)], "part long, unit int, shard int"))
    of_heavy = in_units.join(units, "unit").select("doc_id", "size", "text_crc32", "part", "shard")
    of_light = rows.join(named.select(*one), one, "left_anti").join(placed, one).select("doc_id", "size", "text_crc32", "part", "shard")
    run = ["shard", "part"]
    numbered = common.materialize(
        of_heavy.unionByName(of_light).withColumn("place", F.row_number().over(Window.partitionBy(*run).orderBy("doc_id", "text_crc32", "size"))), "sharding-numbered"
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy(*run).agg(F.count(F.lit(1)).alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    common.release(rows, groups)
    return numbered.join(offsets, run).select(
        F.col("doc_id").alias(id_column),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("offset") + F.col("place") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(common.table(spark, sf_dir, "documents"))
