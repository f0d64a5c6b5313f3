"""Generated parents, children and inline rows: ids by rule, numbers of rows by hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _between(low: int, high: int, *parts: F.Column) -> F.Column:
    return F.pmod(F.xxhash64(*parts), F.lit(high - low + 1)) + low


def parents(spark: SparkSession, n: int = 1000, seed: int = 0) -> DataFrame:
    i = F.col("i")
    word = lambda k: F.substring(F.md5(F.concat_ws("|", F.lit(seed), i, F.lit(k))), 1, 8)
    return spark.range(n).withColumnRenamed("id", "i").select(
        F.format_string("ID%06d", i).alias("id"),
        F.timestamp_seconds(1_600_000_000 + i * 60).alias("date"),
        (_between(0, 1, F.lit(seed), i, F.lit("d")) == 1).alias("deleted"),
        F.struct(word("k").alias("key"), word("v").alias("value"), word("n").alias("name")).alias("nested"),
        word("t").alias("text"),
        F.array(word("a"), word("b"), word("c")).alias("text_array"),
        F.lit("ignored").alias("ignore_me"),
        i.alias("i"),
    )


def _of(parent: DataFrame, prefix: str, low: int, high: int, seed: int) -> DataFrame:
    n = _between(low, high, F.lit(seed), F.col("i"), F.lit(prefix))
    numbered = parent.withColumn("k", F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(F.array().cast("array<bigint>"))))
    return numbered.select(
        F.format_string(f"{prefix}%06d:%02d", "i", "k").alias("id"),
        F.col("id").alias("parent_id"),
        F.substring(F.md5(F.concat_ws("|", F.lit(prefix), "i", "k")), 1, 10).alias("value"),
        F.lit("ignored").alias("ignore_me"),
    )


def children(parent: DataFrame, low: int = 5, high: int = 25, seed: int = 0) -> DataFrame:
    return _of(parent, "CHILD", low, high, seed)


def inline_rows(parent: DataFrame, low: int = 0, high: int = 3, seed: int = 0) -> DataFrame:
    return _of(parent, "INLINE", low, high, seed)
