"""Snapshot sources: Parquet, JDBC and headerless CSV, reading only the columns that a table needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quillview.config import TableSpec


def parquet(spark: SparkSession, path: str, spec: TableSpec | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*spec.needed_columns) if spec else df


def jdbc(spark: SparkSession, url: str, spec: TableSpec, partition_column: str | None = None, lower: int = 0, upper: int = 0, partitions: int = 1, **options: str) -> DataFrame:
    """A table of a database, split by ranges of a numeric column."""
    quoted = ".".join('"' + n.replace('"', '""') + '"' for n in (spec.schema, spec.name))
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", quoted).options(**options)
    if partition_column:
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", partitions)
    return reader.load().select(*spec.needed_columns)


def copy_statement(spec: TableSpec) -> str:
    """The statement that exports a table's needed columns in binary form."""
    quote = lambda n: '"' + n.replace('"', '""') + '"'
    columns = ", ".join(map(quote, spec.needed_columns))
    return f"COPY {quote(spec.schema)}.{quote(spec.name)} ({columns}) TO STDOUT WITH BINARY"


def csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Headerless CSV with a declared schema; quotes are doubled inside quoted cells."""
    return spark.read.schema(schema).option("header", False).option("escape", '"').option("multiLine", True).csv(path)
