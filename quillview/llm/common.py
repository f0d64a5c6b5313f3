"""What the operators of this subpackage share: durable intermediate tables and small helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a function of Arrow batches gets at a time.
SLICE = 512
#: Setting that names the folder which driver and executors share.
SHARED_DIR = "spark.checkpoint.dir"

_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables and files that outlive any executor.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset (tests in one JVM), a
    temporary folder of this process is used instead.
    """
    global _own_dir
    named = spark.sparkContext.getConf().get(SHARED_DIR) or spark.conf.get(SHARED_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{SHARED_DIR} must name a folder that all executors share")
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="quillview-")
    return _own_dir


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/quillview/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    _written.append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._materialized_at = path
    return table


#: Folders that :func:`materialize` wrote in this process and nothing has deleted yet.
_written: list[str] = []


def delete(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        if path in _written:
            _written.remove(path)


def release(*tables: DataFrame) -> None:
    """Delete materialized tables that no later plan reads."""
    for t in tables:
        delete(t.sparkSession, [t._materialized_at])


@contextmanager
def scratch(spark: SparkSession, *kept: list[DataFrame]) -> Iterator[None]:
    """Delete what is materialized inside, except the tables put into ``kept``."""
    before = set(_written)
    yield
    stay = {t._materialized_at for tables in kept for t in tables}
    delete(spark, [p for p in _written if p not in before and p not in stay])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to slices of every Arrow batch, so that what it holds is in proportion to ``SLICE`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                yield fn(batch.slice(at, SLICE))

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column without decoding it."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def text_or_empty(df: DataFrame, column: str = "text") -> F.Column:
    return F.coalesce(df[column].cast("string"), F.lit(""))


def computed(df: DataFrame, keep: list[str], **columns: F.Column) -> DataFrame:
    """``keep`` and new columns, each computed once per row: a generator is a step that the optimizer doesn't fold away."""
    fields = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(fields)))
