"""Incremental maintenance: a stream of change records kept as a table of current documents.

Every micro-batch folds its operations onto the last versions of the documents that it touches, and
appends the new versions under its number, with a mark for documents that are gone. A batch reads
versions of lower numbers only and overwrites its own folders, so running it again after a failure
changes nothing. The current view is the latest version of each document. No operation is kept: a
document's version is all that its history says, in the fold's terms. Records must arrive in log order
from batch to batch, as the log gives them; within a batch they may come in any order.

Versions lie in ``buckets`` by document. Every ``compact_every`` batches the versions of the batches before
are rewritten as one base and the folders they were in are removed, so the files and the rows that a
batch reads stay in proportion to the view, however long the stream runs. A base holds only batches
that are committed: the batch that makes it may run again.

Beside the versions a batch writes its last position (``positions``, heartbeats included: the position is
committed also when a batch carried no rows), the records that lack a key (``quarantine``) and the numbers of
records that no operation stands for, such as truncations (``unsupported``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillview.config import Config
from quillview.operators.fold import ITEM, KEY, fold, ops_of_versions
from quillview.operators.oplog import OPLOG, bad_changes, change_ops, unsupported
from quillview.operators.scripts import STANDARD, Script, of_config
from quillview.sources.changelog import Decoder
from quillview.streaming.status import Status

VERSIONS = f"`index` string, route string, id string, fields map<string,string>, inlines map<string,array<string>>, maps map<string,map<string,string>>, items array<{ITEM}>, gone boolean, bucket int"
#: Kinds of change records as metrics name them.
OPERATIONS = {"I": "insert", "U": "update", "D": "delete", "T": "truncate"}
#: A snapshot's versions come before those of any change.
SNAPSHOT_BATCH = -1


@dataclass
class MaintainedView:
    spark: SparkSession
    config: Config
    path: str
    null_mode: str = "omit"
    shuffle_id_buckets: int = 64
    compact_every: int = 16
    status: Status | None = None
    scripts: Mapping[str, Script] = field(default_factory=lambda: STANDARD)
    _decoder: Decoder | None = field(default=None, repr=False)

    def __post_init__(self) -> None:
        self._effects = of_config(self.config, self.scripts)

    @property
    def _versions(self) -> str:
        return f"{self.path}/versions"

    def load_snapshot(self, ops: DataFrame, position: int | None = None) -> None:
        """Operations of a consistent snapshot, taken at ``position``, before any change."""
        self._note("positions", SNAPSHOT_BATCH, self.spark.createDataFrame([(position,)], "position long"))
        self._apply(ops, SNAPSHOT_BATCH)

    def apply_changes(self, changes: DataFrame, batch: int) -> None:
        self._note("positions", batch, changes.agg(F.max("seq").alias("position")))
        if self.status:  # a row per table and kind
            for r in changes.filter(F.col("table").isNotNull()).groupBy("table", "kind").count().collect():
                self.status.count("streaming_messages", r["count"], table=r.table, operation=OPERATIONS.get(r.kind, r.kind))
        self._note("quarantine", batch, bad_changes(self.config, changes))
        self._note("unsupported", batch, unsupported(changes))
        self._apply(change_ops(self.config, changes, self.null_mode), batch)

    def apply_messages(self, messages: DataFrame, batch: int) -> None:
        """Wire messages of a part of the log; positions of messages without rows are committed too."""
        self._decoder = self._decoder or Decoder(self.spark, self.path)
        self.apply_changes(self._decoder.decode(messages, batch), batch)
        self._note("positions", batch, messages.agg(F.max("lsn").alias("position")))

    def _note(self, kind: str, batch: int, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{kind}/batch={batch}")

    def _noted(self, kind: str, schema: str) -> DataFrame:
        folder = f"{self.path}/{kind}"
        if not self._batches(folder):
            return self.spark.createDataFrame([], f"{schema}, batch long")
        return self.spark.read.schema(f"{schema}, batch long").option("basePath", folder).parquet(folder)

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64("index", "route", "id"), F.lit(self.shuffle_id_buckets)).cast("int")

    def _batches(self, folder: str, prefix: str = "batch=") -> list[int]:
        """Numbers of the folders that a batch committed."""
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(folder)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(at):
            return []
        names = [(s.getPath().getName(), s.getPath()) for s in fs.listStatus(at)]
        done = lambda p: fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
        return sorted(int(n[len(prefix) :]) for n, p in names if n.startswith(prefix) and done(p))

    def _parts(self, below: int | None = None) -> list[str]:
        """Folders that hold the versions of batches below a number: the last base and what came after."""
        below = 1 << 62 if below is None else below
        bases = [b for b in self._batches(self._versions, "base=") if b < below]
        base = bases[-1] if bases else None
        parts = [f"{self._versions}/batch={b}" for b in self._batches(self._versions) if b < below and (base is None or b > base)]
        return ([f"{self._versions}/base={base}"] if base is not None else []) + parts

    def _current(self, parts: list[str], buckets: list[int] | None = None) -> DataFrame:
        """The last version of each document, those that are gone as well."""
        if not parts:
            return self.spark.createDataFrame([], VERSIONS)
        found = None
        for n, part in enumerate(parts):
            rows = self.spark.read.schema(VERSIONS).parquet(part).withColumn("n", F.lit(n))
            found = rows if found is None else found.unionByName(rows)
        if buckets is not None:
            found = found.filter(F.col("bucket").isin(buckets))
        last = found.groupBy(*KEY).agg(F.max_by(F.struct("fields", "inlines", "maps", "items", "gone", "bucket"), "n").alias("v"))
        return last.select(*KEY, "v.*")

    def _write(self, versions: DataFrame, name: str) -> None:
        columns = [c.strip().split(" ")[0].strip("`") for c in ("index", "route", "id", "fields", "inlines", "maps", "items", "gone")]
        versions.select(*columns, "bucket").repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self._versions}/{name}")

    def _apply(self, ops: DataFrame, batch: int) -> None:
        folder = f"{self.path}/ops/batch={batch}"  # removed below
        ops.withColumn("route", F.coalesce("routing", "id")).withColumn("bucket", self._bucket()).write.mode("overwrite").parquet(folder)
        mine = self.spark.read.schema(f"{OPLOG}, route string, bucket int").parquet(folder)
        buckets = [r.bucket for r in mine.select("bucket").distinct().collect()]  # shuffle_id_buckets at most
        touched = mine.select("bucket", *KEY).distinct()
        before = self._current(self._parts(batch), buckets).join(touched, ["bucket", *KEY], "left_semi").filter(~F.col("gone"))
        documents = fold(ops_of_versions(before).unionByName(mine.drop("route", "bucket")), self._effects, keep_items=True)
        if "maps" not in documents.columns:
            documents = documents.withColumn("maps", F.lit(None).cast("map<string,map<string,string>>"))
        self._write(touched.join(documents, KEY, "left").withColumn("gone", F.col("fields").isNull()), f"batch={batch}")
        self._remove([f"{self.path}/ops"])
        if batch >= 0 and batch % self.compact_every == self.compact_every - 1:
            self.compact(batch)

    def compact(self, running: int) -> None:
        """Rewrite the versions below batch ``running`` as one base; gone documents leave it."""
        parts = self._parts(running)
        last = max((b for b in self._batches(self._versions) if b < running), default=None)
        if len(parts) < 2 or last is None:
            return
        self._write(self._current(parts).filter(~F.col("gone")), f"base={last}")
        self._remove(parts)
        # The last batch can have carried no position, so it takes over the highest one.
        reached = self._noted("positions", "position long").filter(F.col("batch") <= last).agg(F.max("position")).first()[0]
        self._note("positions", last, self.spark.createDataFrame([(reached,)], "position long"))
        self._remove([f"{self.path}/positions/batch={b}" for b in self._batches(f"{self.path}/positions") if b < last])

    def _remove(self, paths: list[str]) -> None:
        jvm = self.spark.sparkContext._jvm
        for path in paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def start(self, changes: DataFrame, checkpoint: str, messages: bool = False, **trigger: object) -> StreamingQuery:
        """Maintain the view from a stream of change records, or of wire ``messages``."""
        apply = self.apply_messages if messages else self.apply_changes
        writer = changes.writeStream.foreachBatch(lambda df, n: apply(df, n)).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def view(self) -> DataFrame:
        """Current documents."""
        return self._current(self._parts()).filter(~F.col("gone")).select(*KEY, "fields", "inlines", "maps")

    def position(self) -> DataFrame:
        """The last position that is in the view."""
        return self._noted("positions", "position long").agg(F.max("position").alias("position"))

    def position_of(self, batch: int) -> int | None:
        """The last position that a batch carried; None if it carried none, or the batch is compacted."""
        folder = f"{self.path}/positions"
        if batch not in self._batches(folder):
            return None
        return self.spark.read.schema("position long").parquet(f"{folder}/batch={batch}").first().position

    def quarantine(self) -> DataFrame:
        """Records that made no operation for want of a key, by batch."""
        return self._noted("quarantine", "seq long, kind string, schema string, table string, reason string")

    def unsupported(self) -> DataFrame:
        """Numbers of records that no operation stands for, by batch."""
        return self._noted("unsupported", "schema string, table string, kind string, count long")
