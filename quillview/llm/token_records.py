"""Token ids in length-delimited binary record files, with an offset index beside each file.

A record is ``length (u64) | masked checksum of the length (u32) | sequence | masked checksum of the
sequence (u32)``, all little-endian. A sequence is ``width (u8: 2 or 4 bytes an id) | has id (u8) |
document id (i64) | ids``; ids take two bytes where the vocabulary allows it. The checksum is CRC-32
(zlib's polynomial), masked by a rotation by 15 bits and a constant, so that a checksum of bytes
that hold checksums stays useful. The index file has, for each record, its offset and length in the
file and its number of ids, as little-endian u64: a reader can fetch records in any order.

Documents are dealt out by ranges of their id, so the files taken in order hold ascending ids. Every
attempt of a task writes files of its own name and only the committed manifest says which ones count:
a lost executor leaves an orphan, never a torn or doubled shard. Files go through ``pyarrow.fs`` to
the folder that all executors share.

Defined results: a null text counts as empty: its sequence is the end id alone. Rows with a null id
come first. Repeated rows are written once each, next to each other; rows with equal ids are ordered
by text. An empty table gives no records. Other columns of the input are ignored. A record is held
in memory whole; beyond that, memory is bounded by one Arrow batch when writing and by
``read_bytes`` when reading.
"""

from __future__ import annotations

import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, pretokens

# The mask of the public record format.
MASK_DELTA = 0xA282EAD8
#: Distinct words whose ids one worker keeps, in each of two generations.
KEEP_WORDS = 400_000
MANIFEST = "shard int, path string, n_records long, n_ids long, n_bytes long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(sequence: bytes) -> bytes:
    size = struct.pack("<Q", len(sequence))
    return b"".join((size, struct.pack("<I", masked(size)), sequence, struct.pack("<I", masked(sequence))))


def frames(read, limit: int) -> Iterator[tuple[int, bytes]]:
    """(offset, sequence) of a file, checked; ``read(n)`` gives up to n bytes."""
    buffer, start, at = b"", 0, 0  # start: of the buffer in the file; at: in the buffer
    while True:
        need = 12
        if len(buffer) - at >= 12:
            (size,) = struct.unpack_from("<Q", buffer, at)
            if masked(buffer[at : at + 8]) != struct.unpack_from("<I", buffer, at + 8)[0]:
                raise ValueError(f"length checksum differs at offset {start + at}")
            need = 12 + size + 4
            if len(buffer) - at >= need:
                sequence = buffer[at + 12 : at + 12 + size]
                if masked(sequence) != struct.unpack_from("<I", buffer, at + 12 + size)[0]:
                    raise ValueError(f"sequence checksum differs at offset {start + at}")
                yield start + at, sequence
                at += need
                continue
        more = read(max(limit, need - (len(buffer) - at)))
        if not more:
            if at < len(buffer):
                raise ValueError(f"torn record at offset {start + at}")
            return
        buffer, start, at = buffer[at:] + more, start + at, 0


def open_fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def word_ids(path: str, code: str) -> pretokens.Memory:
    """word -> its ids as little-endian bytes, one memory per worker process and tokenizer."""
    if (path, code) not in _memories:
        ids = pretokens.load(path).ids

        def make(word: str) -> bytes:
            found = array(code, ids(word))
            if sys.byteorder == "big":
                found.byteswap()
            return found.tobytes()

        _memories[path, code] = pretokens.Memory(make, KEEP_WORDS)
    return _memories[path, code]


_memories: dict[tuple[str, str], pretokens.Memory] = {}


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """Encode and write every document; returns the manifest (also a table in ``folder``), a row per file."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[id_column].cast("long").alias("id"), common.text_or_empty(docs, text_column).alias("text"))
    # Equal ids are told apart by text, so neither the deal nor the order depends on how rows arrive.
    dealt = rows.repartitionByRange(shards, "id").sortWithinPartitions("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        pieces = pretokens.load(tokenizer_path)
        width = 2 if max(pieces.size, end_id) < 1 << 16 else 4
        known = word_ids(tokenizer_path, "H" if width == 2 else "I")
        cut, end = pieces.pretokens, end_id.to_bytes(width, "little")
        shard = TaskContext.get().partitionId()
        fs, base = open_fs(folder)
        name = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex}"
        fs.create_dir(base, recursive=True)
        offset, n_ids, index = 0, 0, []
        with fs.open_output_stream(f"{name}.rec") as out:
            batch = first
            while batch is not None:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    parts = list(map(known.__getitem__, cut(text)))
                    parts.append(end)
                    ids = b"".join(parts)
                    record = frame(struct.pack("<BBq", width, doc is not None, doc or 0) + ids)
                    out.write(record)
                    index.append((offset, len(record), len(ids) // width))
                    offset += len(record)
                    n_ids += len(ids) // width
                batch = next((b for b in batches if b.num_rows), None)
        with fs.open_output_stream(f"{name}.idx") as out:
            out.write(np.asarray(index, "<u8").tobytes())
        where = folder.rstrip("/") + name[len(base) :]
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "path": [where], "n_records": [len(index)], "n_ids": [n_ids], "n_bytes": [offset]}
        )

    manifest = dealt.mapInArrow(write, MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_records(manifest: DataFrame, digest: bool = False, read_bytes: int = 4 << 20) -> DataFrame:
    """Every record of the manifest's files: ``doc_id``, ``start`` (ids of all records before it),
    ``n_tokens`` and the ``ids``, or with ``digest`` the CRC-32 of the ids as little-endian u32."""
    # One row per file: the running sum over files is over a table of bounded rows of a few bytes.
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    last = "ids_crc32 long" if digest else "ids array<long>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = open_fs(row["path"])
                start, held, found = row["base"], 0, []
                with fs.open_input_stream(f"{path}.rec") as file:
                    for _, sequence in frames(file.read, read_bytes):
                        width, has, doc = struct.unpack_from("<BBq", sequence)
                        ids = np.frombuffer(sequence, f"<u{width}", offset=10)
                        found.append((doc if has else None, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids.astype(np.int64)))
                        start += len(ids)
                        held += 64 if digest else 8 * len(ids)
                        if held >= read_bytes:
                            yield _records(found, digest)
                            held, found = 0, []
                if found:
                    yield _records(found, digest)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path", "base").repartition(n, "path").mapInArrow(read, f"doc_id long, start long, n_tokens long, {last}")


def _records(found: list[tuple], digest: bool) -> pa.RecordBatch:
    doc, start, n, last = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(last, pa.int64() if digest else pa.list_(pa.int64()))],
        names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
    )


def read_at(path: str, numbers: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """Records of one file by their place in it, through the index: for shuffled reads."""
    fs, base = open_fs(path)
    with fs.open_input_stream(f"{base}.idx") as file:
        index = np.frombuffer(file.read(), "<u8").reshape(-1, 3)
    out = []
    with fs.open_input_file(f"{base}.rec") as file:
        for k in numbers:
            offset, length, _ = (int(x) for x in index[k])
            ((_, sequence),) = frames(_part(file, offset, length), length)
            width, has, doc = struct.unpack_from("<BBq", sequence)
            out.append((doc if has else None, np.frombuffer(sequence, f"<u{width}", offset=10)))
    return out


def _part(file, offset: int, length: int):
    """A ``read`` that ends after ``length`` bytes."""
    file.seek(offset)
    left = [length]

    def read(n: int) -> bytes:
        data = file.read(min(n, left[0]))
        left[0] -= len(data)
        return data

    return read


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import default_tokenizer

    manifest = write_records(common.table(spark, sf_dir, "documents"), common.new_path(spark, "records"), default_tokenizer(), end_id=2)
    return read_records(manifest, digest=True)
