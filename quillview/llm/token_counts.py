"""Token counts without token ids: each distinct pre-token is counted once for the whole corpus.

Documents are taken in blocks (Arrow batches). A block's pre-tokens become a small inverted table:
for each distinct pre-token the documents of the block that hold it and how often. The tables are
dealt out by a hash of the pre-token, so all of a pre-token's entries in the corpus meet in one
task, which asks the tokenizer for its number of pieces once, joins that number to the frequencies
and adds them up per document. The partial sums go back to their block and are added there.

A frequent pre-token is one entry per block whatever its frequency, so no task gets more because of
it. What is shuffled is each block's distinct pre-tokens and postings, less than the text itself.
Block names come from the partition and the batch in it: the input must be a table that reads the
same when a lost task runs again, as files do (``common.materialize`` makes one).

Defined results: a null text counts as empty, with no bytes and no tokens. Null ids pass through,
repeated rows give repeated results, order does not matter, an empty table gives an empty result,
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, pretokens

#: Distinct pre-tokens that one task keeps; beyond it the memory is emptied and counted anew.
KEEP_WORDS = 1_000_000


def _ints(x: np.ndarray) -> bytes:
    """The smallest of three widths that holds the values, named by the first byte."""
    top = int(x.max()) if len(x) else 0
    kind = "B" if top < 1 << 8 else "H" if top < 1 << 16 else "I"
    return kind.encode() + x.astype(f"<u{'BHI'.index(kind) * 2 or 1}").tobytes()


def _array(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<u{'BHI'.index(chr(b[0])) * 2 or 1}", offset=1).astype(np.int64)


def _block_tables(batches: Iterator[pa.RecordBatch], path: str, buckets: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    cut = pretokens.load(path).pretokens
    part = TaskContext.get().partitionId()
    for number, batch in enumerate(b for b in batches if b.num_rows):
        block = (part << 32) + number
        known = pretokens.Numbers()
        rows, at = [], []
        for k, text in enumerate(batch.column(2).to_pylist()):
            if text and (found := cut(text)):
                rows.append(np.fromiter(map(known.__getitem__, found), np.int64, len(found)))
                at.append(k)
        words = list(known)
        bucket = np.fromiter((zlib.crc32(w.encode()) % buckets for w in words), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        n = batch.num_rows
        keys, freq = (np.unique(np.concatenate([rank[r] * n + k for r, k in zip(rows, at, strict=True)]), return_counts=True) if rows else (np.zeros(0, np.int64),) * 2)
        word, doc = keys // n, keys % n
        held = np.bincount(word, minlength=len(words))  # postings of each word, in order of rank
        ends = np.concatenate([[0], np.cumsum(held)])
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        blocks, numbers, names, lengths, counts, docs, freqs = [], [], [], [], [], [], []
        for b in range(buckets):
            lo, hi = bounds[b], bounds[b + 1]
            if lo < hi:
                blocks.append(block)
                numbers.append(b)
                chosen = [words[i] for i in order[lo:hi]]
                names.append("".join(chosen))
                lengths.append(_ints(np.fromiter(map(len, chosen), np.int64, len(chosen))))
                counts.append(_ints(held[lo:hi]))
                docs.append(_ints(doc[ends[lo] : ends[hi]]))
                freqs.append(_ints(freq[ends[lo] : ends[hi]]))
        m = len(blocks)
        none = pa.nulls(1, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block] * (m + 1), pa.int64()),
                pa.array([*numbers, block % buckets], pa.int32()),
                pa.concat_arrays([pa.array(names, pa.string()), pa.nulls(1, pa.string())]),
                *(pa.concat_arrays([pa.array(x, pa.binary()), none]) for x in (lengths, counts, docs, freqs)),
                pa.array([None] * m + [batch.column(0).to_pylist()], pa.list_(id_type)),
                pa.array([None] * m + [batch.column(1).to_pylist()], pa.list_(pa.int64())),
            ],
            names=["block", "bucket", "words", "lengths", "held", "docs", "freqs", "ids", "n_bytes"],
        )


def _partial_sums(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    ids = pretokens.load(path).ids
    known: dict[str, int] = {}
    for batch in batches:
        docs, sums = [], []
        for row in batch.select(["words", "lengths", "held", "docs", "freqs"]).to_pylist():
            if row["words"] is None:
                docs.append(None)
                sums.append(None)
                continue
            ends = np.cumsum(_array(row["lengths"])).tolist()
            words = [row["words"][a:b] for a, b in zip([0, *ends], ends)]  # noqa: B905
            if len(known) > KEEP_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = len(ids(w))
            pieces = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            doc = _array(row["docs"])
            total = np.bincount(doc, weights=np.repeat(pieces, _array(row["held"])) * _array(row["freqs"])).astype(np.int64)
            some = np.flatnonzero(total)
            docs.append(_ints(some))
            sums.append(_ints(total[some]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("block"), pa.array(docs, pa.binary()), pa.array(sums, pa.binary()), batch.column("ids"), batch.column("n_bytes")],
            names=["block", "docs", "sums", "ids", "n_bytes"],
        )


def _block_total(rows: pa.Table, id_column: str) -> pa.Table:
    here = rows.column("ids").is_valid().to_pylist().index(True)
    one = rows.slice(here, 1)
    ids, size = one.column("ids").combine_chunks().flatten(), one.column("n_bytes").combine_chunks().flatten()
    total = np.zeros(len(size), np.int64)
    for docs, sums in zip(rows.column("docs").to_pylist(), rows.column("sums").to_pylist(), strict=True):
        if docs is not None:
            total[_array(docs)] += _array(sums)
    return pa.Table.from_arrays([ids, size, pa.array(total, pa.int64())], names=[id_column, "n_bytes", "n_tokens"])


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    buckets: int | None = None,
) -> DataFrame:
    """``id_column``, ``n_bytes`` and ``n_tokens`` of every row; ``buckets``: parts that pre-tokens are dealt into."""
    spark = docs.sparkSession
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_column].dataType.simpleString()
    text = F.coalesce(docs[text_column].cast("string"), F.lit(""))
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema[id_column].dataType)
    tables = docs.select(docs[id_column].alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")).mapInArrow(
        lambda b: _block_tables(b, tokenizer_path, buckets, id_type),
        f"block long, bucket int, words string, lengths binary, held binary, docs binary, freqs binary, ids array<{kind}>, n_bytes array<long>",
    )
    sums = tables.repartition("bucket").mapInArrow(
        lambda b: _partial_sums(b, tokenizer_path), f"block long, docs binary, sums binary, ids array<{kind}>, n_bytes array<long>"
    )
    return sums.groupBy("block").applyInArrow(lambda t: _block_total(t, id_column), f"`{id_column}` {kind}, n_bytes long, n_tokens long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(common.table(spark, sf_dir, "documents"), default_tokenizer())
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)
