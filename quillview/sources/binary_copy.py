"""Files of PostgreSQL's binary COPY format.

Fixed values of the format: an 11-byte signature, a flags word and an extension length, then rows of a
16-bit field count (-1 ends the file) and cells of a 32-bit length (-1 for null) with their bytes, all
big-endian.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SIGNATURE = b"PGCOPY\n\xff\r\n\x00"
#: Bit 16 of the flags: rows carry object ids. Such files are not read.
HAS_OIDS = 1 << 16
EPOCH = datetime(2000, 1, 1, tzinfo=UTC)


class CopyFormatError(ValueError):
    """A file is not in the format or ends too early."""


def _take(data: memoryview, at: int, n: int) -> tuple[bytes, int]:
    if at + n > len(data):
        raise CopyFormatError(f"file ends at {len(data)}, {n} bytes are due at {at}")
    return bytes(data[at : at + n]), at + n


def rows(content: bytes) -> Iterator[list[bytes | None]]:
    """Cells of each row; a file must have its end mark."""
    data = memoryview(content)
    signature, at = _take(data, 0, len(SIGNATURE))
    if signature != SIGNATURE:
        raise CopyFormatError("signature differs")
    raw, at = _take(data, at, 8)
    flags, extension = struct.unpack(">II", raw)
    if flags & HAS_OIDS:
        raise CopyFormatError("rows with object ids are not supported")
    _, at = _take(data, at, extension)
    while True:
        raw, at = _take(data, at, 2)
        (count,) = struct.unpack(">h", raw)
        if count == -1:
            return
        row: list[bytes | None] = []
        for _ in range(count):
            raw, at = _take(data, at, 4)
            (length,) = struct.unpack(">i", raw)
            if length < -1:
                raise CopyFormatError(f"cell length {length} at {at}")
            if length == -1:
                row.append(None)
            else:
                cell, at = _take(data, at, length)
                row.append(cell)
        yield row


def write(out_rows: list[list[bytes | None]]) -> bytes:
    parts = [SIGNATURE, struct.pack(">II", 0, 0)]
    for row in out_rows:
        parts.append(struct.pack(">h", len(row)))
        for cell in row:
            parts += [struct.pack(">i", -1)] if cell is None else [struct.pack(">i", len(cell)), cell]
    return b"".join([*parts, struct.pack(">h", -1)])


#: Spark type to the decoder of a cell's bytes.
DECODERS = {
    "boolean": lambda b: b != b"\x00",
    "smallint": lambda b: struct.unpack(">h", b)[0],
    "int": lambda b: struct.unpack(">i", b)[0],
    "bigint": lambda b: struct.unpack(">q", b)[0],
    "float": lambda b: struct.unpack(">f", b)[0],
    "double": lambda b: struct.unpack(">d", b)[0],
    "string": lambda b: b.decode(),
    "binary": lambda b: b,
    "date": lambda b: (EPOCH + timedelta(days=struct.unpack(">i", b)[0])).date(),
    "timestamp": lambda b: EPOCH + timedelta(microseconds=struct.unpack(">q", b)[0]),
}


def read(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Rows of the files under ``path``; ``columns``: name to Spark type, in file order.

    A file is one task's work and held in memory whole, as Spark's binary reader gives it: export in
    parts of bounded size.
    """
    return parse(spark.read.format("binaryFile").load(path), columns)


def parse(files: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows of whole files in a column ``content``."""
    decoders = [DECODERS[kind] for kind in columns.values()]
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    ddl = ", ".join(f"`{n}` {k}" for n, k in columns.items())
    schema = to_arrow_schema(_parse_datatype_string(ddl))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                found: list[list] = []
                for row in rows(content):
                    if len(row) != len(decoders):
                        raise CopyFormatError(f"{len(row)} cells, {len(decoders)} columns")
                    found.append([None if c is None else d(c) for c, d in zip(row, decoders, strict=True)])
                    if len(found) == 10_000:
                        yield _batch(found, schema)
                        found = []
                if found:
                    yield _batch(found, schema)

    return files.select("content").mapInArrow(each, ddl)


def _batch(found: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)
