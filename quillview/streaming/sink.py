"""Sending operations to a document store in bounded requests.

Requests are newline-delimited JSON. A request is packed per partition: operations of one document
share a partition, so their order holds. Delivery is at least once: a failed batch runs again from
the checkpoint, and operations are idempotent by document and key.
"""

from __future__ import annotations

import base64
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit, urlunsplit

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from quillview.operators import bulk

#: Item errors that don't fail a request: an update on a document that is gone.
HARMLESS = "document_missing_exception"


class BulkError(RuntimeError):
    """Items of a request failed."""


@dataclass(frozen=True)
class SinkOptions:
    """Sizes in bytes, times in seconds.

    ``idle`` is the trigger's interval: what doesn't fill a request waits for so long, a batch that takes longer
    is followed at once by the next. ``throttle`` is the least time between the requests of a sender.
    A batch is fixed when it starts, so ``debounce`` (waiting for more after the first row) has nothing to act on.
    """

    bulk_size: int = 4 * bulk.MIB
    idle: float = 5.0
    throttle: float = 0.5
    debounce: float = 0.1
    #: Attempts at a request that the store could not take (no connection, 429, 5xx), each after twice the time.
    attempts: int = 4

    @classmethod
    def clamped(cls, bulk_mib: int = 4, idle: float = 30.0, throttle: float = 0.5, debounce: float = 0.5) -> SinkOptions:
        """Settings brought into the allowed ranges: 1 to 100 MiB, idle at least 1 s (else 5)."""
        size = bulk_mib if 1 <= bulk_mib <= 100 else 4
        return cls(size * bulk.MIB, idle if idle >= 1 else 5.0, throttle if throttle > 0 else 0.5, debounce if debounce > 0 else 0.1)

    def trigger(self) -> dict[str, str]:
        return {"processingTime": f"{max(self.idle, 0.001)} seconds"}


@dataclass(frozen=True)
class Client:
    url: str
    user: str | None = None
    password: str | None = None

    @classmethod
    def connect(cls, address: str, user: str | None = None, password: str | None = None) -> Client:
        """``https`` unless another scheme is named; credentials from the address or given apart."""
        parts = urlsplit(address if "://" in address else f"https://{address}")
        host = parts.hostname or ""
        if parts.port:
            host = f"{host}:{parts.port}"
        return cls(urlunsplit((parts.scheme, host, parts.path.rstrip("/"), "", "")), user or parts.username, password or parts.password)

    def headers(self) -> dict[str, str]:
        found = {"Content-Type": "application/x-ndjson"}
        if self.user:
            found["Authorization"] = "Basic " + base64.b64encode(f"{self.user}:{self.password or ''}".encode()).decode()
        return found

    def send(self, lines: list[str], timeout: float = 60.0) -> None:
        body = ("\n".join(lines) + "\n").encode()
        request = urllib.request.Request(f"{self.url}/_bulk?filter_path=errors,items.*.error", body, self.headers(), method="POST")
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            check(answer.read().decode())


def failures(answer: str) -> list[dict]:
    """Errors of single items, with their action."""
    parsed = json.loads(answer or "{}")
    return [{"action": action, **(item.get("error") or {})} for entry in parsed.get("items", []) for action, item in entry.items() if item.get("error")]


def check(answer: str) -> None:
    bad = [f for f in failures(answer) if f.get("type") != HARMLESS]
    if bad:
        raise BulkError(f"{len(bad)} items failed, the first: {bad[0]}")


def transient(error: Exception) -> bool:
    """Whether the same request can succeed later."""
    if isinstance(error, urllib.error.HTTPError):
        return error.code == 429 or error.code >= 500
    return isinstance(error, (urllib.error.URLError, TimeoutError, ConnectionError))


class Sender:
    """Sends requests one after the other: not more often than the throttle allows, again after transient errors."""

    def __init__(self, client: Client, options: SinkOptions, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.client, self.options, self.clock, self.sleep = client, options, clock, sleep
        self.last: float | None = None

    def send(self, lines: list[str]) -> None:
        for attempt in range(1, self.options.attempts + 1):
            least = self.options.throttle * 2 ** (attempt - 1)
            if self.last is not None and (wait := self.last + least - self.clock()) > 0:
                self.sleep(wait)
            self.last = self.clock()
            try:
                return self.client.send(lines)
            except Exception as error:
                if not transient(error) or attempt == self.options.attempts:
                    raise


def packed(rows: Iterable[Row], capacity: int) -> Iterator[list[str]]:
    held: list[str] = []
    used = 0
    for row in rows:
        size = len(row.ndjson.encode()) + 1
        if held and used + size > capacity:
            yield held
            held, used = [], 0
        held.append(row.ndjson)
        used += size
    if held:
        yield held


def send_ops(ops: DataFrame, client: Client, options: SinkOptions | None = None) -> None:
    """Send a batch of operations, each document's in order."""
    chosen = options or SinkOptions()
    rows = bulk.render(ops).repartition(F.col("id")).sortWithinPartitions("seq", "op_ord", "pk").select("ndjson")

    def push(part: Iterable[Row]) -> None:
        sender = Sender(client, chosen)
        for lines in packed(part, chosen.bulk_size):
            sender.send(lines)

    rows.foreachPartition(push)


def write_files(ops: DataFrame, path: str, mode: str = "append") -> None:
    """The same lines as text files."""
    rows = bulk.render(ops).repartition(F.col("id")).sortWithinPartitions("seq", "op_ord", "pk")
    rows.select(F.col("ndjson").alias("value")).write.mode(mode).text(path)


def stream_to(ops: DataFrame, client: Client, checkpoint: str, options: SinkOptions | None = None) -> DataStreamWriter:
    """A stream of operations to a store; start the returned writer."""
    chosen = options or SinkOptions()
    return ops.writeStream.foreachBatch(lambda df, _: send_ops(df, client, chosen)).option("checkpointLocation", checkpoint).trigger(**chosen.trigger())
