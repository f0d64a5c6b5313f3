"""What a running view reports: its state, counters, and the position that the log may forget up to.

A position is reported only after the batch that holds it is committed, every ``every`` seconds or when it is
asked for, and once more when the query ends. Counters are of this process and start at zero with it.
"""

from __future__ import annotations

import logging
import threading
import time
from collections import Counter
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)


class Status:
    """Counters by name and labels, and the state; safe to use from several threads."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._counts: Counter[tuple[str, tuple[tuple[str, str], ...]]] = Counter()
        self._gauges: dict[str, float] = {}
        self.state = "starting-up"

    def count(self, name: str, n: int, **labels: str) -> None:
        with self._lock:
            self._counts[name, tuple(sorted(labels.items()))] += n

    def gauge(self, name: str, value: float) -> None:
        with self._lock:
            self._gauges[name] = value

    def rows(self) -> list[tuple[str, dict[str, str], float]]:
        with self._lock:
            counts = [(name, dict(labels), float(n)) for (name, labels), n in self._counts.items()]
            return sorted([*counts, *((name, {}, float(v)) for name, v in self._gauges.items())], key=lambda r: (r[0], sorted(r[1].items())))

    def text(self) -> str:
        """In the text format that metric collectors read."""
        quote = lambda v: v.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")
        out, told = [], set()
        for name, labels, value in self.rows():
            if name not in told:
                told.add(name)
                out.append(f"# TYPE {name} {'gauge' if name in self._gauges else 'counter'}")
            inside = ",".join(f'{k}="{quote(v)}"' for k, v in labels.items())
            out.append(f"{name}{{{inside}}} {value:.0f}" if inside else f"{name} {value:.0f}")
        return "\n".join(out) + "\n"


class Reporter(StreamingQueryListener):
    """Reports the committed position of one query to the log's owner.

    ``position`` gives a batch's position. It is asked for batches that are committed, since the next one notes
    its position while it runs.
    """

    def __init__(self, position: Callable[[int], int | None], report: Callable[[int], None], status: Status | None = None, every: float = 10.0, clock: Callable[[], float] = time.monotonic) -> None:
        self.position, self.report, self.status, self.every, self.clock = position, report, status or Status(), every, clock
        self.query_id: str | None = None  # of the query to follow; None follows all
        self._committed: int | None = None
        self._reported: tuple[float, int | None] = (float("-inf"), None)

    def _mine(self, id_: object) -> bool:
        return self.query_id is None or str(id_) == self.query_id

    def request(self) -> None:
        """Report now, whatever the interval."""
        if self._committed is not None:
            self.report(self._committed)
            self._reported = self.clock(), self._committed

    def committed(self, position: int | None) -> None:
        """A batch with this position is committed."""
        if position is not None:
            self._committed = max(position, self._committed if self._committed is not None else position)
            self.status.gauge("committed_position", self._committed)
        if self.clock() - self._reported[0] >= self.every:
            self.request()

    def onQueryStarted(self, event: object) -> None:
        if self._mine(event.id):
            self.status.state = "streaming"

    def onQueryProgress(self, event: object) -> None:
        if self._mine(event.progress.id):
            self.committed(self.position(event.progress.batchId))

    def onQueryIdle(self, event: object) -> None:
        if self._mine(event.id):
            self.committed(None)

    def onQueryTerminated(self, event: object) -> None:
        if self._mine(event.id):
            self.status.state = "failed" if event.exception else "stopped"
            if self._committed != self._reported[1]:
                self.request()


def serve(status: Status, host: str = "127.0.0.1", port: int = 0) -> ThreadingHTTPServer:
    """``/state`` and ``/metrics`` over HTTP, in a thread of its own; ``/api/`` is not implemented. Shut it down at the end."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            path = self.path.split("?")[0]
            if path == "/state":
                code, body = 200, status.state
            elif path == "/metrics":
                code, body = 200, status.text()
            elif path.startswith("/api/"):
                code, body = 501, "not implemented\n"
            else:
                code, body = 404, "not found\n"
            sent = body.encode()
            self.send_response(code)
            self.send_header("Content-Type", "text/plain; charset=utf-8")
            self.send_header("Content-Length", str(len(sent)))
            self.end_headers()
            self.wfile.write(sent)

        def log_message(self, form: str, *args: object) -> None:
            log.debug(form, *args)

    server = ThreadingHTTPServer((host, port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
