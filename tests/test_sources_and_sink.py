from __future__ import annotations

import json
import struct
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from quillview import engine
from quillview.operators import bulk, oplog
from quillview.plans import catalogs, demo
from quillview.sources import binary_copy, changelog, synthetic, tables
from quillview.streaming import sink
from tests.conftest import SF


def test_binary_copy_round_trip(spark, tmp_path):
    rows = [[struct.pack(">q", 1), "é".encode(), b"\x01"], [None, None, None], [struct.pack(">q", -5), b"", b"\x00"]]
    (tmp_path / "a.bin").write_bytes(binary_copy.write(rows))
    (tmp_path / "b.bin").write_bytes(binary_copy.write([]))
    df = binary_copy.read(spark, str(tmp_path), {"id": "bigint", "name": "string", "ok": "boolean"})
    assert sorted(map(tuple, df.collect()), key=str) == sorted([(1, "é", True), (None, None, None), (-5, "", False)], key=str)


@pytest.mark.parametrize("cut", [3, 11, 20, 25, -1])
def test_binary_copy_rejects_torn_files(cut):
    whole = binary_copy.write([[b"abc", None]])
    with pytest.raises(binary_copy.CopyFormatError):
        list(binary_copy.rows(whole[:cut]))


def test_copy_statement_quotes():
    spec = demo.config().table("customer")
    assert tables.copy_statement(spec).startswith('COPY "public"."customer" ("c_custkey", "c_name"')


def test_csv_without_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text('ID1,"a ""b""",\nID2,"two\nlines",3\n')
    assert [tuple(r) for r in tables.csv(spark, str(tmp_path), "id string, t string, n int").orderBy("id").collect()] == [("ID1", 'a "b"', None), ("ID2", "two\nlines", 3)]


def test_synthetic_counts(spark):
    p = synthetic.parents(spark, 50)
    children = synthetic.children(p).groupBy("parent_id").count().collect()
    assert len(children) == 50 and all(5 <= r["count"] <= 25 for r in children)
    assert synthetic.inline_rows(p).groupBy("parent_id").count().filter("count > 3").count() == 0


def test_messages_become_changes(spark):
    cell = lambda k, v=None: (k, v)
    rows = [
        (1, 1, "B", None, None, None, None, None, None),
        (2, 1, "R", 7, "public", "t", ["id", "a"], None, None),
        (3, 1, "I", 7, None, None, None, None, [cell("t", "1"), cell("n")]),
        (4, 1, "R", 7, "public", "t", ["id", "a", "b"], None, None),
        (5, 1, "U", 7, None, None, None, [cell("t", "1"), cell("u"), cell("u")], [cell("t", "2"), cell("u"), cell("t", '"x"')]),
        (6, 1, "T", 7, None, None, None, None, None),
        (7, 1, "C", None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, changelog.MESSAGE)
    got = {r.seq: (r.kind, r.table, r.old, r.new) for r in changelog.decode(df).collect()}
    assert got == {3: ("I", "t", None, {"id": "1", "a": "null"}), 5: ("U", "t", {"id": "1"}, {"id": "2", "b": '"x"'}), 6: ("T", "t", None, None)}
    assert changelog.heartbeat(df).first().position == 7
    assert [(r.kind, r["count"]) for r in oplog.unsupported(changelog.decode(df)).collect()] == [("T", 1)]


def test_changes_without_keys_are_reported(spark):
    rows = [(1, 0, "U", "public", "orders", None, {"o_orderstatus": '"X"'}), (2, 0, "U", "public", "orders", None, {"o_orderkey": "4"})]
    assert [r.seq for r in oplog.bad_changes(demo.config(), spark.createDataFrame(rows, oplog.CHANGE)).collect()] == [1]


def test_batches_keep_order_and_bounds(spark):
    ops = oplog.snapshot_ops(demo.config(), demo.config().table("customer"), spark.read.parquet(f"{SF}/customer.parquet"))
    rows = bulk.greedy_batches(bulk.render(ops), ["id"], capacity=600, partitions=3)
    sizes = rows.groupBy("part", "batch").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r.s <= 600 or r.n == 1 for r in sizes) and sum(r.n for r in sizes) == 150


def test_clamps_and_addresses():
    assert sink.SinkOptions.clamped(0, 0.2, 0, 0).bulk_size == 4 << 20 and sink.SinkOptions.clamped(200).bulk_size == 4 << 20
    c = sink.Client.connect("user:secret@store:9200/")
    assert (c.url, c.user, c.password) == ("https://store:9200", "user", "secret") and "Authorization" in c.headers()
    assert sink.Client.connect("http://x").url == "http://x"


def test_answers():
    missing = json.dumps({"errors": True, "items": [{"update": {"error": {"type": sink.HARMLESS}}}]})
    sink.check(missing)
    sink.check("{}")
    with pytest.raises(sink.BulkError):
        sink.check(json.dumps({"errors": True, "items": [{"index": {"error": {"type": "mapper_parsing_exception"}}}]}))


def test_sending_over_http(spark):
    got: list[str] = []

    class Store(BaseHTTPRequestHandler):
        def do_POST(self):
            got.append(self.rfile.read(int(self.headers["Content-Length"])).decode())
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b"{}")

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Store)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    ops = oplog.snapshot_ops(demo.config(), demo.config().table("customer"), spark.read.parquet(f"{SF}/customer.parquet"))
    sink.send_ops(ops, sink.Client.connect(f"http://127.0.0.1:{server.server_port}"), sink.SinkOptions(bulk_size=2000))
    server.shutdown()
    lines = [line for body in got for line in body.splitlines()]
    assert len(lines) == 300 and all(len(b.encode()) <= 2001 for b in got) and all(b.endswith("\n") for b in got)
    assert {json.loads(x)["index"]["_id"] for x in lines[::2]} == {str(k) for k in range(150)} or len(lines[::2]) == 150


def test_engine_discovers_and_rebuilds(spark, tmp_path):
    options = engine.Options.read({"database": "db", "publication": "pub", "path": str(tmp_path / "v")})
    config = engine.discover(catalogs.literal(spark), options)
    keyed = config.table("keyed")
    assert keyed.doc_type == "k" and not keyed.prefix_id and not config.table("full").indexed
    rows = spark.createDataFrame([(1, 2, "x")], "id long, part long, value string")
    engine.run(spark, config, options, "snapshot", {"keyed": rows})
    from quillview.streaming.maintain import MaintainedView

    assert [r.id for r in MaintainedView(spark, config, options.path).view().collect()] == ["1"]
    with pytest.raises(ValueError):
        engine.Options.read({})


def test_status_is_served_and_positions_are_reported():
    import urllib.error
    import urllib.request

    from quillview.streaming import status

    found, now, reported = status.Status(), [0.0], []
    reporter = status.Reporter(lambda batch: {0: 5, 1: None, 2: 9}[batch], reported.append, found, every=10, clock=lambda: now[0])

    class Event:
        id, exception = "q", None
        progress = type("P", (), {"id": "q", "batchId": 0})

    reporter.query_id = "other"
    reporter.onQueryProgress(Event)
    assert not reported and found.state == "starting-up"
    reporter.query_id = "q"
    reporter.onQueryStarted(Event)
    for at, batch in [(1, 0), (5, 1), (6, 2)]:
        now[0], Event.progress.batchId = at, batch
        reporter.onQueryProgress(Event)
    assert reported == [5] and found.state == "streaming"
    now[0] = 11
    reporter.onQueryIdle(Event)
    assert reported == [5, 9]
    reporter.request()
    reporter.onQueryTerminated(Event)
    assert reported == [5, 9, 9] and found.state == "stopped"
    found.count("streaming_messages", 3, table='o"d', operation="insert")
    server = status.serve(found)
    get = lambda path: urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}{path}").read().decode()
    assert get("/state") == "stopped"
    assert 'streaming_messages{operation="insert",table="o\\"d"} 3' in get("/metrics") and "committed_position 9" in get("/metrics")
    for path, code in (("/api/x", 501), ("/y", 404)):
        with pytest.raises(urllib.error.HTTPError) as e:
            get(path)
        assert e.value.code == code
    server.shutdown()


def test_engine_reports_what_is_committed(spark, tmp_path):
    import time

    from quillview.plans import demo
    from quillview.streaming.status import Status

    demo.order_changes(spark, SF, "I").filter("seq <= 50").coalesce(1).write.parquet(str(tmp_path / "log"))
    found, reported = Status(), []
    options = engine.Options("shop", "pub", str(tmp_path / "v"))
    engine.run(spark, demo.config(), options, "stream", changes=changelog.stream(spark, str(tmp_path / "log")), status=found, report=reported.append).awaitTermination()
    until = time.time() + 60
    while found.state != "stopped" and time.time() < until:
        time.sleep(0.2)
    assert reported[-1:] == [50] and found.state == "stopped"
    assert ("streaming_messages", {"table": "orders", "operation": "insert"}, 50.0) in found.rows()


def test_mappings_are_checked():
    from quillview.plans import reads

    found = reads.index_mapping('{"mappings": {"properties": {"a": {"type": "nested", "properties": {"b": {"type": "long", "index": false}}}, "j": {"type": "join", "relations": {"p": ["c", "d"]}}}}}')
    assert not found["a"].members["b"].searched and found["j"].relations == {"p": ["c", "d"]}
    with pytest.raises(ValueError, match="geo"):
        reads.index_mapping('{"mappings": {"properties": {"a": {"type": "geo"}}}}')
