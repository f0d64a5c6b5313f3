"""The set-based fold against one operation at a time, in batch, in streams and on replays."""

from __future__ import annotations

import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quillview import config
from quillview.operators import fold, oplog, scripts
from quillview.plans import demo
from quillview.streaming import stateful
from quillview.streaming.maintain import MaintainedView
from tests.conftest import SF


def random_ops(n_docs: int, seed: int, adds: dict[str, str] | None = None) -> list[dict]:
    rnd = random.Random(seed)
    out = []
    for d in range(n_docs):
        seq = 0
        for _ in range(rnd.randint(1, 14)):
            seq += rnd.randint(0, 2)
            used = {o["op_ord"] for o in out if o["id"] == str(d) and o["seq"] == seq}
            free = [k for k in range(4) if k > max(used, default=-1)]
            if not free:
                seq += 1
                free = [0]
            op = rnd.choice(["index", "insert", "delete", "update", "update", "inline_add", "inline_add", "inline_add", "inline_del"])
            row = {"seq": seq, "op_ord": free[0], "index": "i", "id": str(d), "routing": None, "op": op, "fields": None, "inline": None, "pk": None, "obj": None, "stub": None, "table": "t"}
            if op in ("index", "insert", "update"):
                row["fields"] = {k: rnd.choice(["null", str(rnd.randint(0, 9)), '"x"']) for k in rnd.sample("abc", rnd.randint(0, 3))}
            elif op != "delete":
                row["inline"], row["pk"] = rnd.choice(["p", "q"]), rnd.choice(["1", "2", "3"])
                if op == "inline_add":
                    row["op"] = (adds or {}).get(row["inline"], op)
                    row["obj"], row["stub"] = json.dumps({"v": rnd.randint(0, 99)}), {"docType": '"t"', "a": "0"}
            out.append(row)
    return out


def one_by_one(ops: list[dict], effects: dict | None = None) -> dict:
    by_doc = defaultdict(list)
    for o in ops:
        by_doc[o["id"]].append(o)
    out = {}
    for d, found in by_doc.items():
        found.sort(key=lambda o: (o["seq"], o["op_ord"]))
        doc = stateful.apply(None, [dict(o, fields=o["fields"] or {}) for o in found], effects or scripts.ARRAYS)
        if doc:
            out[d] = (doc["fields"], {k: list(v.values()) for k, v in doc["array"].items()} | doc["map"])
    return out


def collected(df) -> dict:
    maps = lambda r: (r.maps or {}) if "maps" in df.columns else {}
    return {r.id: (dict(r.fields or {}), {k: list(v) for k, v in (r.inlines or {}).items()} | maps(r)) for r in df.collect()}


def test_fold_equals_one_by_one(spark):
    ops = random_ops(600, 1)
    shuffled = random.Random(2).sample(ops, len(ops))
    assert collected(fold.fold(spark.createDataFrame(shuffled, oplog.OPLOG))) == one_by_one(ops)


EFFECTS = {**scripts.STANDARD, "first_stays": scripts.Script(value="first"), "to_the_end": scripts.Script(place="last"), "first_to_the_end": scripts.Script(value="first", place="last")}


@pytest.mark.parametrize("adds", [{"p": "inline_add_map"}, {"p": "first_stays", "q": "inline_add_map"}, {"p": "to_the_end", "q": "first_to_the_end"}])
def test_scripts_equal_one_by_one(spark, tmp_path, adds):
    ops = random_ops(400, 21, adds)
    df = spark.createDataFrame(ops, oplog.OPLOG)
    want = one_by_one(ops, EFFECTS)
    whole = fold.fold(df, EFFECTS, keep_items=True)
    assert collected(whole) == want
    assert collected(fold.fold(fold.ops_of_versions(whole), EFFECTS)) == want
    for r in whole.withColumn("body", fold.body(whole)).collect():
        assert all(json.loads(r.body)[k] == {p: json.loads(o) for p, o in v.items()} for k, v in (r.maps or {}).items())
    view = MaintainedView(spark, demo.config(), str(tmp_path), shuffle_id_buckets=2)
    view._effects = EFFECTS
    for n, (lo, hi) in enumerate([(-1, 4), (4, 99)]):
        view._apply(df.filter((F.col("seq") > lo) & (F.col("seq") <= hi)), n)
    assert collected(view.view()) == want


def test_scripts_must_be_declared(spark, tmp_path):
    comments = {"a": ('index:"doc" inline:"i,i,my_add,inline_del"', {"id": ""}, ("id",)), "b": ('index:"-"', {"id": 'inline:"i,pk"', "a": 'inline:"i,parent"'}, ("id", "a"))}
    made = config.build_config("db", demo.catalog_rows(comments))
    with pytest.raises(config.ConfigError, match="my_add"):
        MaintainedView(spark, made, str(tmp_path))
    with pytest.raises(config.ConfigError, match="additions"):
        MaintainedView(spark, made, str(tmp_path), scripts={**scripts.STANDARD, "my_add": scripts.Script(adds=False)})
    MaintainedView(spark, made, str(tmp_path), scripts={**scripts.STANDARD, "my_add": scripts.Script()})
    odd = random_ops(5, 1, {"p": "my_add", "q": "my_add"})
    with pytest.raises(Exception, match="my_add"):
        fold.fold(spark.createDataFrame(odd, oplog.OPLOG)).collect()


def test_fold_of_nothing(spark):
    assert fold.fold(oplog.empty(spark)).count() == 0


def test_body_is_json(spark):
    ops = random_ops(50, 3)
    docs = fold.fold(spark.createDataFrame(ops, oplog.OPLOG))
    for r in docs.withColumn("body", fold.body(docs)).collect():
        parsed = json.loads(r.body)
        for k, v in (r.inlines or {}).items():
            assert parsed[k] == [json.loads(x) for x in v]


def _changes(spark):
    first = demo.order_changes(spark, SF, "I").filter("seq <= 300")
    items = demo.item_changes(spark, SF, "I").filter("seq <= 300").withColumn("seq", F.col("seq") + 10_000)
    moved = demo.order_changes(spark, SF, "U", moved=True).filter("seq <= 200").withColumn("seq", F.col("seq") + 20_000)
    gone = demo.order_changes(spark, SF, "D").filter("seq BETWEEN 100 AND 150").withColumn("seq", F.col("seq") + 30_000)
    return first.unionByName(items).unionByName(moved).unionByName(gone)


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    changes = _changes(spark)
    whole = collected(fold.fold(oplog.change_ops(demo.config(), changes)))
    source = str(tmp_path / "log")
    for k, (lo, hi) in enumerate([(0, 10_100), (10_100, 20_050), (20_050, 40_000)]):
        changes.filter((F.col("seq") > lo) & (F.col("seq") <= hi)).coalesce(1).write.mode("append").parquet(source)
    from quillview.sources import changelog

    view = MaintainedView(spark, demo.config(), str(tmp_path / "view"))
    view.start(changelog.stream(spark, source, files_per_batch=1), str(tmp_path / "checkpoint")).awaitTermination()
    assert collected(view.view()) == whole
    assert view.position().first().position == changes.agg(F.max("seq")).first()[0]
    view.apply_changes(changes.filter("seq > 20050"), 2)  # the last batch once more
    assert collected(view.view()) == whole


def test_stateful_stream_equals_batch(spark, tmp_path):
    ops = random_ops(80, 5)
    df = spark.createDataFrame(ops, oplog.OPLOG)
    top = max(o["seq"] for o in ops)
    for lo, hi in [(-1, 4), (4, 9), (9, top)]:
        df.filter((F.col("seq") > lo) & (F.col("seq") <= hi)).coalesce(1).write.mode("append").parquet(str(tmp_path / "ops"))
    versions: dict = {}

    def keep(batch, _):
        for r in batch.collect():
            versions[r.id] = None if r.gone else (dict(r.fields), {k: list(v) for k, v in (r.inlines or {}).items()})

    stream = spark.readStream.schema(oplog.OPLOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "ops"))
    q = stateful.stateful_fold(stream).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {k: v for k, v in versions.items() if v is not None}
    want = one_by_one(ops)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert {k: {a: x for a, x in v[1].items() if x} for k, v in got.items()} == {k: {a: x for a, x in v[1].items() if x} for k, v in want.items()}


def test_versions_make_their_documents_again(spark):
    docs = fold.fold(spark.createDataFrame(random_ops(300, 7), oplog.OPLOG), keep_items=True)
    assert collected(fold.fold(fold.ops_of_versions(docs))) == collected(docs)


def test_state_stays_bounded_and_a_batch_may_run_again(spark, tmp_path):
    import os

    ops = random_ops(40, 11)
    for k, o in enumerate(ops):
        o["seq"] += 1
    view = MaintainedView(spark, demo.config(), str(tmp_path), shuffle_id_buckets=4, compact_every=3)
    top = max(o["seq"] for o in ops)
    steps = list(range(0, top + 1, max(1, top // 9)))
    sizes = []
    for n, lo in enumerate(steps):
        hi = steps[n + 1] if n + 1 < len(steps) else top + 1
        part = spark.createDataFrame([o for o in ops if lo < o["seq"] <= hi] or [], oplog.OPLOG)
        view._apply(part, n)
        if n in (2, 3, 5):
            view._apply(part, n)  # again, also after it has made a base of the batches before
        sizes.append(sum(len(f) for _, _, f in os.walk(tmp_path / "versions")))
    assert len(steps) >= 8 and max(sizes) < 80
    assert len([d for d in os.listdir(tmp_path / "versions") if d.startswith("base=")]) <= 1
    assert collected(view.view()) == one_by_one(ops)


def test_keyless_records_and_truncations_are_noted(spark, tmp_path):
    rows = [(1, 0, "I", "public", "orders", None, {"o_orderkey": "4"}), (2, 0, "I", "public", "orders", None, {"o_orderstatus": '"X"'}), (3, 0, "T", "public", "orders", None, None), (9, 0, "C", None, None, None, None)]
    view = MaintainedView(spark, demo.config(), str(tmp_path))
    view.apply_changes(spark.createDataFrame(rows, oplog.CHANGE), 0)
    assert [r.id for r in view.view().collect()] == ["orders_4"]
    assert [r.seq for r in view.quarantine().collect()] == [2] and [r.kind for r in view.unsupported().collect()] == ["T"]
    view.apply_changes(spark.createDataFrame([], oplog.CHANGE), 1)
    assert view.position().first().position == 9


def test_a_position_outlives_compaction_of_batches_without_one(spark, tmp_path):
    view = MaintainedView(spark, demo.config(), str(tmp_path), shuffle_id_buckets=2, compact_every=3)
    first = demo.order_changes(spark, SF, "I").filter("seq <= 5")
    for n in range(3):
        view.apply_changes(first if n == 0 else first.limit(0), n)
    assert view.position().first().position == 5 and view.view().count() == 5
