"""The fold as a stateful streaming operator: one state per document, operations applied in order.

Within a micro-batch a document's operations are sorted by ``(seq, op_ord, pk)``; across batches they must
arrive in log order. Each touched document is emitted in its new version.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillview.operators.scripts import ARRAYS, Script

OUTPUT = (
    "`index` string, route string, id string, fields map<string,string>, inlines map<string,array<string>>, "
    "maps map<string,map<string,string>>, gone boolean"
)
STATE = "document string"

Document = dict  # {"fields": {name: fragment}, "array" and "map", by the scripts' shape: {name: {pk: object}}}


def apply(document: Document | None, ops: Iterable[dict], scripts: Mapping[str, Script] = ARRAYS) -> Document | None:
    """A document after operations, one at a time; None if there is none."""
    for op in ops:
        kind = op["op"]
        if kind in ("index", "insert"):
            document = {"fields": dict(op["fields"]), "array": {}, "map": {}}
        elif kind == "delete":
            document = None
        elif kind == "update":
            if document:
                document["fields"].update(op["fields"])
        elif kind not in scripts:
            raise ValueError(f"no script is declared for the operation {kind}")
        elif scripts[kind].adds:
            script = scripts[kind]
            if document is None:
                document = {"fields": dict(op["stub"] or {}), "array": {}, "map": {}}
            items = document[script.shape].setdefault(op["inline"], {})
            if script.value == "first":
                obj = items.get(op["pk"], op["obj"])
            else:
                obj = op["obj"]
            if script.place == "last":
                items.pop(op["pk"], None)
            items[op["pk"]] = obj  # a key that is there keeps its place
        elif document:
            for shape in ("array", "map"):
                document[shape].get(op["inline"], {}).pop(op["pk"], None)
    return document


def stateful_fold(ops: DataFrame, scripts: Mapping[str, Script] = ARRAYS) -> DataFrame:
    """Versions of documents from a stream of operations (output mode ``update``)."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = [r for f in frames for r in json.loads("[" + ",".join(f["op_json"]) + "]")]
        rows.sort(key=lambda r: (r["seq"], r["op_ord"], r.get("pk") or ""))
        for r in rows:
            for k in ("fields", "stub"):
                r[k] = r.get(k) or {}
            r["pk"], r["inline"], r["obj"] = r.get("pk"), r.get("inline"), r.get("obj")
        document = apply(json.loads(state.get[0]) if state.exists else None, rows, scripts)
        state.update((json.dumps(document),))
        found = document or {"fields": None, "array": {}, "map": {}}
        arrays = {k: list(v.values()) for k, v in found["array"].items()}
        yield pd.DataFrame(
            {"index": [key[0]], "route": [key[1]], "id": [key[2]], "fields": [found["fields"]], "inlines": [arrays or None], "maps": [found["map"] or None], "gone": [document is None]}
        )

    packed = ops.select(
        "index", F.coalesce("routing", "id").alias("route"), "id",
        F.to_json(F.struct("seq", "op_ord", "op", "fields", "inline", "pk", "obj", "stub")).alias("op_json"),
    )
    return packed.groupBy("index", "route", "id").applyInPandasWithState(step, OUTPUT, STATE, "update", GroupStateTimeout.NoTimeout)
