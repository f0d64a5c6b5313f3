"""Entry points: rebuild from snapshots, follow changes, or both.

Options come from a dictionary or the environment:
``QUILLVIEW_DATABASE``, ``QUILLVIEW_PUBLICATION``, ``QUILLVIEW_PATH``, ``QUILLVIEW_NULL_MODE``.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillview.config import Config, build_config
from quillview.operators.oplog import snapshot_all
from quillview.operators.scripts import STANDARD, Script
from quillview.plans import catalog
from quillview.streaming.maintain import MaintainedView
from quillview.streaming.status import Reporter, Status

MODES = ("snapshot", "stream", "snapshot+stream")


@dataclass(frozen=True)
class Options:
    database: str
    publication: str
    path: str
    null_mode: str = "omit"

    @classmethod
    def read(cls, given: Mapping[str, str] | None = None) -> Options:
        found = {k: (given or {}).get(k) or os.environ.get(f"QUILLVIEW_{k.upper()}") for k in ("database", "publication", "path", "null_mode")}
        missing = [k for k in ("database", "publication", "path") if not found[k]]
        if missing:
            raise ValueError(f"options missing: {', '.join(missing)}")
        return cls(**{k: v for k, v in found.items() if v})


def discover(c: catalog.Catalog, options: Options) -> Config:
    """The mapping that the comments in a catalog declare; a catalog has a row per column of a table."""
    return build_config(options.database, [r.asDict() for r in catalog.discover(c, options.publication).collect()])


def run(
    spark: SparkSession,
    config: Config,
    options: Options,
    mode: str,
    tables: dict[str, DataFrame] | None = None,
    changes: DataFrame | None = None,
    snapshot_position: int | None = None,
    messages: bool = False,
    scripts: Mapping[str, Script] = STANDARD,
    status: Status | None = None,
    report: Callable[[int], None] | None = None,
) -> StreamingQuery | None:
    """Rebuild, follow, or both.

    ``snapshot_position``: where in the log the snapshot was taken; records up to there are in it and are
    left out. ``messages``: ``changes`` are wire messages. ``scripts``: effects of the scripts that comments may name.
    ``status`` is kept up to date; ``report`` is called with positions that are committed (``status.Reporter``). Records without a key are quarantined in the view.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    view = MaintainedView(spark, config, options.path, options.null_mode, scripts=scripts, status=status)
    if mode != "stream":
        view.load_snapshot(snapshot_all(config, tables or {}), snapshot_position)
    if mode != "snapshot" and changes is not None:
        if snapshot_position is not None:
            at = "lsn" if messages else "seq"
            # Relation messages name the tuples of later ones, so they all pass.
            changes = changes.filter((F.col(at) > snapshot_position) | (F.col("message") == "R" if messages else F.lit(False)))
        reporter = Reporter(view.position_of, report or (lambda _: None), status) if status or report else None
        if reporter:
            spark.streams.addListener(reporter)
        query = view.start(changes, f"{options.path}/checkpoint", messages)
        if reporter:
            reporter.query_id = str(query.id)
        return query
    return None
