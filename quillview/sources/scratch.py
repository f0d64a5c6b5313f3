"""A folder for files that a plan writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: str | None = None


def folder(spark: SparkSession, label: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names, which all executors share; where that
    is unset, in one JVM, in a temporary folder of this process."""
    global _own
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _own = _own or "file://" + tempfile.mkdtemp(prefix="quillview-core-")
        named = _own
    return f"{named.rstrip('/')}/quillview/{label}-{uuid.uuid4().hex}"
