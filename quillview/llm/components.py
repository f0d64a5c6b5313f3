"""Connected components of a link table, by rounds that contract it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _roots(hooks: DataFrame) -> DataFrame:
    """``node`` and the end of its chain of hooks, by doubling: a chain of n hooks takes log2(n) joins."""
    while True:
        up = hooks.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = common.materialize(hooks.join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")), "labels")
        common.release(hooks)
        hooks = jumped
        if hooks.filter("moved").limit(1).count() == 0:
            return hooks


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of ``links`` (a, b).

    Each round hooks every node to the smallest of itself and its neighbours, follows the hooks to their
    ends, and replaces links by the links between these ends. An end is smaller than all its
    neighbours and has one at least, which hooks elsewhere: in each round a component loses half of its
    nodes or more, so there are at most log2 of its size rounds of at most log2 of its size joins. Nothing
    limits the rounds. Partial aggregation keeps a hub's links from meeting in one task; joins are on
    node, which adaptive execution splits. Rounds are written to the shared folder, and deleted once
    the next one stands; only whether links are left reaches the driver.
    """
    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    edges = common.materialize(links.filter("a <> b").select(*pair("a", "b")).distinct(), "links")
    total = None
    while True:
        both = edges.union(edges.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
        labels = _roots(common.materialize(hooks, "labels"))
        if total is None:
            total, old = labels, []
        else:
            up = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
            old = [total, labels]
            total = common.materialize(total.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "labels")
        left, right = labels.select(F.col("node").alias("a"), F.col("root").alias("x")), labels.select(F.col("node").alias("b"), F.col("root").alias("y"))
        rest = common.materialize(edges.join(left, "a").join(right, "b").filter("x <> y").select(*pair("x", "y")).distinct(), "links")
        common.release(edges, *old)
        edges = rest
        if edges.limit(1).count() == 0:
            common.release(edges)
            return total.select("node", "root")
