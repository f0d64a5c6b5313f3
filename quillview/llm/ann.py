"""Approximate nearest neighbours by largest inner product: a forest of random-projection trees.

The table is dealt into shards of about ``shard_rows`` by the first levels of one tree, fitted on a
bounded sample of ``SAMPLE_VALUES`` components at most; every row is indexed. A leaf of it with more rows, as
many near-equal vectors make one, is split further by hash, so a shard is one task's work whatever the
table holds. A query visits the shards of its nearest leaves. In a shard, ``trees`` trees are built over
all of its vectors: a node splits its points at the median of their projections on the difference of
two cluster centres. All trees are searched through one priority queue, ordered by the smallest margin
on the way to a node, until enough vectors have been met in leaves; these candidates are reranked
exactly. Shards' results are merged by a window over at most ``k`` rows per query and shard.

How many leaves a query visits, and how many vectors of a shard are met, is calibrated, by the same
rule at every size, to ``target`` recall: up to ``CALIBRATION`` vectors, of the sample for the first and of the
shard for the second, are taken for queries, their exact neighbours in the sample or shard are computed
and the places noted at which the search meets them. Vectors without any structure, uniform on a sphere in 64
dimensions, are the hardest case and need more than half of the points; clustered ones need few.
``examined`` says how many vectors were met for a query in all its shards.

Inner products become distances by one more coordinate, ``sqrt(longest^2 - length^2)``, 0 for queries.
Equal vectors of a shard are one point of the index, with the ``k + 1`` smallest ids: no more can ever
be among a query's ``k``.

Defined results: a vector that is null, empty, all zero, holds null, NaN or infinite components, or
differs in length from most vectors, takes no part; nor does a row with a null id. Rows with a
query's own id are not its candidates. Ties go to the smaller id. With fewer than ``k`` candidates all
that were met are returned, all there are in a table of one shard. Of rows alike in id and vector one
counts. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Queries of a shard that one task answers; building the shard's forest takes a hundredth of that time.
QUERY_BLOCK = 16384
#: Components of the sample that the shards' tree is fitted on, and leaves that it has at the most.
SAMPLE_VALUES, MOST_LEAVES = 1 << 20, 1024
#: Vectors that a number of leaves, and of vectors in a shard, is calibrated on.
CALIBRATION = 48


class Tree:
    """Nodes as arrays; a negative child names a leaf."""

    def __init__(self, x: np.ndarray, leaf: int, rng: np.random.Generator) -> None:
        self.normals: list[np.ndarray] = []
        self.cuts: list[float] = []
        self.children: list[list[int]] = []
        self.leaves: list[np.ndarray] = []
        self.root = -1
        todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(x)), -1, 0)]
        while todo:
            points, parent, side = todo.pop()
            cut = self.split(x, points, rng) if len(points) > leaf else None
            if cut is None:
                self.leaves.append(points)
                at = -len(self.leaves)
            else:
                at = len(self.normals)
                self.normals.append(cut[0])
                self.cuts.append(cut[1])
                self.children.append([0, 0])
                todo += [(points[~cut[2]], at, 0), (points[cut[2]], at, 1)]
            if parent >= 0:
                self.children[parent][side] = at
            else:
                self.root = at
        self.plane = np.array(self.normals).reshape(-1, x.shape[1])
        self.cut = np.array(self.cuts)

    @staticmethod
    def split(x: np.ndarray, points: np.ndarray, rng: np.random.Generator):
        for _ in range(4):
            some = x[rng.choice(points, min(len(points), 256), replace=False)]
            p, q = some[0], some[1]
            for _ in range(3):
                near = some @ (p - q) > (p @ p - q @ q) / 2
                if near.all() or not near.any():
                    break
                p, q = some[near].mean(0), some[~near].mean(0)
            length = np.linalg.norm(p - q)
            if not length:
                continue
            normal = (p - q) / length
            along = x[points] @ normal
            cut = float(np.median(along))
            upper = along > cut
            if upper.any():
                return normal, cut, upper
        return None


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the coordinate that makes the largest inner product the least distance."""
    return np.hstack([x, np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", x, x), 0.0))[:, None]])


class Forest:
    def __init__(self, x: np.ndarray, trees: int, leaf: int, seed: int) -> None:
        self.x = x
        at = lifted(x, float(np.einsum("ij,ij->i", x, x).max()))
        self.trees = [Tree(at, leaf, np.random.default_rng([seed, t])) for t in range(trees)]

    def leaves(self, query: np.ndarray) -> Iterator[np.ndarray]:
        """Points of the leaves of all trees, nearest leaves first."""
        q = np.append(query, 0.0)
        margins = [(t.plane @ q - t.cut).tolist() if len(t.cut) else [] for t in self.trees]
        queue = [(0.0, t, tree.root) for t, tree in enumerate(self.trees)]
        push, pop = heapq.heappush, heapq.heappop
        while queue:
            worst, t, node = pop(queue)
            tree, margin = self.trees[t], margins[t]
            while node >= 0:
                m = margin[node]
                far, near = tree.children[node] if m > 0 else tree.children[node][::-1]
                push(queue, (max(worst, abs(m)), t, far))
                node = near
            yield tree.leaves[-node - 1]

    def candidates(self, query: np.ndarray, want: int) -> np.ndarray:
        """Points met until there are ``want``."""
        met = np.zeros(len(self.x), bool)
        count = 0
        for points in self.leaves(query):
            count += len(points) - int(np.count_nonzero(met[points]))
            met[points] = True
            if count >= want:
                break
        return np.flatnonzero(met)

    def met_at(self, query: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """How many points have been met when each of ``wanted`` is."""
        met = np.zeros(len(self.x), bool)
        at = np.full(len(wanted), -1)
        count = 0
        for points in self.leaves(query):
            count += len(points) - int(np.count_nonzero(met[points]))
            met[points] = True
            at[(at < 0) & met[wanted]] = count
            if (at >= 0).all():
                break
        return at

    def enough(self, queries: np.ndarray, k: int, target: float) -> int:
        """Points to be met so that ``target`` of all these queries' ``k`` nearest are among them."""
        k = min(k, len(self.x))
        places = [self.met_at(q, np.argpartition(-(self.x @ q), k - 1)[:k]) for q in queries]
        return int(np.quantile(np.concatenate(places), target, method="higher"))


class Router:
    """The first levels of a tree, which deal vectors into leaves; fitted on a sample."""

    def __init__(self, sample: np.ndarray, longest: float, leaves: int, k: int, target: float) -> None:
        self.longest = longest
        at = lifted(sample, longest)
        self.tree = Tree(at, max(1, -(-len(sample) // leaves)), np.random.default_rng(5))
        self.children = np.array(self.tree.children or [[-1, -1]])
        self.size = len(self.tree.leaves)
        self.reach = self.size
        if self.size > 1:
            some = sample[:: max(1, len(sample) // CALIBRATION)][:CALIBRATION]
            leaf = self.leaf_of(sample)
            places = []
            for q in some:
                place = np.empty(self.size, np.int64)
                place[self.nearest(q)] = np.arange(self.size)
                places.append(place[leaf[np.argsort(-(sample @ q), kind="stable")[1 : k + 1]]])
            self.reach = 1 + int(np.quantile(np.concatenate(places), target, method="higher"))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = lifted(x, self.longest)
        node = np.full(len(x), self.tree.root)
        while (inner := np.flatnonzero(node >= 0)).size:
            n = node[inner]
            upper = np.einsum("ij,ij->i", at[inner], self.tree.plane[n]) > self.tree.cut[n]
            node[inner] = self.children[n, upper.astype(int)]
        return -node - 1

    def nearest(self, query: np.ndarray) -> list[int]:
        """Leaves, the nearest first."""
        if self.size == 1:
            return [0]
        margin = (self.tree.plane @ np.append(query, 0.0) - self.tree.cut).tolist()
        queue, out = [(0.0, self.tree.root)], []
        while queue:
            worst, node = heapq.heappop(queue)
            while node >= 0:
                far, near = self.tree.children[node] if margin[node] > 0 else self.tree.children[node][::-1]
                heapq.heappush(queue, (max(worst, abs(margin[node])), far))
                node = near
            out.append(-node - 1)
        return out


def _search(index: pa.Table, queries: pa.Table, k: int, trees: int, leaf: int, target: float, schema: pa.Schema) -> pa.Table:
    if not index.num_rows or not queries.num_rows:
        return schema.empty_table()
    matrix = lambda t: np.stack(t.column("v").to_numpy())
    all_ids, raw = index.column("id").to_numpy(), matrix(index)
    x, back = np.unique(raw, axis=0, return_inverse=True)
    order = np.lexsort((all_ids, back.ravel()))
    ids, of = all_ids[order], back.ravel()[order]
    # Rows repeated in id and vector count once, before equal vectors are cut to k + 1 ids.
    first = np.concatenate([[True], (ids[1:] != ids[:-1]) | (of[1:] != of[:-1])])
    ids, of = ids[first], of[first]
    starts = np.searchsorted(of, np.arange(len(x) + 1))
    forest = Forest(x, trees, leaf, 7)
    queries = queries.sort_by([("key", "ascending"), ("id", "ascending")])
    asked = matrix(queries)
    want = max(k + 1, forest.enough(x[:: max(1, len(x) // CALIBRATION)][:CALIBRATION], k + 1, target))
    out: list[tuple[np.ndarray, ...]] = []
    for own, key, q in zip(queries.column("id").to_pylist(), queries.column("key").to_pylist(), asked, strict=True):
        found = forest.candidates(q, want)
        n_met = len(found)
        near = x[found] @ q
        if len(found) > k + 1:
            # Rounding of this first product must not decide: a little more is kept than is needed.
            least = np.partition(near, len(near) - k - 1)[len(near) - k - 1]
            found = found[near >= least - 1e-9 * max(1.0, abs(least))]
        score = (x[found].astype(np.longdouble) * q).sum(1).astype(np.float64)
        counts = np.minimum(starts[found + 1] - starts[found], k + 1)
        rows = np.repeat(starts[found], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        score, near_ids = np.repeat(score, counts), ids[rows]
        other = near_ids != own
        score, near_ids = score[other], near_ids[other]
        best = np.lexsort((near_ids, -score))[:k]
        met = np.zeros(len(best), np.int64)
        met[:1] = n_met
        out.append((np.full(len(best), key), np.full(len(best), own), near_ids[best], score[best], met))
    return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=schema)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    trees: int = 16,
    leaf: int = 64,
    target: float = 0.95,
    shard_rows: int = 8192,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id_column`` and ``score`` of each query's ``k`` nearest found, and ``examined``."""

    def usable(df: DataFrame) -> DataFrame:
        v = F.col("v")
        bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
        rows = df.select(df[id_column].cast("long").alias("id"), df[vector_column].cast("array<double>").alias("v"))
        return rows.filter(F.col("id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda c: c != 0))

    index = usable(vectors)
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    lengths = index.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("longest")).orderBy(F.desc("n"), "d").limit(1).collect()
    dim, n, longest = lengths[0] if lengths else (0, 0, 0.0)
    index, asked = index.filter(F.size("v") == dim), usable(queries).filter(F.size("v") == dim).distinct()
    leaves = max(1, min(MOST_LEAVES, n // shard_rows))
    key = F.xxhash64("id", "v")
    if leaves > 1:
        rows = max(2 * leaves, SAMPLE_VALUES // dim)
        # Only about four times the sample passes the hash.
        some = index.filter(F.pmod(key, F.lit(1 << 30)) <= int(min(1.0, 4.0 * rows / n) * (1 << 30)))
        sample = np.array([r.v for r in some.orderBy(key, "id").limit(rows).select("v").collect()])
    else:
        sample = np.zeros((1, max(1, dim)))
    router = Router(sample, longest, leaves, k, target**0.5 if leaves > 1 else 1.0)
    target = target**0.5 if leaves > 1 else target

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaf = router.leaf_of(np.stack(batch.column(1).to_numpy(zero_copy_only=False))) if router.size > 1 else np.zeros(batch.num_rows, np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=["id", "v", "leaf"])

    def visit(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = [router.nearest(q)[: router.reach] for q in np.stack(batch.column(1).to_numpy(zero_copy_only=False))]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], names=["id", "v", "leaves"])

    dealt = common.materialize(common.map_rows(index, deal, "id long, v array<double>, leaf int"), "ann-index")
    visits = common.map_rows(asked, visit, "id long, v array<double>, leaves array<int>")
    # A row per leaf, MOST_LEAVES at the most.
    sizes = F.broadcast(dealt.groupBy("leaf").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / shard_rows)).cast("int").alias("shards")))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    # A shard is read once per block of queries.
    left = dealt.join(sizes, "leaf").select("id", "v", "leaf", F.pmod(key, F.col("shards")).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asking = visits.select("id", "v", key.alias("key"), F.explode("leaves").alias("leaf")).join(sizes, "leaf")
    right = asking.select("id", "v", "key", "leaf", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.pmod("key", F.lit(blocks)).cast("int").alias("block"))
    schema = pa.schema([("key", pa.int64()), ("query_id", pa.int64()), ("near", pa.int64()), ("score", pa.float64()), ("met", pa.int64())])
    one = ("leaf", "shard", "block")
    found = (
        left.groupBy(*one)
        .cogroup(right.groupBy(*one))
        .applyInArrow(lambda a, b: _search(a, b, k, trees, leaf, target, schema), "key long, query_id long, near long, score double, met long")
    )
    each = Window.partitionBy("key", "query_id")
    ranked = found.withColumn("examined", F.sum("met").over(each)).withColumn("rank", F.row_number().over(each.orderBy(F.desc("score"), "near")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", F.col("near").alias(id_column), "score", "examined")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))
