"""Near-duplicates by b-bit MinHash.

A document's words are shingled and its set of shingles hashed; ``k`` minima are taken over it. Rows
of minima hashed in full make the bands that bring candidates together; of each minimum only the
lowest 2 bits are kept, packed into a signature. A candidate pair's similarity is estimated by bit
counts over the two signatures, corrected for the quarter of unequal minima that agree by chance,
and pairs far below the threshold are dropped. What is left is confirmed on the full sets.

Hot groups never become all of their pairs:

* documents with equal sets are one class, represented once;
* in a bucket of a band every class is paired with the bucket's smallest only (a star); buckets with over a
  thousandth of all classes, a bounded number, are broadcast to their entries instead of gathering them;
* a bucket whose classes are not in one component afterwards is looked at again: in blocks, every two
  of its classes from different components are compared on signatures, inside the task, and the
  trees that the allowed pairs make come out as stars: as many rows as classes at most;
* the trees of these forests are clusters; in blocks again, every two classes of a cluster from
  different components are compared on their full sets, as bit rows over the cluster's shared
  shingles, inside the task, and only links that join two components come out. So a pair in one
  bucket that could link two components is never left untested, and no list of pairs is made.

Links are between classes; components follow by rounds of joins. With 32 bands of 4 rows a pair at the
threshold of 0.8 shares no bucket with a probability of 5e-8, and a signature of 128 minima puts it
below the cut-off (0.2 under the threshold) with a probability of about 1e-6.

Words are runs of bytes other than ASCII white space, after A-Z are lower-cased. A text with fewer
words than a shingle has one shingle, all its words.

Defined results: a null or empty text has no shingles, is linked with nothing and is its own
component. Rows with a null id are linked with nothing; component null, not kept. Repeated rows
(equal id and text) get equal results each. Order does not matter, an empty table gives an empty
result, other columns are ignored by :func:`near_duplicates` and kept by :func:`drop_duplicates`.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .components import components

MINIMA, BANDS, ROWS = 128, 32, 4
BITS = 2
CHANCE = 0.5**BITS
#: Signatures pack 32 two-bit minima into each of these words.
LANES = MINIMA * BITS // 64
#: A bucket with more than this part of all classes is hot.
HOT = 1000
#: Classes of one block in the comparison of a bucket that is not in one component.
BLOCK = 1024
#: Bytes of bit rows that a task compares at a time.
BIT_BYTES = 64 << 20
SLACK = 0.2

_rng = np.random.default_rng(20240611)
_MUL = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)


class WordHashes(dict):
    """word -> 64-bit hash, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(out)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """MINIMA x len(sets), 32 bits each; every set has a member. Done in runs that stay in cache."""
    out = np.empty((MINIMA, len(sets)), np.uint32)
    at = 0
    while at < len(sets):
        upto, members = at, 0
        while upto < len(sets) and (upto == at or members + len(sets[upto]) <= 32_768):
            members += len(sets[upto])
            upto += 1
        x = np.concatenate(sets[at:upto])
        low = (x ^ (x >> np.uint64(32))).astype(np.uint32)
        starts = np.cumsum([0] + [len(s) for s in sets[at : upto - 1]])
        # A very long set goes through in pieces of the same size.
        if len(low) > 65_536:
            best = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
            for k in range(0, len(low), 65_536):
                piece = low[k : k + 65_536]
                for j in range(MINIMA):
                    best[j] = min(best[j], (piece * _MUL[j] + _ADD[j]).min())
            out[:, at] = best
        else:
            for j in range(MINIMA):
                out[j, at:upto] = np.minimum.reduceat(low * _MUL[j] + _ADD[j], starts)
        at = upto
    return out


def bands_of(found: np.ndarray) -> np.ndarray:
    """len(sets) x BANDS keys."""
    out = np.empty((found.shape[1], BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(found.shape[1], b + 1, np.uint64)
        for r in range(ROWS):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + found[b * ROWS + r].astype(np.uint64))
        out[:, b] = key
    return out


def signature(found: np.ndarray) -> np.ndarray:
    """LANES x len(sets): the lowest bits of the minima, packed."""
    out = np.zeros((LANES, found.shape[1]), np.uint64)
    per = 64 // BITS
    low = (found ^ (found >> np.uint32(16))) & np.uint32((1 << BITS) - 1)
    for j in range(MINIMA):
        out[j // per] |= low[j].astype(np.uint64) << np.uint64(j % per * BITS)
    return out


def _sketch(docs: DataFrame, id_column: str, text_column: str, size: int) -> DataFrame:
    """id, n (size of the set), set (digest of the set), bands, s0.. (signature)."""
    hashes = WordHashes()

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t or b"", size, hashes) for t in common.utf8(batch.column(2))]
        full = [k for k, s in enumerate(sets) if len(s)]
        found = minima([sets[k] for k in full])
        bands, packed = bands_of(found).view(np.int64), signature(found).view(np.int64)
        where = {k: i for i, k in enumerate(full)}
        lists = [bands[where[k]] if k in where else None for k in range(len(sets))]
        index = pa.array([where.get(k) for k in range(len(sets))], pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(list(map(len, sets)), pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array(lists, pa.list_(pa.int64())),
                *(pa.array(lane).take(index) for lane in packed),
            ],
            names=["id", "text_hash", "n", "set", "bands", *(f"s{k}" for k in range(LANES))],
        )

    lanes = ", ".join(f"s{k} long" for k in range(LANES))
    text = docs[text_column].cast("string")
    rows = docs.select(docs[id_column].cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), text.alias("text"))
    return common.map_rows(rows, one, f"id long, text_hash long, n long, set binary, bands array<long>, {lanes}")


def _disagree(left: str, right: str) -> Column:
    """Minima whose kept bits differ."""
    total = F.lit(0)
    for k in range(LANES):
        x = F.col(f"{left}{k}").bitwiseXOR(F.col(f"{right}{k}"))
        total = total + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return total


def most_disagreeing(threshold: float) -> int:
    """Disagreeing minima up to which a pair stays: agreement = chance + (1 - chance) * similarity."""
    least = max(0.0, threshold - SLACK)
    return int(MINIMA * (1 - CHANCE) * (1 - least))


def _promising(pairs: DataFrame, classes: DataFrame, share: Fraction) -> DataFrame:
    """Of pairs (a, b) those that sizes and signatures allow."""
    lanes = [f"s{k}" for k in range(LANES)]
    left = classes.select(F.col("cid").alias("a"), F.col("n").alias("na"), *[F.col(c).alias("l" + c) for c in lanes])
    right = classes.select(F.col("cid").alias("b"), F.col("n").alias("nb"), *[F.col(c).alias("r" + c) for c in lanes])
    both = pairs.join(left, "a").join(right, "b")
    fits = share.denominator * F.least("na", "nb") >= share.numerator * F.greatest("na", "nb")
    return both.filter(fits & (_disagree("ls", "rs") <= most_disagreeing(float(share)))).select("a", "b")


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_column: str, text_column: str, size: int, share: Fraction) -> DataFrame:
    """Of pairs (a, b) those whose full sets are similar enough."""
    needed = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b"))).distinct()
    sets = _class_sets(needed, classes, docs, id_column, text_column, size)

    def similar(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(share.denominator * both >= share.numerator * (len(x) + len(y) - both))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = sets.select(F.col("cid").alias("a"), F.col("members").alias("x")), sets.select(F.col("cid").alias("b"), F.col("members").alias("y"))
    links = common.materialize(common.map_rows(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y"), similar, "a long, b long"), "links")
    common.release(sets)
    return links


def _disagreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Disagreeing minima of one signature with many; lanes come first."""
    total = np.zeros(right.shape[1], np.int64)
    for x, y in zip(left, right, strict=True):
        d = x ^ y
        total += np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(0x5555555555555555))
    return total


def _in_blocks(members: DataFrame, key: str) -> DataFrame:
    """A row per class and block that its own block meets: ``key, lo, hi, block`` and the other columns.

    ``size`` is the number of classes of the key. Every two blocks meet in a task of their own.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.hash("cid"), F.col("blocks")))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("blocks", "other", "size")


def _block_arrays(rows: pa.Table) -> tuple[np.ndarray, ...]:
    cid, root, n = (rows.column(c).to_numpy() for c in ("cid", "root", "n"))
    sig = np.stack([rows.column(f"s{k}").to_numpy().astype(np.int64).view(np.uint64) for k in range(LANES)])
    block = rows.column("block").to_numpy()
    left, right = np.flatnonzero(block == rows.column("lo")[0].as_py()), np.flatnonzero(block == rows.column("hi")[0].as_py())
    return cid, root, n, sig, left, right


def _pairs_table(found: list[tuple[int, int]]) -> pa.Table:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _forests(members: DataFrame, share: Fraction) -> DataFrame:
    """Per bucket, trees of classes that signatures allow to be linked across components.

    ``members``: key, cid, root, n, size of the bucket, signature.
    """
    limit = most_disagreeing(float(share))
    num, den = share.numerator, share.denominator

    def compare(rows: pa.Table) -> pa.Table:
        cid, root, n, sig, left, right = _block_arrays(rows)
        tree = np.arange(len(cid))
        for i in left.tolist():
            open_ = right[(root[right] != root[i]) & (tree[right] != tree[i])]
            if not len(open_):
                continue
            ok = open_[_disagreement(sig[:, i], sig[:, open_]) <= limit]
            ok = ok[den * np.minimum(n[ok], n[i]) >= num * np.maximum(n[ok], n[i])]
            trees = np.unique(tree[ok])
            if len(trees):
                tree[np.isin(tree, trees)] = tree[i]
        # Each tree as a star from its smallest class: other buckets of a group give the same rows.
        order = np.lexsort((cid, tree))
        of, member = tree[order], cid[order]
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        lead = np.repeat(member[starts], np.diff(np.append(starts, len(of))))
        return _pairs_table([(int(a), int(b)) for a, b in zip(lead, member, strict=True) if a != b])

    lanes = [f"s{k}" for k in range(LANES)]
    return _in_blocks(members, "key").select("key", "lo", "hi", "block", "cid", "root", "n", *lanes).groupBy("key", "lo", "hi").applyInArrow(compare, "a long, b long").distinct()


def _shared(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, column) of every shingle that two sets or more hold, and the number of columns."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    kept = count[column] > 1
    names, column = np.unique(column[kept], return_inverse=True)
    return row[kept], column, len(names)


def _cluster_links(members: DataFrame, share: Fraction) -> DataFrame:
    """Links, confirmed on full sets, that join two components of a cluster.

    ``members``: cluster, cid, root, n, size of the cluster, signature, members (the set's bytes).
    """
    limit = most_disagreeing(float(share))
    num, den = share.numerator, share.denominator

    def compare(rows: pa.Table) -> pa.Table:
        cid, root, n, sig, left, right = _block_arrays(rows)
        open_ = np.zeros((len(left), len(right)), bool)
        for k, i in enumerate(left.tolist()):
            fits = (root[right] != root[i]) & (den * np.minimum(n[right], n[i]) >= num * np.maximum(n[right], n[i]))
            some = np.flatnonzero(fits)
            open_[k, some] = _disagreement(sig[:, i], sig[:, right[some]]) <= limit
        # Only classes with a partner take part from here on.
        keep_left, keep_right = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
        if not len(keep_left):
            return _pairs_table([])
        open_, left, right = open_[np.ix_(keep_left, keep_right)], left[keep_left], right[keep_right]
        used = np.unique(np.concatenate([left, right]))
        raw = rows.column("members")
        row, column, width = _shared([np.frombuffer(raw[int(k)].as_py(), np.uint64) for k in used])
        left_at, right_at = np.searchsorted(used, left), np.searchsorted(used, right)
        both = np.zeros(open_.shape, np.int64)
        step = max(64, BIT_BYTES // max(1, len(used)) * 8 // 64 * 64)
        for lo in range(0, width, step):
            part = (column >= lo) & (column < lo + step)
            bits = np.zeros((len(used), -(-min(step, width - lo) // 64)), np.uint64)
            at = column[part] - lo
            np.bitwise_or.at(bits, (row[part], at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
            for k, i in enumerate(left_at.tolist()):
                js = np.flatnonzero(open_[k])
                both[k, js] += np.bitwise_count(bits[right_at[js]] & bits[i]).sum(1, dtype=np.int64)
        linked = open_ & (den * both >= num * (n[left][:, None] + n[right][None, :] - both))
        label = root.copy()
        out: list[tuple[int, int]] = []
        for k, i in enumerate(left.tolist()):
            js = right[np.flatnonzero(linked[k])]
            js = js[label[js] != label[i]]
            labels, first = np.unique(label[js], return_index=True)
            out += [(int(cid[i]), int(cid[j])) for j in js[first].tolist()]
            if len(labels):
                label[np.isin(label, labels)] = label[i]
        return _pairs_table(out)

    lanes = [f"s{k}" for k in range(LANES)]
    return _in_blocks(members, "cluster").select("cluster", "lo", "hi", "block", "cid", "root", "n", *lanes, "members").groupBy("cluster", "lo", "hi").applyInArrow(compare, "a long, b long")


def _class_sets(needed: DataFrame, classes: DataFrame, docs: DataFrame, id_column: str, text_column: str, size: int) -> DataFrame:
    """``cid`` and ``members`` (the set's bytes) of the classes in ``needed`` (cid, distinct)."""
    hashes = WordHashes()
    wanted = needed.join(classes.select("cid", "id", "set"), "cid")
    texts = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].cast("string").alias("text")).join(wanted, "id")

    def members(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, sets = [], []
        for cid, want, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), common.utf8(batch.column(2)), strict=True):
            found = shingles(text or b"", size, hashes)
            if xxhash.xxh3_128_digest(found.tobytes()) == want:  # not another text under the same id
                ids.append(cid)
                sets.append(found.tobytes())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["cid", "members"])

    sets = common.map_rows(texts.select("cid", "set", "text"), members, "cid long, members binary").dropDuplicates(["cid"])
    return common.materialize(sets, "sets")


def _classes(docs: DataFrame, id_column: str, text_column: str, size: int) -> tuple[DataFrame, DataFrame]:
    rows = common.materialize(_sketch(docs, id_column, text_column, size), "sketches")
    lanes = [f"s{k}" for k in range(LANES)]
    picked = rows.filter("n > 0 AND id IS NOT NULL").groupBy("set").agg(F.min(F.struct("id", "n", "bands", *lanes)).alias("x")).select("set", "x.*")
    return rows, common.materialize(picked.withColumn("cid", F.monotonically_increasing_id()), "classes")


def _join_buckets(entries: DataFrame, buckets: DataFrame, n_classes: int) -> DataFrame:
    """``entries`` (key, ...) joined with ``buckets`` (key, size, ...); no task gets a hot bucket's entries.

    A bucket with more than 1 / HOT of all classes is hot. A band has under HOT of them, so all bands
    together have at most BANDS * HOT, a bound on the rows that are broadcast at any size. What is left
    is joined by key, where no key has more than 1 / HOT of a band's entries.
    """
    hot = buckets.filter(F.col("size") * HOT > n_classes)
    few = buckets.filter(F.col("size") * HOT <= n_classes)
    return entries.join(F.broadcast(hot), "key").unionByName(entries.join(F.broadcast(hot.select("key")), "key", "left_anti").join(few, "key"))


def link_classes(docs: DataFrame, classes: DataFrame, id_column: str, text_column: str, size: int, share: Fraction) -> DataFrame:
    """``cid`` and ``root`` for every class that is linked with another."""
    n_classes = classes.count()
    entries = classes.select("cid", F.explode("bands").alias("key"))
    buckets = common.materialize(entries.groupBy("key").agg(F.min("cid").alias("lead"), F.count(F.lit(1)).alias("size")).filter("size > 1"), "buckets")
    met = common.materialize(_join_buckets(entries, buckets, n_classes), "buckets")
    star = met.filter("cid <> lead").select(F.col("lead").alias("a"), F.col("cid").alias("b")).distinct()
    near = common.materialize(_promising(star, classes, share), "candidates")
    links = _confirm(near, classes, docs, id_column, text_column, size, share)
    labels = components(links).withColumnRenamed("node", "cid")
    more = _complete(met, n_classes, classes, labels, docs, id_column, text_column, size, share)
    if more is not None:
        labels = components(links.union(more)).withColumnRenamed("node", "cid")
        common.release(more)
    common.release(buckets, met, near, links)
    return labels


def _complete(
    met: DataFrame, n_classes: int, classes: DataFrame, labels: DataFrame, docs: DataFrame, id_column: str, text_column: str, size: int, share: Fraction
) -> DataFrame | None:
    """Links that the stars did not test, of buckets whose classes are in several components."""
    lanes = [f"s{k}" for k in range(LANES)]
    placed = met.filter("size > 2").select("key", "cid", "size").join(labels, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    spread = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.first("size").alias("size"))
    split = common.materialize(spread.filter("lo <> hi").select("key", "size"), "split")
    members = _join_buckets(placed.drop("size"), split, n_classes).join(classes.select("cid", "n", *lanes), "cid")
    trees = common.materialize(_forests(members, share), "forests")
    common.release(split)
    if trees.limit(1).count() == 0:
        common.release(trees)
        return None
    clusters = components(trees).select(F.col("node").alias("cid"), F.col("root").alias("cluster"))
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    sets = _class_sets(clusters.select("cid"), classes, docs, id_column, text_column, size)
    full = clusters.join(sizes, "cluster").join(labels, "cid", "left").withColumn("root", F.coalesce("root", "cid")).join(classes.select("cid", "n", *lanes), "cid").join(sets, "cid")
    links = common.materialize(_cluster_links(full, share), "links")
    common.release(trees, sets)
    return links


def _labelled(docs: DataFrame, id_column: str, text_column: str, size: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    share = Fraction(threshold).limit_denominator(1000)
    rows, classes = _classes(docs, id_column, text_column, size)
    roots = link_classes(docs, classes, id_column, text_column, size, share)
    labelled = classes.select("set", "cid", "id").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = labelled.groupBy("root").agg(F.min(F.struct(F.col("id").alias("component_id"), F.col("set").alias("first_set"))).alias("m"))
    return rows, labelled.join(least, "root").select("set", "m.component_id", "m.first_set")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5, threshold: float = 0.8) -> DataFrame:
    """Per row: id, size of its set, component (smallest id that links reach) and whether it is that one."""
    rows, labels = _labelled(docs, id_column, text_column, size, threshold)
    out = rows.select("id", "n", "set").join(labels, "set", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs``, one of each component; rows without an id or without words all stay.

    Of rows that are alike in id and text one stays.
    """
    rows, labels = _labelled(docs, id_column, text_column, size, threshold)
    first = rows.filter("set IS NOT NULL AND id IS NOT NULL").join(labels, "set").filter("id = component_id AND set = first_set")
    # Other texts can have the first one's set (other case, other white space): one text of them stays.
    keep = first.groupBy("id").agg(F.min("text_hash").alias("text_hash"))
    text = common.text_or_empty(docs, text_column)
    plain = F.length(F.translate(text, " \t\n\x0b\x0c\r", "")) == 0
    base = docs.withColumn("__id", docs[id_column].cast("long")).withColumn("__hash", F.xxhash64(text))
    exempt = F.col("__id").isNull() | plain
    chosen = base.filter(~exempt).join(keep.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")), ["__id", "__hash"], "left_semi")
    alike = Window.partitionBy("__id", "__hash").orderBy(F.lit(1))
    once = chosen.withColumn("__at", F.row_number().over(alike)).filter("__at = 1")
    return once.select(*docs.columns).unionByName(base.filter(exempt).select(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), size=2)
