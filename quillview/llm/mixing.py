"""Mixing sources to target weights by Poisson replication.

A source with weight w should hold the share w of the mixture, so each of its documents is wanted
``rate = w / sum of weights * size of the mixture / size of the source`` times on average. The number
of copies of a document is a Poisson number with that mean, found by inverting the distribution
function at a uniform number that a hash of seed, document id and text gives. Each document is
exploded by its count and the copies are dealt out and ordered by a hash of their own: a global
shuffle that needs no sampling pass and comes out the same on any cluster.

All of it is DataFrame functions. A source's distribution function is tabulated once, a row per source;
after a check of their number and size these rows are broadcast, so that texts are shuffled once, at the
end. With more sources than that they are joined by shuffling; a hot source is then a hot key of that
join, which adaptive execution splits. The size of a source and of the mixture is its number of rows,
over all rows.

Defined results: a null source is a source of its own (named ``None`` in ``weights``). A null text
or id counts like any other value. Sources that ``weights`` does not name have weight 0 when weights are
given; without weights all sources weigh the same. A source with rate 0 gives no rows. An empty
table gives an empty result. Repeated rows (equal id and text) get equal counts. All input columns are
kept; the operator's own columns have names that are free in the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Bits of the hash that make the uniform number: as many as a double holds exactly.
BITS = 52


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts' text, the same in any engine."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << BITS))


def _log_factorial(k: Column) -> Column:
    """ln k! by Stirling's series, exact to a double's precision from k = 40 on."""
    x = k.cast("double")
    return x * F.ln(x) - x + F.ln(2 * F.pi() * x) / 2 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)


def distributions(rates: DataFrame) -> DataFrame:
    """``__source``, ``__least`` and ``__below``: P(X <= k) for k from ``__least`` on, of a Poisson number X with mean ``__rate``.

    What lies below ``__least`` or beyond the last k is under 2**-53. So a source has some 24 square
    roots of its rate entries, a rate of a million 24,000.
    """
    spread = 12 * F.sqrt("__rate") + 40
    ends = common.computed(
        rates.filter("__rate > 0"), ["__source", "__rate"],
        __least=F.greatest(F.lit(0).cast("bigint"), F.floor(F.col("__rate") - spread)), __last=F.floor(F.col("__rate") + spread),
    )
    steps = ends.withColumn("k", F.explode(F.sequence("__least", "__last")))
    one = Window.partitionBy("__source").orderBy("k")
    log = F.when(F.col("k") == F.col("__least"), F.when(F.col("k") > 0, _log_factorial(F.col("k"))).otherwise(0.0)).otherwise(F.ln(F.col("k").cast("double")))
    logs = steps.withColumn("logs", F.sum(log).over(one))
    below = logs.withColumn("p", F.sum(F.exp(F.col("k") * F.ln("__rate") - F.col("__rate") - F.col("logs"))).over(one))
    rows = below.groupBy("__source", "__least").agg(F.array_sort(F.collect_list(F.struct("k", "p"))).alias("__all"))
    return rows.select("__source", "__least", F.transform("__all", lambda x: x["p"]).alias("__below"))


def poisson(least: Column, below: Column, u: Column) -> Column:
    """The least k with u < P(X <= k)."""
    return (least + F.size(F.filter(below, lambda p: p <= u))).cast("int")


#: Sources whose distributions are broadcast, and entries of these; beyond either bound sources are joined by shuffling.
MOST_SOURCES, MOST_ENTRIES = 100_000, 4_000_000


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    seed: int = 17,
    size: float = 1.0,
    source_column: str = "source",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The documents, each as often as its Poisson number says, with ``copy`` (from 0) and the sort
    key of the global shuffle; ``size``: rows of the mixture for each row of the input."""
    spark = docs.sparkSession
    names = ("copy", "shuffle_key")
    free = {n: n if n not in docs.columns else f"{n}__mix" for n in names}
    source = F.coalesce(docs[source_column].cast("string"), F.lit("\0null"))
    counts = docs.groupBy(source.alias("__source")).agg(F.count(F.lit(1)).alias("__n"))
    if weights is not None:
        given = spark.createDataFrame([("\0null" if k is None else k, float(w)) for k, w in weights.items()] or [("", 0.0)], "__name string, __weight double")
        counts = counts.join(F.broadcast(given), F.col("__source") == F.col("__name"), "left")  # as many rows as the parameter names
        weight = F.coalesce("__weight", F.lit(0.0))
    else:
        weight = F.lit(1.0)
    counts = common.materialize(counts.select("__source", "__n", weight.alias("__w")), "mixing-sources")
    total = counts.agg(F.sum("__w").alias("w"), F.sum("__n").alias("n")).first()
    share = F.try_divide(F.col("__w"), F.lit(total.w))
    rates = counts.select("__source", F.coalesce(F.try_divide(share * size * F.lit(total.n), F.col("__n")), F.lit(0.0)).alias("__rate"))
    known = common.materialize(distributions(rates), "mixing-distributions")
    bound = known.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("__below")), F.lit(0)).alias("entries")).first()
    if bound.rows <= MOST_SOURCES and bound.entries <= MOST_ENTRIES:
        known = F.broadcast(known)
    rows = common.computed(
        docs.withColumn("__source", source), [*docs.columns, "__source"], __digest=F.md5(F.coalesce(docs[text_column].cast("string"), F.lit("")))
    )
    drawn = common.computed(rows, [*rows.columns], __u=uniform(F.lit(seed), F.col(id_column), F.col("__digest")))
    wanted = common.computed(drawn.join(known, "__source"), [*docs.columns, "__digest"], __copies=poisson(F.col("__least"), F.col("__below"), F.col("__u")))
    copies = wanted.filter("__copies > 0").withColumn(free["copy"], F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    keyed = copies.withColumn(free["shuffle_key"], F.md5(F.concat_ws("|", F.lit(f"{seed}s"), F.coalesce(F.col(id_column).cast("string"), F.lit("~")), F.col("__digest"), F.col(free["copy"]))))
    dealt = keyed.select(*docs.columns, *free.values()).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), free["shuffle_key"])
    return dealt.sortWithinPartitions(free["shuffle_key"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents"))


ORACLE = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, (1.0::DOUBLE / (SELECT count(*) FROM counts)) * (SELECT sum(n) FROM counts)::DOUBLE / n AS rate FROM counts),
steps AS (SELECT source, rate, k FROM rates, LATERAL (SELECT unnest(range(0, CAST(floor(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS k)),
cdf AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lf)) OVER (PARTITION BY source ORDER BY k) AS p
  FROM (SELECT *, sum(CASE WHEN k > 0 THEN ln(k) ELSE 0 END) OVER (PARTITION BY source ORDER BY k) AS lf FROM steps)
),
seeded AS (
  SELECT *, CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '~') || '|' || md5(coalesce(text, ''))), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0 AS u
  FROM documents
),
counted AS (
  SELECT s.*, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM s.source AND cdf.p <= s.u) AS copies FROM seeded s
)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
       md5('17s|' || coalesce(CAST(doc_id AS VARCHAR), '~') || '|' || md5(coalesce(text, '')) || '|' || CAST(copy AS VARCHAR)) AS shuffle_key
FROM counted, LATERAL (SELECT unnest(range(0, copies)) AS copy)
"""
