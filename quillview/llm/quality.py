"""Quality rules over lines that many documents of a host share.

Base rules look at one text alone: too few words, or too many words inside 8-word windows that the
text holds twice. The method looks across documents: lines are normalised (case, white space and
digits), hashed, and counted by the number of distinct texts of the host that hold them. A line in
more than ``max(min_texts, share * texts of the host)`` distinct texts is boilerplate and is removed.
That limit grows with the host; ``enough``, where given, is a number of distinct texts that suffices in
a host of any size. A document that keeps too few words, or too small a part of its words, is rejected. Exact copies
count as one text: copying a page does not make its lines boilerplate, near-duplicate removal deals
with copies.

Only DataFrame functions. Lines are hashed before any shuffle and counted with partial aggregation;
texts are never shuffled to judge them. Only lines above the limit are joined back, on (host, line), a
join that adaptive execution can split.

Defined results: a null or empty text has no words and no lines; all counts are 0, ``base_failed`` is
true. A null host is a host of its own. Null ids pass through. Repeated rows give repeated results,
order does not matter, an empty table gives an empty result. Other columns of the input are ignored
by :func:`judge` and kept by :func:`clean`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Fixed values of the base rules.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, "[ \\t-\\r]+"), "")


def lines_of(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit("[^ \\t-\\r]")))


def base_counts(docs: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = lines_of(text)
    got = common.computed(
        docs, keep, __words=words_of(text), n_symbols=F.regexp_count(text, F.lit("[" + SYMBOLS + "]")).cast("long"), n_dup_lines=(F.size(lines) - F.size(F.array_distinct(lines))).cast("long")
    )
    n = F.size("__words")
    counted = [*keep, "n_symbols", "n_dup_lines"]
    hashed = common.computed(got, counted, n_words=n.cast("long"), word_chars=F.length(F.array_join("__words", "")).cast("long"), __one=F.transform("__words", lambda w: F.xxhash64(w)))
    counted += ["n_words", "word_chars"]

    # Items are fetched one by one: a slice would copy the whole array for each run.
    four = F.transform(F.sequence(F.lit(0), F.size("__one") - 4), lambda i: F.xxhash64(*[F.get("__one", i + k) for k in range(4)]))
    fours = common.computed(hashed, counted, __four=F.when(F.col("n_words") < WINDOW, F.array().cast("array<bigint>")).otherwise(four))
    # A window found twice holds WINDOW - 3 runs of four words that were there before.
    possible = F.size("__four") - F.size(F.array_distinct("__four")) >= WINDOW - 3
    eight = F.transform(F.sequence(F.lit(0), F.size("__four") - 5), lambda i: F.xxhash64(F.get("__four", i), F.get("__four", i + 4)))
    hashed = common.computed(fours, counted, __windows=F.when(possible, eight).otherwise(F.array().cast("array<bigint>")))
    # Windows found twice: sort (hash, place), compare neighbours. Few texts have any.
    twice = F.size(F.array_distinct("__windows")) < F.size("__windows")
    ranked = common.computed(hashed, counted, __sorted=F.when(twice, F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    equal = F.filter(
        F.zip_with("__sorted", F.slice("__sorted", 2, F.size("__sorted")), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))),
        lambda x: x.isNotNull(),
    )
    placed = common.computed(ranked, counted, __places=F.when(F.col("__sorted").isNotNull(), F.sort_array(F.array_distinct(F.flatten(equal)))))
    # Words covered by windows at these places: each adds the words up to the next one, 8 at most.
    covered = F.aggregate(
        F.zip_with("__places", F.slice("__places", 2, F.size("__places")), lambda a, b: F.when(b.isNull(), WINDOW).otherwise(F.least(F.lit(WINDOW), b - a))),
        F.lit(0),
        lambda s, x: s + x,
    )
    return placed.select(*counted, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def normalized(words: Column) -> Column:
    """A line's words in lower case, with numbers made alike."""
    return F.regexp_replace(F.lower(F.array_join(words, " ")), "[0-9]+", "0")


#: 128 bits of a text's hash, so that no two texts of a corpus of any size meet.
DIGEST = ["__d1", "__d2"]


def digests(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("__d1"), F.xxhash64(F.lit(1), text).alias("__d2")]


def shared_lines(docs: DataFrame, text: Column, host: Column, min_texts: int, share: float, enough: int | None = None) -> DataFrame:
    """Boilerplate of each text: ``__host``, its digest, hashes of the lines, their number and words.

    The table of hashed lines is made once. Copies of a text give the same rows; sums are divided by
    their number.
    """
    one = ["__host", *DIGEST]
    split = docs.select(host.alias("__host"), *digests(text), F.explode(F.split(text, "\n")).alias("line")).filter(F.rlike("line", F.lit("[^ \\t-\\r]")))
    cut = common.computed(split, one, __cut=words_of(F.col("line")))
    hashed = cut.select(*one, F.xxhash64(normalized(F.col("__cut"))).alias("__line"), F.size("__cut").alias("__w"))
    lines = common.materialize(hashed.groupBy(*one, "__line").agg(F.count(F.lit(1)).alias("__times"), F.sum("__w").alias("__words")), "quality-lines")
    copies = docs.select(host.alias("__host"), *digests(text)).groupBy(*one).agg(F.count(F.lit(1)).alias("__copies"))
    texts = copies.groupBy("__host").agg(F.count(F.lit(1)).alias("__texts"))
    often = lines.groupBy("__host", "__line").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > min_texts)
    above = F.col("__n") > share * F.col("__texts")
    if enough is not None:
        above |= F.col("__n") > enough
    often = often.join(texts, "__host").filter(above).select("__host", "__line")
    found = lines.join(often, ["__host", "__line"]).groupBy(*one).agg(
        F.collect_set("__line").alias("__gone"), F.sum("__times").alias("__gone_lines"), F.sum("__words").alias("__gone_words")
    )
    each = lambda c: (F.col(c) / F.col("__copies")).cast("long").alias(c)
    return found.join(copies, one).select(*one, "__gone", each("__gone_lines"), each("__gone_words"))


def _host(docs: DataFrame, column: str) -> Column:
    return F.coalesce(docs[column].cast("string"), F.lit("\0null"))


def _judged(docs: DataFrame, keep: list[str], text_column: str, host_column: str, rules: dict[str, float | None]) -> DataFrame:
    """``keep``, host, digest, the counts, the lines to remove and the verdict; no texts."""
    text, host = common.text_or_empty(docs, text_column), _host(docs, host_column)
    gone = shared_lines(docs, text, host, int(rules["min_texts"]), rules["share"], rules["enough"])
    keys = docs.select("*", host.alias("__host"), *digests(text))
    counts = base_counts(keys, text, [*keep, "__host", *DIGEST])
    joined = counts.join(gone, ["__host", *DIGEST], "left")
    kept_words = F.col("n_words") - F.coalesce("__gone_words", F.lit(0))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    depleted = (kept_words < rules["least_words"]) | (kept_words < rules["least_part"] * F.col("n_words"))
    return (
        joined.withColumn("n_removed_lines", F.coalesce("__gone_lines", F.lit(0).cast("long"))).withColumn("n_kept_words", kept_words)
        .withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)
    )


#: The rules of the registered query, as its SQL states them: no number suffices in a large host.
RULES = {"min_texts": 10, "share": 0.05, "enough": None, "least_words": 10, "least_part": 0.2}


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source", **rules: float | None) -> DataFrame:
    """One row per document: the base counts, words left without boilerplate lines, and the verdict.

    ``min_texts`` and ``share``: a line is boilerplate in more distinct texts of its host than both
    the number and the share of the host's distinct texts, or in more than ``enough`` (above
    ``min_texts``) whatever the share. ``least_words`` and ``least_part``: words,
    and part of the words, that a document must keep.
    """
    few = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"), docs[host_column].alias("source"))
    return _judged(few, ["doc_id"], "text", "source", {**RULES, **rules}).select(
        F.col("doc_id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_lines", "n_kept_words", "base_failed", "kept"
    )


def clean(docs: DataFrame, text_column: str = "text", host_column: str = "source", **rules: float | None) -> DataFrame:
    """The documents that are kept, all their columns; boilerplate lines are gone from their texts.

    A text without such lines stays as it is; otherwise its other lines with a word are joined again.
    """
    few = docs.select(docs[text_column].alias("text"), docs[host_column].alias("source"))
    one = ["__host", *DIGEST]
    verdicts = _judged(few, [], "text", "source", {**RULES, **rules}).filter("kept").select(*one, "__gone").dropDuplicates(one)
    text = common.text_or_empty(docs, text_column)
    joined = docs.select("*", _host(docs, host_column).alias("__host"), *digests(text)).join(verdicts, one)
    kept = F.filter(lines_of(F.col(text_column)), lambda x: ~F.array_contains("__gone", F.xxhash64(normalized(words_of(x)))))
    new = F.when(F.col("__gone").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text_column))
    return joined.select(*[new.alias(c) if c == text_column else joined[c] for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (SELECT doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda x: x <> '') AS words FROM docs),
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM w),
windows AS (
  SELECT doc_id, p, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' '
         || lead(word, 4) OVER o || ' ' || lead(word, 5) OVER o || ' ' || lead(word, 6) OVER o || ' ' || lead(word, 7) OVER o AS g
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY p)
),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows WHERE g IS NOT NULL) WHERE c > 1),
repeats AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM docs),
good AS (
  SELECT *, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[ \t-\r]+', ' ', 'g')) AS norm,
         len(list_filter(regexp_split_to_array(line, '[ \t-\r]+'), lambda x: x <> '')) AS nw
  FROM lines WHERE regexp_matches(line, '[^ \t-\r]')
),
hosts AS (SELECT host, count(DISTINCT text) AS texts FROM good GROUP BY host),
often AS (
  SELECT c.host, c.norm FROM (SELECT host, norm, count(DISTINCT text) AS n FROM good GROUP BY host, norm) c JOIN hosts h ON c.host = h.host
  WHERE c.n > 10 AND c.n > 0.05 * h.texts
),
by_doc AS (
  SELECT doc_id, count(*) AS nl, count(DISTINCT line) AS dl, sum(CASE WHEN o.norm IS NULL THEN nw ELSE 0 END) AS kw,
         sum(CASE WHEN o.norm IS NULL THEN 0 ELSE 1 END) AS rl
  FROM good g LEFT JOIN often o ON g.host = o.host AND g.norm = o.norm GROUP BY doc_id
),
counts AS (
  SELECT d.doc_id, CAST(len(w.words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(d.text, '[ \t-\r]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(nl - dl, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(rl, 0) AS BIGINT) AS n_removed_lines, CAST(coalesce(kw, 0) AS BIGINT) AS n_kept_words
  FROM docs d JOIN w ON w.doc_id = d.doc_id LEFT JOIN repeats r ON r.doc_id = d.doc_id LEFT JOIN by_doc b ON b.doc_id = d.doc_id
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_kept_words >= 10 AND n_kept_words >= 0.2 * n_words AS kept
FROM counts
"""
