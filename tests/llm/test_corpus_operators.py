"""Operators over the whole corpus against brute force or SQL."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillview.llm import ann, common, html_main, library, minhash, mixing, quality, sharding
from quillview.llm.components import components
from tests.conftest import SF, same_rows


@pytest.mark.parametrize("name", sorted(library.ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert same_rows(library.QUERIES[name](spark, SF), duck.sql(library.ORACLES[name]))


# --- near-duplicates ---------------------------------------------------------------------------


def shingle_set(text: str, size: int) -> frozenset:
    w = text.encode().lower().split()
    k = min(size, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute_components(rows: list[tuple], size: int) -> Counter:
    sets = [(i, shingle_set(t or "", size)) for i, t in rows]
    classes = defaultdict(list)
    for i, s in sets:
        if i is not None and s:
            classes[s].append(i)
    names = list(classes)
    holders = defaultdict(list)
    up = list(range(len(names)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, s in enumerate(names):
        common = Counter(j for g in s for j in holders[g])
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(names[j]) - n):
                up[find(k)] = find(j)
        for g in s:
            holders[g].append(k)
    least: dict = {}
    for k, s in enumerate(names):
        least[find(k)] = min(least.get(find(k), 1 << 62), *classes[s])
    at = {s: k for k, s in enumerate(names)}
    out = Counter()
    for i, s in sets:
        c = None if i is None else least[find(at[s])] if s else i
        out[i, len(s), c, i is not None and c == i] += 1
    return out


def family(seed: int = 5) -> list[tuple]:
    """Copies of a text with edits, at similarities around the threshold, and unrelated texts."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(2000)]
    texts = []
    for length in (40, 150):
        base = [r.choice(words) for _ in range(length)]
        for _ in range(150):
            e = r.choice([0.01, 0.03, 0.05, 0.07, 0.1])
            texts.append(" ".join(r.choice(words) if r.random() < e else w for w in base))
    texts += [" ".join(r.choice(words) for _ in range(r.randint(1, 60))) for _ in range(100)]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    return rows + [(None, "a b c d"), (9001, None), (9002, ""), (9003, "A b  C"), (9003, "A b  C"), (9004, "one"), (9005, "ONE"), (9006, "w " * 20_000), (9007, "w " * 20_001)]


def test_components_of_a_family(spark):
    rows = family()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(7)).withColumn("set", F.lit("x"))
    got = Counter(tuple(r) for r in minhash.near_duplicates(docs, size=2).collect())
    assert got == brute_components(rows, 2)


def test_one_of_each_group_stays(spark):
    rows = family(6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__id", F.lit(1))
    want = {k[0] for k in brute_components(rows, 5) if k[3]}
    left = minhash.drop_duplicates(docs, size=5)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([*want, None])


def test_minhash_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(none).count() == 0 and minhash.drop_duplicates(none).count() == 0


def test_estimate_follows_similarity():
    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for share in (0.5, 0.8, 0.95):
        a, b = np.unique(x[:2000]), np.unique(np.concatenate([x[: int(2000 * 2 * share / (1 + share))], x[2000 : 4000 - int(2000 * 2 * share / (1 + share))]]))
        both = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        s = minhash.signature(minhash.minima([a, b]))
        apart = int(minhash._disagreement(s[:, 0], s[:, 1:2])[0])
        estimate = (1 - apart / minhash.MINIMA - minhash.CHANCE) / (1 - minhash.CHANCE)
        assert abs(estimate - both) < minhash.SLACK


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501)], "a long, b long")
    assert Counter(r.root for r in components(links).collect()) == {0: 201, 500: 2}


def test_components_of_shuffled_chain_star_and_tree(spark):
    ids = random.Random(8).sample(range(100_000), 5001)
    chain = list(zip(ids, ids[1:], strict=False))
    star = [(200_000 + k, 300_000) for k in range(2000)]
    tree = [(400_000 + k, 400_000 + (k - 1) // 2) for k in range(1, 1000)]
    links = chain + star + tree + chain[:50] + [(b, a) for a, b in star[:50]] + [(7, 7)]
    got = Counter(r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {min(ids): 5001, 200_000: 2001, 400_000: 1000}


def test_no_intermediate_links_are_left(spark):
    with common.scratch(spark, kept := []):
        before = len(common._written)
        assert components(spark.createDataFrame([(1, 2), (2, 3), (8, 9)], "a long, b long")).count() == 5
        assert len(common._written) == before + 1
    assert len(common._written) == before


def test_a_third_of_all_texts_nearly_alike(spark):
    rnd = random.Random(12)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(500)]
    base = [rnd.choice(words) for _ in range(60)]
    rows = [(k, " ".join(base[:-1] + [f"n{k}"])) for k in range(1500)] + [(5000 + k, " ".join(rnd.choice(words) for _ in range(40))) for k in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(r.component_id for r in minhash.near_duplicates(docs, size=2).collect())
    assert got[0] == 1500 and len(got) == 1601


# --- nearest neighbours ------------------------------------------------------------------------


def test_recall(spark):
    got = defaultdict(set)
    for r in ann.query(spark, SF).collect():
        got[r.query_id].add(r.vec_id)
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    hits = 0
    for q, found in got.items():
        score = x @ x[np.flatnonzero(ids == q)[0]]
        score[ids == q] = -np.inf
        hits += len(found & set(ids[np.lexsort((ids, -score))[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(got) and len(got) == 25


def test_recall_in_large_shards(spark):
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(6000, 24)) * rnd.uniform(0.5, 2, size=(6000, 1))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for r in ann.nearest(df, df.filter("vec_id % 100 = 0"), shard_rows=3000).collect():
        found[r.query_id].add(r.vec_id)
    hits = 0
    for q in found:
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-score)[:20].tolist()))
    assert hits >= 0.9 * 20 * len(found)


def test_recall_of_the_registered_query_in_full_shards(spark, tmp_path):
    rnd = np.random.default_rng(11)
    x = rnd.normal(size=(3 * 8192, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(len(x)) * 20 + 1
    ids[::1000] -= 1  # the registered query asks for ids that 20 divides
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = defaultdict(set)
    for r in ann.query(spark, str(tmp_path)).collect():
        found[r.query_id].add(r.vec_id)
    hits = 0
    for k in range(0, len(x), 1000):
        score = x @ x[k]
        score[k] = -np.inf
        hits += len(found[int(ids[k])] & set(ids[np.argsort(-score)[:20]].tolist()))
    print("recall", hits / (20 * len(found)))
    assert len(found) == 25 and hits >= 0.9 * 20 * 25


def test_clustered_vectors_need_few_candidates(spark):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(200, 32))
    x = centres[rnd.integers(0, 200, 12_000)] + 0.3 * rnd.normal(size=(12_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found, examined = defaultdict(set), {}
    for r in ann.nearest(df, df.filter("vec_id % 200 = 0"), shard_rows=1500).collect():
        found[r.query_id].add(r.vec_id)
        examined[r.query_id] = r.examined
    hits = 0
    for q in found:
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-score)[:20].tolist()))
    assert len(found) == 60 and hits >= 0.9 * 20 * 60
    assert np.mean(list(examined.values())) < len(x) / 3


def test_vectors_that_take_no_part(spark):
    rows = [(20, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [2.0, 1.0]), (None, [1.0, 1.0]), (40, [0.0, 3.0]), (6, [1.0]), (7, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(0)).withColumn("v", F.lit(0))
    got = [tuple(r)[:4] for r in ann.nearest(df, df.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(20, 1, 5, 2.0), (20, 2, 1, 1.0), (20, 3, 40, 0.0), (40, 1, 5, 3.0), (40, 2, 1, 0.0), (40, 3, 20, 0.0)]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_a_third_of_all_vectors_alike(spark):
    same = F.array(F.lit(1.0), F.lit(2.0), F.lit(0.5))
    df = spark.range(3000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, same).otherwise(F.array(F.rand(1), F.rand(2), F.rand(3))).alias("embedding"))
    got = ann.nearest(df, df.filter("vec_id IN (60, 1200)"), shard_rows=700).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got[20:]] == list(range(0, 60, 3))


def test_repeated_rows_do_not_hide_equal_vectors(spark):
    rows = [(k, [1.0, 0.0]) for k in range(1, 16)] * 2 + [(1, [1.0, 0.0])] * 30 + [(100 + k, [0.5, 1.0 + k]) for k in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [r.vec_id for r in ann.nearest(df, df.filter("vec_id = 1")).orderBy("rank").collect()]
    assert got == [*range(2, 16), *range(100, 106)]


# --- pages -------------------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><div id="cookie-notice">We use cookies for many things and more</div>
<main><article><header><h1>Head &amp; line</h1></header><p>One two <a href="x">three</a> four.<div class="ad">Buy this thing now please it is very good</div><p>Five
six&nbsp;seven <b>eight</b><form><input><p>mail me</form><ul><li>item one<li>item two</ul><script>if (a<b) "</p>"</script><section id="comments"><p>nice post nice post</p></section></article></main>
<aside><p>side words side words</aside><footer>foot</footer>"""


def test_pages(spark):
    rows = [(1, "u", PAGE), (2, None, None), (None, "u", ""), (4, "u", "plain words"), (4, "u", "plain words"), (5, "u", "<p>torn <b"), (6, "u", "<p>" + "long text " * 50_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {(r.page_id, r.text) for r in html_main.main_text(df).collect()}
    article = "Head & line\nOne two three four.\nFive six seven eight\nitem one\nitem two"
    assert got == {(1, article), (2, ""), (None, ""), (4, "plain words"), (5, "torn"), (6, ("long text " * 50_000).strip())}
    assert html_main.main_text(df.limit(0)).count() == 0


def test_articles_of_the_table(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in html_main.main_text(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        text = "\n".join(b for b in blocks if b)
        assert got[r.page_id] == (text, len(text))


class Flat(html_main.Weights):
    """Scoring off: every word counts one, tags nothing."""

    def score(self, token):
        return float(len(token[0].split())) if token[1] == "w" else 0.0

    def factor(self, around):
        return 1.0


def test_scoring_finds_the_article_where_no_tag_marks_it(spark, monkeypatch):
    import re

    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    train, rest = pages[:25], pages[25:]
    bare = [re.sub("</?article>", "", p) for p in rest]
    want = [html_main.extract(p, html_main.fit(train)) for p in rest]
    monkeypatch.setattr(html_main, "SELDOM_CLASSES", set())
    monkeypatch.setattr(html_main, "SELDOM_ELEMENTS", set())
    assert [html_main.extract(p, html_main.Weights()) for p in bare] != want
    monkeypatch.undo()
    monkeypatch.setattr(html_main, "SELDOM_CLASSES", set())
    assert [html_main.extract(p, html_main.fit(train)) for p in bare] == want
    assert not any(a == b for a, b in zip([html_main.extract(p, Flat()) for p in bare], want, strict=True))


def test_classes_inside_articles(spark):
    page = (
        "<div class='notice'>we use cookies here</div><article><h1>Head</h1><p class='notice'>mind the gap</p><div class='related-work'><p>others did this before us</p></div>"
        "<section class='social'><p>people meet</p></section><aside>side words</aside><p>the end</p></article><div class='comments'><p>nice post nice post nice post</p></div>"
    )
    text = "Head\nmind the gap\nothers did this before us\npeople meet\nthe end"
    for weights in (html_main.Weights(), html_main.fit([page])):
        assert html_main.extract(page, weights) == text
        assert html_main.extract(page.replace("article>", "div>"), weights) == text
    assert html_main.fit([page.replace("related-work", "sidebar")] * 30).factor((".sidebar",)) > 0


def test_equal_runs_give_the_first():
    assert html_main.best_run([1.0, -1.0, 1.0]) == (0, 1) and html_main.best_run([0.0, 2.0, 0.0, -3.0, 2.0]) == (1, 2) and html_main.best_run([]) == (0, 0)
    scores = [random.Random(k).choice([-2.0, -1.0, 0.0, 1.0, 2.0]) for k in range(300)]
    for lo in range(0, 280, 7):
        part = scores[lo : lo + 20]
        found = html_main.best_run(part)
        assert sum(part[slice(*found)]) == max(sum(part[i:j]) for i in range(20) for j in range(i, 21))


def test_rare_labelled_pages_are_sampled(spark, monkeypatch):
    plain, hidden = "<div><p>some words <i>and</i> others</p></div>", "<script>x = '<main>'</script><!-- <article> --><p>words</p>"
    rows = [(k, "u", f"{hidden if k % 2 else plain}{k}") for k in range(3000)]
    rows += [(5000 + k, "u", f"<div><p>side {k}</p></div><MAIN class='x'><p>the words of page {k}</p></main>") for k in range(3)]
    seen = []
    fit = html_main.fit
    monkeypatch.setattr(html_main, "fit", lambda pages: seen.extend(pages) or fit(pages))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html_main.main_text(df, sample_pages=40).filter("page_id >= 5000 AND text LIKE 'the words of page%'").count() == 3
    assert len(seen) == 3 and all("<MAIN" in p for p in seen)


# --- sharding ----------------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [False, True])
def test_shards(spark, hot):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, None), (7001, None), (7002, ""), (7003, "ä"), (7003, "ä")], "doc_id long, text string")
    docs = docs.unionByName(odd).withColumn("bin", F.lit(0)).withColumn("group", F.lit("g"))
    if hot:
        docs = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.lit("the same text " * 50)).otherwise(F.col("text")))
    rows = sharding.shard(docs, shards=6).collect()
    texts = docs.select("doc_id", "text").collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((t.doc_id, len((t.text or "").encode()) + 8, zlib.crc32((t.text or "").encode())) for t in texts)
    slots, size = defaultdict(list), Counter()
    for r in rows:
        slots[r["shard"]].append(r.slot)
        size[r["shard"]] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(6))
    assert max(size.values()) - min(size.values()) < 0.05 * sum(size.values()) / 6


def test_groups_stay_together(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 100).alias("text"))
    shards = defaultdict(set)
    for r in sharding.shard(docs, shards=4).collect():
        shards[r.text_crc32].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


@pytest.mark.parametrize("bins", [6, 4096])
def test_packing_equals_brute_force(spark, bins):
    rnd = random.Random(9)
    texts = [" ".join("w" * rnd.randint(1, 9) for _ in range(3 * k + 1)) for k in range(90)]
    docs = [(n, texts[k]) for n, k in enumerate(k for k in range(90) for _ in range(1 + k % 4))]
    rnd.shuffle(docs)
    shards = 5
    groups = [[(len(t.encode()) + 8) * n, len(t.split()) * n, n] for t, n in Counter(t for _, t in docs).items()]
    names = list(Counter(t for _, t in docs))
    total = [sum(g[k] for g in groups) for k in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    digest = {r.text: (r.a, r.b) for r in df.select("text", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")).collect()}

    def greedy(chosen, room, unit, out):
        for g in sorted(chosen, key=lambda g: (-max(groups[g][k] / unit[k] for k in range(3)), digest[names[g]])):
            need = [groups[g][k] / unit[k] for k in range(3)]
            fit = [4 * need[0] * r[0] + need[1] * r[1] + need[2] * r[2] for r in room]
            at = fit.index(max(fit))
            room[at] = [a - b for a, b in zip(room[at], need, strict=True)]
            out[names[g]] = at

    heavy = [g for g in range(len(groups)) if groups[g][0] * bins > total[0] or groups[g][2] * bins > total[2]]
    light = [g for g in range(len(groups)) if g not in heavy]
    want, room = {}, [[1.0] * 3 for _ in range(shards)]
    greedy(heavy, room, [t / shards for t in total], want)
    left = [sum(max(r[k], 0.0) for r in room) or 1.0 for k in range(3)]
    room = [[max(r[k], 0.0) / left[k] * shards for k in range(3)] for r in room]
    greedy(light, room, [sum(groups[g][k] for g in light) / shards or 1.0 for k in range(3)], want)
    text = dict(docs)
    got = sharding.shard(df, shards=shards, bins=bins).collect()
    assert len(got) == len(docs) and all(r["shard"] == want[text[r.doc_id]] for r in got)


def test_shards_in_several_parts(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("t"), F.col("id") % 1000), 1 + F.col("id").cast("int") % 5).alias("text"))
    rows = sharding.shard(docs, shards=7, bins=400, part_groups=150).collect()
    shards, slots, size = defaultdict(set), defaultdict(list), Counter()
    for r in rows:
        shards[r.text_crc32, r.size].add(r["shard"])
        slots[r["shard"]].append(r.slot)
        size[r["shard"]] += r.size
    assert all(len(s) == 1 for s in shards.values()) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) < 1.02 * min(size.values())


def test_shards_of_nothing(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- quality and mixing ------------------------------------------------------------------------


def corpus(spark):
    rnd = random.Random(3)
    bodies = [" ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(40)) for _ in range(41)]
    line, body = "this line is on every page of the host", bodies[40]
    rows = [(k, f"{line}\n{bodies[k]} {k}", "h") for k in range(40)]
    rows += [(100 + k, f"{line} {k}\nfew words {'x' * k}", "h") for k in range(3)]
    rows += [(200, "\n".join([line] * 6) + "\nshort rest", "h"), (201, None, None), (202, "", "h"), (203, "a b c d e f g h " * 4, "h"), (None, body, None), (None, body, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit(-1))


def test_boilerplate_goes_and_depleted_documents_with_it(spark):
    got = {r.doc_id: r for r in quality.judge(corpus(spark)).collect() if r.doc_id is not None}
    assert all(got[k].kept and got[k].n_removed_lines == 1 for k in range(40))
    assert got[200].n_removed_lines == 6 and not got[200].kept and got[200].n_repeat_words == 54
    assert got[201].base_failed and got[202].base_failed and got[203].n_repeat_words == 32 and got[203].base_failed


def test_clean_keeps_columns_and_texts(spark):
    docs = corpus(spark)
    left = quality.clean(docs)
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert set(texts) == {None, *range(40)} and all("every page" not in (t or "") for t in texts.values())
    assert left.filter("doc_id IS NULL").count() == 2
    assert quality.clean(docs.limit(0)).count() == 0 and quality.judge(docs.limit(0)).count() == 0


def test_a_number_of_texts_suffices_in_a_large_source(spark):
    line, words = "subscribe to our newsletter for more of this", F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(30)), lambda k: F.substring(F.sha1(F.concat_ws("-", "id", k)), 1, 6)))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 120, F.concat(F.lit(line + "\n"), words)).otherwise(words).alias("text"), F.lit("hot").alias("source"))
    kept = corpus_pipeline.quality_rules(spark, docs, SF)
    assert kept.count() == 3000 and kept.filter(F.contains("text", F.lit(line))).count() == 0
    assert quality.judge(docs, enough=120).filter("n_removed_lines > 0").count() == 0
    assert quality.judge(docs).filter("n_removed_lines > 0").count() == 0  # 4 %: the rule of the SQL


def test_poisson_numbers(spark):
    n, rates = 4000, (0.3, 2.0, 900.0, 250_000.0)
    known = mixing.distributions(spark.createDataFrame([(str(r), r) for r in rates], "__source string, __rate double"))
    drawn = spark.range(n).withColumn("u", mixing.uniform(F.col("id"))).crossJoin(known)
    got = drawn.groupBy("__source").agg(*[f(mixing.poisson(F.col("__least"), F.col("__below"), F.col("u"))) for f in (F.avg, F.var_samp)]).collect()
    assert len(got) == 4
    for rate, mean, spread in got:
        assert abs(mean - float(rate)) < 5 * (float(rate) / n) ** 0.5 and abs(spread / float(rate) - 1) < 0.15


@pytest.mark.parametrize("most", [100_000, 0])
def test_mixture_equals_brute_force(spark, most, monkeypatch):
    import hashlib
    import math

    monkeypatch.setattr(mixing, "MOST_SOURCES", most)
    rows = [(k, f"t{k}", "abc"[(k % 7) // 3]) for k in range(700)] + [(3, "t3", "a"), (None, None, None), (None, None, None), (901, "word " * 50_000, "c")]
    n = Counter(s for *_, s in rows)
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    want: Counter = Counter()
    for i, t, s in rows:
        rate, u, k = len(rows) / 4 / n[s], int(md5(f"17|{'~' if i is None else i}|{md5(t or '')}")[:13], 16) / 2**52, 0
        term = below = math.exp(-rate)
        while below <= u:
            k += 1
            term *= rate / k
            below += term
        want.update((i, t, s, c) for c in range(k))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).select("doc_id", "text", "source", "copy")
    assert Counter(map(tuple, got.collect())) == want
    assert got._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1


def test_mixture_meets_weights(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 2 == 0, "small").alias("source"), F.lit(9).alias("copy"))
    rows = mixing.mix(docs, {"big": 1, "small": 2, None: 1}).groupBy("source").count().collect()
    share = {r.source: r["count"] / 6000 for r in rows}
    assert abs(share["small"] - 0.5) < 0.05 and abs(share["big"] - 0.25) < 0.05 and abs(share[None] - 0.25) < 0.05
    assert mixing.mix(docs, {"big": 1}).filter("source IS NULL OR source <> 'big'").count() == 0
    assert mixing.mix(docs, {}).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs).columns == [*docs.columns, "copy__mix", "shuffle_key"]


# --- pipeline ----------------------------------------------------------------------------------


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "mixing", "encoding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdict = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    kept = corpus_pipeline.quality_rules(spark, docs, SF)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} == {k for k, v in verdict.items() if v}
    left = corpus_pipeline.near_duplicates(spark, kept, SF)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {k[0] for k in brute_components(rows, 5) if k[3]}
    mixed = corpus_pipeline.mix_sources(spark, left, SF)
    assert mixed.columns == docs.columns
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in mixed.collect()) and all(r.round_trip and len(r.ids) == r.n_tokens for r in out)


def test_pipeline_with_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "word " * 3 + " ".join(f"v{k}" for k in range(40)), None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    for d, left in ((docs, [2]), (docs.limit(0), [])):
        for name, stage in corpus_pipeline.STAGES:
            d = stage(spark, d, SF)
            if name in ("quality_rules", "near_duplicates"):
                assert [r.doc_id for r in d.collect()] == left, name
        assert {r.doc_id for r in d.collect()} <= set(left) and all(r.round_trip for r in d.collect())
