"""Text operators against brute force and the libraries, with nulls, empty and long texts, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillview.llm import common, license_scan, pretokens, sentencepiece_codec, token_counts, token_records
from tests.conftest import SF

ODD = [
    (None, "a b"), (900001, None), (900002, ""), (900003, " \n "), (900004, "word " * 30_000), (900004, "word " * 30_000), (900005, "x<|endoftext|>y don't İſK é é ☃"),
    (900006, "cc by  CC-BY mit license\x00nul \x1c q"), (900007, "▁▁ a▁b　c d"), (900008, "the" * 3000),
]


@pytest.fixture(scope="module")
def docs(spark):
    some = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    # Columns that clash with names the operators use inside.
    return some.unionByName(odd).withColumn("ids", F.lit("?")).withColumn("id", F.lit(1)).withColumn("n_tokens", F.lit(0))


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def test_codec_equals_library(rows):
    import sentencepiece

    path = sentencepiece_codec.default_model()
    sp, codec = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_codec.MergeCodec(path)
    rnd = random.Random(4)
    made = ["".join(rnd.choice("aab bcde \n\t▁éüß漢ｱ😀\x00{};\r=(.,th ") for _ in range(rnd.randint(0, 50))) for _ in range(1500)]
    for t in made + [t for _, t in rows[:80]]:
        ids = sp.encode(t)
        assert codec.encode(t) == ids
        assert codec.decode(ids) == sp.decode(ids)


def test_digests(docs, rows):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.default_model())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for i, t in rows:
        ids = sp.encode(t) + [sp.eos_id()]
        want[i, len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))] += 1
    assert Counter(map(tuple, sentencepiece_codec.digest_texts(docs, sentencepiece_codec.default_model()).collect())) == want


def test_encode_then_decode(docs, rows):
    path = sentencepiece_codec.default_model()
    plain = Counter((i, t.replace("▁", " ")) for i, t in rows)  # the mark itself decodes to a space
    encoded = sentencepiece_codec.encode_texts(docs, path)
    assert Counter((r.doc_id, r.decoded) for r in encoded.collect()) == plain
    assert Counter((r.doc_id, r.decoded) for r in sentencepiece_codec.decode_ids(encoded, path).collect()) == plain


def test_words_alone_encode_like_texts(rows):
    p = pretokens.load(token_counts.default_tokenizer())
    rnd = random.Random(3)
    made = ["".join(rnd.choice("abcEÉßÿÀ.,!'_-<|>$1é́İſK \t\x1c　") for _ in range(rnd.randint(1, 12))) for _ in range(3000)]
    for t in made + [t for _, t in rows[:50]]:
        assert [i for w in p.pretokens(t) for i in p.ids(w)] == p.tok.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts(docs, rows, name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    else:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        count = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    few = docs.filter("doc_id IS NULL OR doc_id < 40 OR doc_id > 900000")
    known = {t: count(t) for i, t in rows if i is None or i < 40 or i > 900000}
    want = Counter((i, len(t.encode()), known[t]) for i, t in rows if t in known and (i is None or i < 40 or i > 900000))
    assert Counter(map(tuple, token_counts.count_tokens(few, path).collect())) == want


def test_records_come_back(spark, docs, rows):
    from tokenizers import Tokenizer

    path = token_counts.default_tokenizer()
    tok = Tokenizer.from_file(path)
    manifest = token_records.write_records(docs, common.new_path(spark, "test"), path, end_id=2, shards=3)
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = tok.encode(t, add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, token_records.read_records(manifest, digest=True, read_bytes=1 << 16).collect()), key=lambda r: r[1])
    assert got == want
    one = manifest.orderBy("shard").first()
    found = token_records.read_at(one.path, [1, 0])
    assert [len(ids) for _, ids in found] == [want[1][2], want[0][2]]


def test_records_notice_damage(tmp_path):
    import io

    good = token_records.frame(b"abc") + token_records.frame(b"")
    assert [s for _, s in token_records.frames(io.BytesIO(good).read, 5)] == [b"abc", b""]
    for bad in (good[:-1], good[:13] + b"x" + good[14:], b"\x01" + good[1:]):
        with pytest.raises(ValueError):
            list(token_records.frames(io.BytesIO(bad).read, 5))


def test_licences(docs, rows):
    def brute(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        hits, labels = [], set()
        for phrase, label in license_scan.PHRASES.items():
            p = phrase.split()
            found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
            hits += found
            labels |= {label} if found else set()
        return len(w), len(hits), min(hits, default=None), max(hits, default=None), ",".join(sorted(labels))

    got = license_scan.scan_licenses(docs).collect()
    assert Counter(tuple(r)[:6] for r in got) == Counter((i, *brute(t)) for i, t in rows)
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_licence_templates():
    s = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES, 3, 0.8)
    mit = license_scan.TEMPLATES["mit-text"]
    assert "mit-text" in s.scan(f"before {mit} after".encode())[5]
    broken = mit.split()
    broken[20] = "other"
    assert "mit-text" in s.scan(" ".join(broken).encode())[5]
    assert "mit-text" not in s.scan(" ".join(broken[:20]).encode())[5]


def test_whole_licences():
    s = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES, 3, 0.8)
    labels = lambda text: {x for x in s.scan(text.encode())[5] if x.endswith(("-notice", "-whole-text"))}
    for name in ("gpl", "lgpl", "agpl"):
        for thing in ("program", "library"):
            notice = license_scan.TEMPLATES[f"{name}-notice"].replace("program", thing)
            assert labels(f"x {notice}; either version 3 of the License") == {f"{name}-notice"}
    for name in license_scan.WHOLE:
        text = license_scan.TEMPLATES[f"{name}-whole-text"]
        assert {x for x in labels(f"my page\n{text}\nthe end") if "whole" in x} == {f"{name}-whole-text"}
        w = text.split()
        worn = " ".join("xx" if k % 40 == 20 else x for k, x in enumerate(w))
        assert {x for x in labels(worn) if "whole" in x} == {f"{name}-whole-text"}
        assert f"{name}-whole-text" not in labels(" ".join(w[: len(w) // 2]))


def test_names_and_nested_templates():
    s = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES, 3, 0.8)
    own = lambda text: s.scan(text.encode())[5]
    assert own("under CC BY-NC-SA 4.0 only") == ["cc-by", "cc-by-nc-sa-4.0"] and own("the GNU General Public License, version 2") == ["gpl", "gpl-2.0"]
    assert own("the GNU General Public License, version x") == ["gpl"] and own("Creative Commons Attribution-NoDerivatives 3.0") == ["cc-by-nd-3.0"]
    two = license_scan.Scanner({}, {"long": "x y z w v", "short": "y z w"}, 3, 0.8)
    assert two.scan(b"a x y z w v b")[5] == ["long", "short"]
    assert two.scan(b"a x y z w v b")[7] == [(1, 6, 5, "long"), (2, 5, 3, "short")]


def test_covered_words_equal_brute_force():
    rnd = random.Random(21)
    for _ in range(150):
        templates = {str(k): " ".join(rnd.choice("abcd") for _ in range(rnd.randint(3, 25))) for k in range(4)}
        text = " ".join(rnd.choice("abcde") for _ in range(60))
        s = license_scan.Scanner({}, templates, 3, 0.8)
        w, want = text.split(), {}
        for t, template in enumerate(templates.values()):
            x, found = template.split(), []
            for j in range(len(w)):
                for i in range(len(x)):
                    n = 0
                    while j + n < len(w) and i + n < len(x) and w[j + n] == x[i + n]:
                        n += 1
                    if n >= 3 and not (i and j and w[j - 1] == x[i - 1]):
                        found.append((j, i, n))
            best: list[int] = []
            for k, (j, i, n) in enumerate(sorted(found)):
                before = [best[m] for m, (a, b, c) in enumerate(sorted(found)[:k]) if a + c <= j and b + c <= i]
                best.append(n + max(before, default=0))
            if found:
                want[t] = max(best)
        ids = [s.vocabulary.get(x.encode(), -1) for x in w]
        runs, state, length = [], 0, 0
        for i, word in enumerate([*ids, -1]):
            before = length
            state, length = s.machine.step(state, length, word) if word >= 0 else (0, 0)
            if before >= 3 and length <= before:
                runs.append((i - before, before))
        assert {t: sum(n for _, n in c) for t, c in s.chains(ids, runs).items()} == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.scan_licenses(none).count() == 0
    assert token_counts.count_tokens(none, token_counts.default_tokenizer()).count() == 0
    assert sentencepiece_codec.digest_texts(none, sentencepiece_codec.default_model()).count() == 0
    manifest = token_records.write_records(none, common.new_path(spark, "none"), token_counts.default_tokenizer(), 2)
    assert token_records.read_records(manifest).count() == 0
