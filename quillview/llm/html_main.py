"""Main text of web pages as the maximum-scoring run of a page's words and tags.

A page is read once as a row of tokens, texts and tags. Words score positive and tags negative, and one
linear scan finds the contiguous run with the highest sum, the content region; of runs that score the
same the first and shortest is taken. ``article`` and ``main`` tags are no tokens: they label the pages
of a bounded sample, on which the weights are fitted, and the scan never sees them.

* What an element says about the words in it, by its name (menus, footers, asides, page headers) or its
  class, id or role: the log-odds, at most 0, of words in such elements to stand in the labelled part. A
  word's reward is multiplied by one plus the least of these for the elements around it, so words score
  negative where labelled pages have words that are no content.
* A tag's penalty is the log-odds of meeting it outside the labelled part, counted where no element
  around it is against content already: a list in a menu says nothing about lists.
* A word's reward is the log-odds of meeting a word of its kind (linked or plain) inside, counted there too.
* Penalties are then moved until the scan finds the labelled part of the sampled pages, with a margin.

The names of elements and classes below are only where fitting starts from (as if ``PRIOR`` words had
been seen outside): labelled pages that have content in such elements overrule them. Classes count on
sections, lists and ``div``, not on paragraphs, headings and inline elements, and by their parts
(``cookie-notice``). Words that score negative are left out of the region's text. Elements that hold no
running text (forms, scripts, styles, media) are not read.

Text is cut into blocks at block-level tags; character references are decoded, white space in a block
becomes one space, blocks are trimmed and joined by one line end, empty ones left out.

Defined results: a null or empty page, or one without words, gives an empty text. Markup may be torn
or unclosed anywhere. Without labelled pages the starting weights hold. Null ids and urls pass through,
repeated rows give repeated results, order does not matter, an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Elements that hold no running text, elements and class words that are seldom content.
RAW = "script|style|noscript|textarea|title|iframe|noembed|noframes|template|xmp"
UNREAD_ELEMENTS = set("head form button select option svg object embed audio video canvas map applet datalist label input".split())
SELDOM_ELEMENTS = set("nav footer aside menu dialog header".split())
SELDOM_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
SELDOM_CLASSES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted cookie cookies consent gdpr notice notices "
    "popup modal newsletter subscribe signup sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar "
    "comment comments commentlist disqus pagination pager paywall".split()
)
#: Words outside that count as seen for each of these.
PRIOR = 50
#: The least that elements say: words among them score a little below nothing, so they neither make a region nor cut one.
LEAST_SAID = -1.1
#: The least penalty of a tag; a step, the most rounds and the margin when penalties are moved.
LIGHTEST, STEP, ROUNDS, MARGIN = -0.05, 0.5, 20, 3.0
#: Elements whose class, id and role are read.
CLASSED = set("div section aside ul ol dl table form nav header footer details figure blockquote center td".split())
BLOCK = set(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
ITEMS = set("p li tr td th dt dd option".split())
LABELS = ("article", "main")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^<>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


def _says(name: str, rest: str, in_main: bool) -> list[str]:
    """What an element says about the words in it: its name, and ``.word`` or ``@word`` for its classes, id and roles."""
    # A header in an article is that of the article.
    found = [name] if name in SELDOM_ELEMENTS and not (name == "header" and in_main) else []
    if rest and name in CLASSED:
        for kind, a, b, c in _ATTRIBUTE.findall(rest):
            mark = "@" if kind.lower() == "role" else "."
            found += [mark + x for x in _SPLIT.split((a or b or c).lower()) if x]
    return found


# For Spark: a tag that labels a page, and what holds no tags.
LABEL = r"(?i)<(?:article|main)(?=[\s/>])"
UNREAD = rf"(?is)<!--.*?(?:-->|\z)|<({RAW})(?=[\s/>]).*?(?:</\1\s*>|\z)"

Around = tuple[str, ...]
Token = tuple[str, str, bool, bool, Around]  # text or tag name, kind ("w" words, "t" tag), linked, in main, what the elements around say


def tokens(page: str) -> list[Token]:
    """Texts and tags of a page, without ``article`` and ``main`` tags and without elements that are not read."""
    out: list[Token] = []
    stack: list[tuple[str, Around]] = []
    around: Around = ()
    unread = 0  # height of the stack at which an element that is not read began, or 0
    main = links = 0
    at = 0

    def pop(height: int) -> None:
        nonlocal main, links, unread, around
        while len(stack) > height:
            name, around = stack.pop()
            main -= name in LABELS
            links -= name == "a"
        if unread > len(stack):
            unread = 0

    for m in _TOKEN.finditer(page):
        if m.start() > at and not unread:
            out.append((page[at : m.start()], "w", links > 0, main > 0, around))
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            if not unread and name not in LABELS:
                out.append(("/" + name, "t", False, main > 0, around))
            held = [x for x, _ in stack]
            if name in held:
                height = len(held) - 1 - held[::-1].index(name)
                # An end tag does not reach out of the block that it stands in.
                if name in BLOCK or not any(x in BLOCK for x in held[height + 1 :]):
                    was = unread
                    pop(height)
                    if was and not unread or name in LABELS:
                        out.append((name, "d", False, main > 0, around))
            continue
        if name in ITEMS or name in BLOCK:
            # An open paragraph ends before any block, an open item before the next of its kind.
            for k in range(len(stack) - 1, max(unread, 0) - 1, -1):
                if stack[k][0] == "p" or stack[k][0] == name and name in ITEMS:
                    pop(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        rest = m["rest"] or ""
        before = around
        if name not in VOID and not rest.endswith("/"):
            says = _says(name, rest, main > 0)
            stack.append((name, around))
            main += name in LABELS
            links += name == "a"
            if not unread:
                if says:
                    around = (*around, *(x for x in says if x not in around))
                if name in UNREAD_ELEMENTS:
                    unread = len(stack)
                    out.append((name, "d", False, main > 0, before))
                    continue
        if not unread:
            out.append((name, "d" if name in LABELS else "t", False, main > 0, around))
    if at < len(page) and not unread:
        out.append((page[at:], "w", links > 0, main > 0, around))
    return out


def _seldom(said: str) -> bool:
    return said in SELDOM_ELEMENTS or said[:1] == "." and said[1:] in SELDOM_CLASSES or said[:1] == "@" and said[1:] in SELDOM_ROLES


class Weights:
    """Scores of words and tags; without labelled pages the starting values."""

    def __init__(self, pages: list[str] = ()) -> None:
        read = [t for t in map(tokens, pages) if any(x[3] for x in t)]
        inside: Counter = Counter()
        outside: Counter = Counter()
        for text, kind, _, main, around in (x for t in read for x in t):
            if kind == "w":
                (inside if main else outside).update(dict.fromkeys(around, len(text.split())))
        self.said: dict[str, float] = {}
        for said in {*inside, *outside}:
            odds = (inside[said] + 1) / (outside[said] + (PRIOR if _seldom(said) else 1))
            self.said[said] = max(LEAST_SAID, min(0.0, math.log(odds)))
        self._factors: dict[Around, float] = {}
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for text, kind, linked, main, around in (x for t in read for x in t):
            if self.factor(around) > 0 or main:
                if kind == "w":
                    seen[main]["linked words" if linked else "words"] += len(text.split())
                elif kind == "t":
                    seen[main][text.lstrip("/")] += 1
            elif kind == "t" and text in SELDOM_ELEMENTS:
                seen[main][text] += 1
        odds = lambda k: (seen[True][k] + 1) / (seen[False][k] + 1)
        self.reward = {k: min(4.0, max(0.2, math.log1p(odds(k)))) for k in ("words", "linked words")}
        self.penalty = {k: min(LIGHTEST, math.log(odds(k))) for k in {*seen[0], *seen[1]} - {*self.reward}}
        self.sharpen(read)

    def sharpen(self, read: list[list[Token]]) -> None:
        """Move penalties until the run on each labelled page is its labelled part, by a perceptron's rule;
        words outside count ``MARGIN`` times here, so that longer texts there stay out as well."""
        for _ in range(ROUNDS):
            wrong = False
            for found in read:
                scores = [s * MARGIN if s > 0 and not x[3] else s for s, x in zip(map(self.score, found), found, strict=True)]
                lo, hi = best_run(scores)
                off = {i for i, x in enumerate(found) if (lo <= i < hi) != x[3]}
                if any(scores[i] > 0 for i in off):
                    wrong = True
                    for i in off:
                        text, kind, _, main, _ = found[i]
                        if kind == "t":
                            tag = text.lstrip("/")
                            self.penalty[tag] = min(LIGHTEST, self.penalty.get(tag, LIGHTEST) + (STEP if main else -STEP))
            if not wrong:
                return

    def score(self, token: Token) -> float:
        text, kind, linked, _, around = token
        if kind == "w":
            return len(text.split()) * self.reward["linked words" if linked else "words"] * self.factor(around)
        return self.penalty.get(text.lstrip("/"), LIGHTEST) if kind == "t" else 0.0

    def factor(self, around: Around) -> float:
        """One plus the least that the elements around say."""
        found = self._factors.get(around)
        if found is None:
            known = lambda x: self.said.get(x, math.log(1 / PRIOR) if _seldom(x) else 0.0)
            found = self._factors[around] = 1.0 + max(LEAST_SAID, min(map(known, around), default=0.0))
        return found


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run with the highest sum, by one scan; the first and shortest of equal ones."""
    best = total = 0.0
    lo = hi = start = 0
    for i, score in enumerate(scores):
        total += score
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, lo, hi = total, start, i + 1
    return lo, hi


def fit(pages: list[str]) -> Weights:
    return Weights(pages)


def extract(page: str, weights: Weights) -> str:
    found = tokens(page)
    lo, hi = best_run(list(map(weights.score, found)))
    blocks: list[str] = []
    part: list[str] = []
    for text, kind, _, _, around in found[lo:hi]:
        if kind == "w":
            if weights.factor(around) > 0:
                part.append(text)
        elif text.lstrip("/") in BLOCK:
            blocks.append("".join(part))
            part = []
        elif text == "br":
            part.append(" ")
    blocks.append("".join(part))
    clean = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def main_text(
    pages: DataFrame,
    html_column: str = "html",
    carry: tuple[str, ...] = ("page_id", "url"),
    sample_pages: int = 400,
    sample_chars: int = 200_000,
) -> DataFrame:
    """``carry`` columns, ``text`` and ``n_chars`` of every page.

    ``sample_pages``: the bound of the sample that the weights are fitted on, taken by a hash of the page
    from the pages with an ``article`` or ``main`` tag, however rare they are; ``sample_chars``: only pages up
    to this length are in it, so that it is bounded in bytes too.
    """
    page = pages[html_column].cast("string")
    labelled = pages.select(page.alias("html")).filter(F.length("html") <= sample_chars).filter(F.rlike("html", F.lit(LABEL)) & F.rlike(F.regexp_replace("html", UNREAD, " "), F.lit(LABEL)))
    # Only about four times the sample passes the hash, however many pages and partitions there are.
    part = min(1.0, 4.0 * sample_pages / max(1, labelled.count()))
    place = F.pmod(F.xxhash64("html"), F.lit(1 << 30))
    some = labelled.filter(place <= int(part * (1 << 30)))
    sample = some.orderBy(F.xxhash64("html")).limit(sample_pages)
    weights = fit([r.html for r in sample.collect()])  # at most sample_pages rows of sample_chars

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(p, weights) if p else "" for p in batch.column(batch.num_columns - 1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[*carry, "text", "n_chars"]
        )

    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in carry)
    return common.map_rows(pages.select(*carry, page.alias("__html")), one, f"{kinds}, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(common.table(spark, sf_dir, "pages"))
