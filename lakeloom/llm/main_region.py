"""Main text of web pages by the maximum-scoring subsequence.

A page is read once into a sequence of words and tags. Words score by where they stand, tags
always below zero; the weights are counted over all pages that mark their article themselves. The
contiguous stretch of the largest sum, found in one pass, is the content; blocks in it that a menu,
advert, form, comment or the like holds are left out, all others are kept whole.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.shared import col, settle

# --- fixed values: names of HTML elements by their role -------------------------------------
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p
    pre section summary table tbody td tfoot th thead tr ul""".split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template iframe noscript noembed noframes xmp svg math".split())
HIDDEN = frozenset("head select option datalist button object audio video canvas map".split())
BOILERPLATE = frozenset("nav footer aside form dialog menu fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: words of class and id that name what does not belong to an article
CLASSES = frozenset(
    """ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion
    banner cookie cookies consent gdpr notice notices notification popup modal overlay newsletter
    subscribe subscription signup login register share sharing social related recommended
    recommendations sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments
    commentlist comments-area disqus respond replies widget widgets search pagination pager toolbar masthead
    copyright form skip""".split()
)
#: an element of these, inside another of the same, ends that one
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: what ends a paragraph that is open
ENDS_PARAGRAPH = BLOCKS - {"body", "html"}
ARTICLES = frozenset("article main".split())
# --------------------------------------------------------------------------------------------

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[a-z]+")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: words outside a marked article, and within one
OUTSIDE, WITHIN = -2.0, 3.0
#: words of boilerplate
BOILED = -0.3
#: a tag whose weight is not known; the least that a tag and a word can weigh
TAG, LEAST_TAG, LEAST_WORD = -0.2, -0.5, 0.1
#: a feature must have been seen so often to have a weight
SEEN = 30
MOST_FEATURES = 5000


@dataclass
class Element:
    name: str
    article: bool
    boiled: bool
    hidden: bool
    link: bool
    features: tuple[str, ...]


@dataclass
class Block:
    """Text between two block tags."""

    text: str
    words: int
    article: bool
    boiled: bool
    features: tuple[str, ...]


@dataclass
class Page:
    events: list[str | Block] = field(default_factory=list)
    article: bool = False


_TOP = Element("", False, False, False, False, ())


def _marks(name: str, attributes: str, within: Element) -> tuple[bool, bool, tuple[str, ...]]:
    """(boilerplate, hidden, words of class and id) of a tag."""
    boiled = name in BOILERPLATE or (name == "header" and not within.article)
    hidden = name in HIDDEN
    words: set[str] = set()
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true"):
                hidden = True
            elif key == "style":
                hidden = hidden or bool(_HIDDEN_STYLE.search(value))
            elif key == "role":
                boiled = boiled or value in ROLES
            else:
                words.update(_NAME.findall(value))
    if name not in ("html", "body"):
        boiled = boiled or not words.isdisjoint(CLASSES) or ("header" in words and not within.article)
    return boiled, hidden, tuple(f"class {w}" for w in sorted(words))


def read_page(source: str | None) -> Page:
    """The page's tags (``name`` and ``/name``) and text blocks in order."""
    source = source or ""
    page = Page()
    stack = [_TOP]
    parts: list[str] = []
    linked = total = 0
    block_at = _TOP

    def close_block() -> None:
        nonlocal linked, total
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                at = block_at
                features = at.features + (("linked",) if 2 * linked > total else ())
                page.events.append(Block(text, text.count(" ") + 1, at.article, at.boiled, features))
        linked = total = 0

    def add(text: str) -> None:
        nonlocal linked, total, block_at
        top = stack[-1]
        if top.hidden:
            return
        if not parts:
            block_at = top
        elif top.boiled != block_at.boiled and text.strip():
            close_block()  # a phrase of boilerplate within a block stands alone
            block_at = top
        parts.append(text)
        total += len(text)
        linked += len(text) * top.link

    def pop_to(depth: int) -> None:
        del stack[depth:]

    at, end = 0, len(source)
    while at < end:
        found = _TAG.search(source, at)
        if not found:
            add(source[at:])
            break
        if found.start() > at:
            add(source[at : found.start()])
        at = found.end()
        name = found[2] or found[5]
        if not name:
            continue
        closing = bool(found[1] or found[4])
        name = name.lower()
        if name in RAW and not closing:
            finish = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
            at = finish.end() if finish else end
            if name in BLOCKS or name == "noscript":
                close_block()
            continue
        if name in RAW:
            continue
        if name == "br":
            add(" ")
            continue
        if name in BLOCKS:
            close_block()
        page.events.append(f"/{name}" if closing else name)
        if closing:
            inline = name not in BLOCKS or name == "p"
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    pop_to(depth)
                    break
                if inline and stack[depth].name in BLOCKS and stack[depth].name != "p":
                    break
            continue
        if name == "body":
            stack = [e for e in stack if e.name != "head"]
        if name in ENDS_PARAGRAPH or name in CLOSES:
            ended = CLOSES.get(name, set()) | ({"p"} if name in ENDS_PARAGRAPH else set())
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name in ended:
                    pop_to(depth)
                    break
                if stack[depth].name in BLOCKS:
                    break
        if name in VOID:
            continue
        within = stack[-1]
        boiled, hidden, words = _marks(name, found[3] or found[6] or "", within)
        features = within.features
        if name in BLOCKS:
            features = tuple(f for f in features if not f.startswith("in "))
            if name not in ARTICLES:
                features += (f"in {name}",)
                if name in BOILERPLATE or name in ("header", "section"):
                    features += (f"under {name}",)
        features = tuple(dict.fromkeys(features + words))
        article = within.article or (name in ARTICLES and not boiled)
        page.article = page.article or article
        stack.append(
            Element(
                name, article, within.boiled or boiled, within.hidden or hidden, within.link or name == "a", features
            )
        )
        if len(stack) > 2000:  # tags that nobody closes
            del stack[1:1000]
    close_block()
    return page


def observed(page: Page) -> tuple[Counter, Counter]:
    """Words and tags by feature, inside and outside the article that the page marks."""
    inside: Counter = Counter()
    outside: Counter = Counter()
    deep = 0
    for event in page.events:
        if isinstance(event, Block):
            to = inside if event.article and not event.boiled else outside
            for feature in event.features:
                to[feature] += event.words
        elif event in ARTICLES:
            deep += 1
        elif event[0] == "/" and event[1:] in ARTICLES:
            deep = max(0, deep - 1)
        else:
            (inside if deep else outside)[f"tag {event}"] += 1
    return inside, outside


def main_text(page: Page, weights: Mapping[str, float]) -> str:
    """Blocks of the best contiguous stretch, without those that boilerplate holds."""
    best = total = 0.0
    begin, span = 0, (0, 0)
    for i, event in enumerate(page.events):
        if isinstance(event, Block):
            known = [weights[f] for f in event.features if f in weights]
            score = max(LEAST_WORD, 1.0 + (sum(known) / len(known) if known else 0.0))
            if event.boiled:
                score = BOILED
            elif page.article:
                score += WITHIN if event.article else OUTSIDE
            total += score * event.words
        else:
            total += min(-0.05, weights.get(f"tag {event}", TAG))
        if total <= 0:
            total, begin = 0.0, i + 1
        elif total > best:
            best, span = total, (begin, i + 1)
    kept = page.events[span[0] : span[1]]
    return "\n".join(e.text for e in kept if isinstance(e, Block) and not e.boiled)


def learn(pages: DataFrame, html_column: str = "html") -> dict[str, float]:
    """Weights of the features of words and tags, counted over all pages that mark an article.

    A weight is the log of how much more often a feature is seen inside than outside, at most 1
    either way; a tag's is below zero. The driver gets ``MOST_FEATURES`` numbers at most.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside: Counter = Counter()
        outside: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                page = read_page(text.as_py())
                if page.article:
                    a, b = observed(page)
                    inside.update(a)
                    outside.update(b)
            if len(inside) + len(outside) > 100_000:  # class names that never end
                yield _counts(inside, outside)
                inside.clear(), outside.clear()
        yield _counts(inside, outside)

    schema = "feature string, inside long, outside long"
    counts = settle(
        pages.select(col(html_column).cast("string").alias("html"))
        .mapInArrow(counted, schema)
        .groupBy("feature")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")),
        "features",
    )
    is_tag = F.col("feature").startswith("tag ")
    totals = {r[0]: (r[1] + 1, r[2] + 1) for r in counts.groupBy(is_tag).agg(F.sum("inside"), F.sum("outside")).collect()}
    often = counts.filter(F.col("inside") + F.col("outside") >= SEEN)
    found = often.orderBy(F.desc(F.col("inside") + F.col("outside")), "feature").limit(MOST_FEATURES).collect()
    weights = {}
    for feature, a, b in found:
        all_in, all_out = totals[feature.startswith("tag ")]
        odds = max(-1.0, min(1.0, math.log((a + 1) / all_in) - math.log((b + 1) / all_out)))
        weights[feature] = min(-0.05, max(LEAST_TAG, odds)) if feature.startswith("tag ") else odds
    return weights


def _counts(inside: Counter, outside: Counter) -> pa.RecordBatch:
    names = list(inside.keys() | outside.keys())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.string()),
            pa.array([inside[n] for n in names], pa.int64()),
            pa.array([outside[n] for n in names], pa.int64()),
        ],
        names=["feature", "inside", "outside"],
    )


def extract(
    pages: DataFrame,
    weights: Mapping[str, float] | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row.

    Weights are learned from ``pages`` unless given; without pages that mark an article every
    word counts the same. Null and empty html, and pages without words, give an empty text.
    Repeated rows stay repeated; an empty table gives none.
    """
    weights = learn(pages, html_column) if weights is None else dict(weights)

    @F.pandas_udf("string")
    def text_of(sources):
        import pandas as pd

        return pd.Series([main_text(read_page(s), weights) for s in sources], dtype=object)

    return pages.select(
        col(page_id).alias("page_id"), col(url).alias("url"), text_of(col(html_column).cast("string")).alias("text")
    ).withColumn("n_chars", F.char_length("text").cast("long"))
