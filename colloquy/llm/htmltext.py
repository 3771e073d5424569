"""Main text of web pages by maximum-scoring subsequence.

A page is read as a sequence of words and tags. Words score positive and tags negative; one linear scan finds the
contiguous run with the largest sum, which is where the article is. The weights are log-odds learned from
labelled pages: pages whose markup states the article (an ``article`` or ``main`` element), counted over the
whole table. Text of elements that are never article text (menus, adverts, forms, ...) scores nothing and is left out.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import record_batches

# Element names of the HTML standard.
RAW = ("script", "style", "noscript", "template", "textarea", "select", "svg", "math", "iframe", "object", "audio", "video", "canvas", "title")
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
INLINE = frozenset(
    ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr")
)
KNOWN = INLINE | VOID | frozenset(
    ("address", "article", "aside", "blockquote", "body", "button", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul")
)
# Elements, roles and class or id words of what is not article text.
NEVER = frozenset(("head", "nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset"))
ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form", "menu", "menubar"))
MARKED = frozenset(
    ("ad", "ads", "adbox", "adsense", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "promotion", "related", "replies", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget")
)
MODIFIERS = frozenset(("has", "no", "with", "without", "not", "hide", "hides"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(" + "|".join(RAW) + r")\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?][^>]*+>"
    r"|<[!?/a-zA-Z][^<]*+\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def _names(value: str) -> list[list[str]]:
    """The words of each class or id name; names that say what an element has, lacks or goes with are left out."""
    found = [_SPLIT.split(name) for name in value.split()]
    return [words for words in found if MODIFIERS.isdisjoint(words)]


def _left_out(name: str, attributes: str, in_article: bool) -> str:
    """"never" for what is no article text by its element or role, "marked" by its class or id, else ""."""
    if name in NEVER or (name == "header" and not in_article):
        return "never"
    marked = ""
    for key, *value in _ATTRIBUTE.findall(attributes) if attributes else ():
        value = "".join(value).lower()
        if key.lower() == "role":
            if value in ROLES:
                return "never"
        elif name not in ("html", "body", "article", "main") and any(not MARKED.isdisjoint(words) for words in _names(value)):
            marked = "marked"
    return marked


def read_page(page: str) -> list[tuple[str, str, int, int]]:
    """The page as units (feature, text, block, article): a tag has text None; text left out has none at all.

    A word's feature is ``words:`` and its innermost block element; article numbers the enclosing article or main
    element, 0 if there is none. A marked element is left out unless the page has no article and it holds more than half of the words.
    """
    units, stack, open_ = [], [("", False, (), 0, "")], Counter()
    block = articles = marks = 0
    within: Counter = Counter()  # words by marked element
    under: dict[int, tuple[int, ...]] = {}  # marked elements around a unit
    total = 0

    def text(raw: str) -> None:
        nonlocal total
        _, never, around, article, holder = stack[-1]
        if never or not raw:
            return
        raw = entities.unescape(raw) if "&" in raw else raw
        n = len(raw.split())
        total += n
        if around:
            under[len(units)] = around
            for mark in around:
                within[mark] += n
        units.append((f"words:{holder}", raw, block, article))

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        name = m[3] or m[6]
        if not name:
            if m[1]:
                units.append(("raw", None, block, stack[-1][3]))
            continue
        name, closing = name.lower(), bool(m[2] or m[5])
        if name not in INLINE:
            block += 1
        _, never, around, article, holder = stack[-1]
        units.append((name if name in KNOWN else "other", None, block, article))
        if closing:
            if open_[name]:
                while stack[-1][0] != name:
                    open_[stack.pop()[0]] -= 1
                open_[stack.pop()[0]] -= 1
        elif name not in VOID:
            if name == "p" and stack[-1][0] == "p":
                open_[stack.pop()[0]] -= 1
            if name in ("article", "main") and not open_["article"] and not article:
                if not _left_out(name, m[4] or m[7], True):
                    articles += 1
                    article, never, around = articles, False, ()
            left_out = _left_out(name, m[4] or m[7], bool(article))
            if left_out == "marked":
                marks += 1
                around = (*around, marks)
            stack.append((name, never or left_out == "never", around, article, holder if name in INLINE else name if name in KNOWN else "other"))
            open_[name] += 1
    if at < len(page):
        text(page[at:])
    gone = {i for i, around in under.items() if articles or any(2 * within[mark] <= total for mark in around)}
    return [u for i, u in enumerate(units) if i not in gone] if gone else units


def counts(page: str) -> Counter:
    """(feature, inside) counts of a labelled page, words by the word; a page without an article says nothing."""
    out: Counter = Counter()
    units = read_page(page)
    if any(u[3] for u in units):
        for feature, text, _, article in units:
            if feature not in ("article", "main"):
                out[feature, bool(article)] += 1 if text is None else len(text.split())
    return out


def learn(rows: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Weights by feature: log-odds of being inside an article, kept positive for words and negative for tags."""
    weights = {}
    for words in (True, False):
        part = {k: n for k, n in rows.items() if k[0].startswith("words:") == words}
        inside, outside = (1 + sum(n for (_, i), n in part.items() if i == side) for side in (True, False))
        for f in {f for f, _ in part}:
            odds = log((part.get((f, True), 0) + 1) / inside) - log((part.get((f, False), 0) + 1) / outside)
            weights[f] = max(0.1, odds) if words else min(-0.02, odds)
    return weights


def best_run(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run with the largest positive sum, the earliest if several; (0, 0) if none."""
    best, run, start, found = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, found = run, (start, i + 1)
    return found


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The article: the best run, widened to whole blocks, and to the whole article element that holds it."""
    units = read_page(page or "")
    a, b = best_run([weights.get(f, -0.5) if t is None else weights.get(f, 1.0) * len(t.split()) for f, t, _, _ in units])
    if a == b:
        return ""
    words = [i for i in range(a, b) if units[i][1] is not None and units[i][1].strip()]
    inside: Counter = Counter()
    for i in words:
        inside[units[i][3]] += len(units[i][1].split())
    article = max(inside, key=inside.get)
    first, last = units[words[0]][2], units[words[-1]][2]
    blocks: dict[int, list[str]] = {}
    for _, text, block, own in units:
        if text is not None and (own == article if article else first <= block <= last):
            blocks.setdefault(block, []).append(text)
    done = (_SPACE.sub(" ", "".join(parts)).strip(" ") for parts in blocks.values())
    return " ".join(t for t in done if t)


def page_weights(pages: DataFrame) -> dict[str, float]:
    """Weights from the labelled pages of the whole table; only counts per known feature reach the driver."""
    schema = pa.schema([("feature", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())])

    def run(batches):
        for b in batches:
            total: Counter = Counter()
            for page in b.column(0):
                total += counts(page.as_py() or "")
            yield from record_batches(((f, i, n) for (f, i), n in total.items()), schema)

    got = pages.select(F.col("html").cast("string")).mapInArrow(run, "feature string, inside boolean, n long").groupBy("feature", "inside").agg(F.sum("n").alias("n"))
    return learn({(r.feature, r.inside): r.n for r in got.collect()})


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(page_id, url, text) per row of ``pages``; weights are learned from ``pages`` unless given.

    Character references are decoded, white space within a block becomes one space, blocks are joined in page
    order by one space. Null or empty html, and pages without words, give an empty text; unclosed elements
    end with the page; repeated rows are extracted alike; without a labelled page, words weigh 1 and tags -0.5. Extra
    columns are ignored.
    """
    weights = page_weights(pages) if weights is None else weights
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches):
        def rows():
            for b in batches:
                for page_id, url, page in zip(b.column(0), b.column(1), b.column(2), strict=True):
                    yield page_id.as_py(), url.as_py(), main_text(page.as_py(), weights)

        yield from record_batches(rows(), schema, 512)

    columns = [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")]
    return pages.select(*columns).mapInArrow(run, "page_id long, url string, text string")
