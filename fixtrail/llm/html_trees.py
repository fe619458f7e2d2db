"""Main text of web pages: gradient-boosted trees over DOM nodes with hierarchical decoding.

A page is parsed in one pass into block elements and the runs of text between block
boundaries; both are nodes. Each node gets features of itself (tag, attribute tokens, depth), of
its subtree (text, tags, density, share of linked text, punctuation), of its siblings and of
its ancestors. Boosted trees give the chance that the subtree holds main text. Decoding then
finds the most likely labelling in which no node below a rejected one is accepted: a node is
accepted only together with all its ancestors. The text is the accepted runs, in page order.

The trees are fitted here on at most about ``SAMPLE`` pages of at most ``SAMPLE_CHARS`` characters,
chosen by a hash of page_id. Their labels come from markup that tells what it is (article and main against
nav, aside, footer, forms and the like), once as found and once rewritten: semantic tags become
plain ones with a class, and pieces of boilerplate are added, so that the trees also learn from
tokens, density and place. All pages are then read whole.

Null or empty pages have an empty text. Repeated rows get equal texts. Unclosed and stray tags are
accepted. Without pages to learn from, the fitting pages are the built-in pattern alone.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 300
SAMPLE_CHARS = 100_000
TREES = 40
DEPTH = 3
BINS = 24

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
_PART = re.compile(r"[A-Za-z][a-z]+|[A-Z]+")
# Fixed values of HTML: which elements hold no text of the page, no content at all, or stay inside a line.
_DROPPED = frozenset("script style template svg head title textarea select button iframe".split())
_RAW = frozenset("script style textarea title iframe".split())
_CODE = frozenset("script style".split())
# What may stand in a head; any other start tag or text ends it.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noscript script style template title".split())
_IN_SELECT = frozenset("option optgroup hr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_FENCE = frozenset("article aside body div footer form header html main nav ol section table td th ul".split())
_GOOD = frozenset("article body content entry main post story text".split())
_BAD = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie copyright disqus foot footer "
    "form gdpr head header login masthead menu modal nav navbar navigation newsletter notice pagination popup promo "
    "related reply search share shares sharing sidebar signup social sponsor sponsored subscribe teaser toolbar widget".split()
)
_GOOD_TAGS = frozenset("article main".split())
_BAD_TAGS = frozenset("nav aside footer form menu header dialog".split())
_KINDS = ("#run", "p", "div", "section", "li", "ul", "td", "h1", "h2", "blockquote", "pre")
_KIND = {k: i for i, k in enumerate(_KINDS)} | {"ol": 5, "th": 6, "h3": 8, "h4": 8, "h5": 8, "h6": 8}
FEATURES = (
    "run", "p", "div", "section", "item", "list", "cell", "title", "heading", "quote", "pre",
    "good_tag", "bad_tag", "depth", "chars", "tags", "density", "linked", "good_tokens", "bad_tokens",
    "good_above", "bad_above", "place", "siblings", "share_of_parent", "marks", "words", "runs_below", "position", "long_siblings",
)


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    good: int
    bad: int
    good_above: float
    bad_above: float
    place: int
    start: int  # characters of text before it
    text: str = ""
    chars: int = 0
    linked: int = 0
    marks: int = 0
    words: int = 0
    tags: int = 0
    runs: int = 0
    children: int = 0
    long_children: int = 0


def _tokens(attributes: str) -> set[str]:
    found = " ".join(a or b or c for a, b, c in _ATTRIBUTE.findall(attributes))
    return {x.lower() for x in _PART.findall(found)} if found else set()


def _ends_skip(skipped: str, tag: str, inside: list[str]) -> bool:
    """Whether a start tag shows that a skipped element wasn't closed."""
    if skipped == "head":
        return tag not in _IN_HEAD
    if skipped == "select":
        return tag not in _IN_SELECT
    if skipped == "button":
        return tag in _CLOSES_P and tag != "div" or tag in ("html", "body")
    return skipped == "svg" and tag in _CLOSES_P and "foreignobject" not in inside


def parse(page: str | None) -> list[Node]:
    """Nodes in page order; a parent comes before its children."""
    page = page or ""
    nodes = [Node("#root", -1, 0, 0, 0, 0.0, 0.0, 0, 0)]
    stack = [0]  # open block elements
    names = ["#root"]
    pieces: list[str] = []
    links, linked, at, total, inner_tags = 0, 0, 0, 0, 0
    skip: str | None = None
    skip_depth = 0
    inside: list[str] = []  # block elements opened within the skipped one

    def add(tag: str, good: int, bad: int) -> int:
        up = nodes[stack[-1]]
        node = Node(
            tag, stack[-1], up.depth + 1, good, bad,
            up.good_above + up.good + (up.tag in _GOOD_TAGS), up.bad_above + up.bad + (up.tag in _BAD_TAGS), up.children, total,
        )
        up.children += 1
        nodes.append(node)
        return len(nodes) - 1

    def flush() -> None:
        nonlocal linked, total, inner_tags
        if pieces:
            raw = "".join(pieces)
            pieces.clear()
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                node = nodes[add("#run", 0, 0)]
                node.text, node.chars, node.runs, node.tags = text, len(text), 1, inner_tags
                node.linked = min(linked, len(text))
                node.marks = sum(map(text.count, ".,;:!?"))
                node.words = text.count(" ") + 1
                total += len(text)
        linked, inner_tags = 0, 0

    def close_to(k: int) -> None:
        flush()
        del stack[k:], names[k:]

    def data(a: int, b: int) -> None:
        nonlocal linked
        if skip is None and b > a:
            pieces.append(page[a:b])
            if links:
                linked += b - a

    def past_raw(tag: str, b: int) -> int:
        """Where the content of a raw element ends; without an end tag only code goes on to the end of the page."""
        end = re.compile(rf"</{tag}[^>]*>", re.IGNORECASE).search(page, b)
        return end.end() if end else len(page) if tag in _CODE else b

    for m in _TOKEN.finditer(page):
        a, b = m.span()
        if a < at:
            continue  # inside a raw element
        if skip == "head" and page[at:a].strip():
            skip = None  # text can't stand in a head
        data(at, a)
        at = b
        name = m[2]
        if name is None:
            continue
        tag = name.lower()
        empty = m[3].endswith("/")
        if skip is not None:
            if tag == skip:
                skip_depth += -1 if m[1] else not empty
                if skip_depth == 0:
                    skip = None
                continue
            if m[1] and tag in inside:
                del inside[len(inside) - 1 - inside[::-1].index(tag) :]
                continue
            if not m[1] and tag in _RAW:
                at = past_raw(tag, b)
                continue
            if not (tag in names if m[1] else _ends_skip(skip, tag, inside)):
                if not (m[1] or empty or tag in _VOID or tag in _INLINE):
                    inside.append(tag)
                continue
            skip = None  # an enclosing block closes, or the tag can't stand there
        if tag in _DROPPED:
            if m[1] or empty:
                continue
            if tag not in ("button", "svg", "math"):
                flush()
            if tag in _RAW:
                at = past_raw(tag, b)
            else:
                skip, skip_depth = tag, 1
                inside.clear()
            continue
        if tag == "a":
            links = max(0, links - 1) if m[1] else 1
        if tag == "br":
            pieces.append(" ")
        if tag in _INLINE or tag in _VOID and tag != "hr":
            inner_tags += not m[1]
            continue
        if m[1]:
            if tag in names:
                k = len(names) - 1 - names[::-1].index(tag)
                close_to(k)
            else:
                flush()
            links = 0
            continue
        if tag == "hr":
            flush()
            continue
        if tag in _CLOSES_P or tag in _SAME:
            ends = {"p"} if tag in _CLOSES_P else _SAME[tag]
            for k in range(len(names) - 1, 0, -1):
                if names[k] in ends:
                    close_to(k)
                    break
                if names[k] in _FENCE and not (tag in ("td", "th", "tr") and names[k] in ends):
                    break
        flush()
        links = 0
        if tag in ("html", "body") and tag in names:
            continue
        parts = _tokens(m[3]) if m[3] else set()
        stack.append(add(tag, len(parts & _GOOD), len(parts & _BAD)))
        names.append(tag)
    if skip == "head" and page[at:].strip():
        skip = None
    data(at, len(page))
    flush()
    for node in reversed(nodes):
        if node.parent >= 0:
            up = nodes[node.parent]
            up.chars += node.chars
            up.linked += node.linked
            up.marks += node.marks
            up.words += node.words
            up.tags += node.tags + (node.tag != "#run")
            up.runs += node.runs
            up.long_children += node.chars > 80
    return nodes


def features(nodes: list[Node]) -> np.ndarray:
    total = max(nodes[0].chars, 1)
    rows = []
    for node in nodes:
        kind = [0.0] * len(_KINDS)
        if node.tag in _KIND:
            kind[_KIND[node.tag]] = 1.0
        up = nodes[node.parent] if node.parent >= 0 else node
        chars = max(node.chars, 1)
        rows.append((
            *kind, float(node.tag in _GOOD_TAGS), float(node.tag in _BAD_TAGS), float(node.depth), math.log1p(node.chars),
            math.log1p(node.tags), node.chars / (1 + node.tags), node.linked / chars, node.good, node.bad,
            node.good_above, node.bad_above, node.place, up.children, node.chars / max(up.chars, 1), node.marks / chars,
            math.log1p(node.words), math.log1p(node.runs), node.start / total, up.long_children,
        ))
    return np.array(rows, np.float64)


@dataclass(frozen=True)
class Boosted:
    """Full binary trees of one depth: a feature and a bound per inner node, a value per leaf."""

    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray
    base: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > bound[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out


def fit_boosted(x: np.ndarray, y: np.ndarray, trees: int = TREES, rate: float = 0.25, ridge: float = 1.0) -> Boosted:
    """Logistic boosting on histograms of quantile bins; deterministic."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = math.log(mean / (1 - mean))
    score = np.full(len(x), base)
    inner, size = 2**DEPTH - 1, 2**DEPTH
    all_features, all_bounds, all_leaves = [], [], []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-score))
        slope, bend = y - chance, chance * (1 - chance)
        at = np.zeros(len(x), np.int64)
        feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for node in range(inner):
            mine = np.flatnonzero(at == node)
            best, split = 1e-6, None
            if len(mine):
                g, h = slope[mine], bend[mine]
                whole = g.sum() ** 2 / (h.sum() + ridge)
                for k, e in enumerate(edges):
                    if not len(e):
                        continue
                    left_g = np.bincount(binned[mine, k], g, len(e) + 1).cumsum()[:-1]
                    left_h = np.bincount(binned[mine, k], h, len(e) + 1).cumsum()[:-1]
                    gain = left_g**2 / (left_h + ridge) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + ridge) - whole
                    j = int(gain.argmax())
                    if gain[j] > best:
                        best, split = gain[j], (k, j)
            if split:
                feature[node], bound[node] = split[0], edges[split[0]][split[1]]
                at[mine] = 2 * node + 1 + (binned[mine, split[0]] > split[1])
            else:
                at[mine] = 2 * node + 1
        leaves = at - inner
        leaf = rate * np.bincount(leaves, slope, size) / (np.bincount(leaves, bend, size) + ridge)
        score += leaf[leaves]
        all_features.append(feature)
        all_bounds.append(bound)
        all_leaves.append(leaf)
    return Boosted(np.array(all_features), np.array(all_bounds), np.array(all_leaves), base)


def decode(nodes: list[Node], logit: np.ndarray) -> list[bool]:
    """The likeliest labels in which every accepted node has an accepted parent."""
    yes = -np.logaddexp(0.0, -logit)
    no = -np.logaddexp(0.0, logit)
    accept, reject = yes.tolist(), no.tolist()
    for k in range(len(nodes) - 1, 0, -1):  # children come after their parents
        up = nodes[k].parent
        accept[up] += max(accept[k], reject[k])
        reject[up] += reject[k]
    labels = [True] * len(nodes)
    for k in range(1, len(nodes)):
        labels[k] = labels[nodes[k].parent] and accept[k] >= reject[k]
    return labels


def _truth(nodes: list[Node]) -> np.ndarray | None:
    """Whether a subtree holds main text, where the markup tells; else None."""
    if not any(n.tag in _GOOD_TAGS for n in nodes):
        return None
    y = np.zeros(len(nodes))
    for k, n in enumerate(nodes):
        if n.tag == "#run" and n.good_above and not n.bad_above:
            up, inside = n.parent, False
            while up >= 0:
                inside |= nodes[up].tag in _GOOD_TAGS
                up = nodes[up].parent
            y[k] = float(inside)
    for k in range(len(nodes) - 1, 0, -1):
        y[nodes[k].parent] = max(y[nodes[k].parent], y[k])
    return y


def _disguised(page: str, number: int) -> str:
    """The page with added boilerplate: its shape is that of common site furniture."""
    words = re.sub(r"<[^>]*>", " ", page).split()[:400] or ["text"]
    some = lambda a, n: entities.escape(" ".join(words[(a + k) % len(words)] for k in range(n)))
    before = [
        f'<header class="site-header"><a href="/">{some(number, 2)}</a> {some(number + 7, 6)}</header>',
        f'<div class="cookie-notice"><p>{some(number + 3, 22)}</p><a href="/c">{some(number, 1)}</a></div>',
        f'<div class="top-banner promo"><p>{some(number + 11, 12)}</p></div>',
        f'<ul class="menu">{"".join(f"<li><a href=/m>{some(number + k, 1)}</a></li>" for k in range(6))}</ul>',
    ]
    inside = [
        f'<div class="share social"><a href="/s">{some(number, 2)}</a><a href="/t">{some(number + 2, 2)}</a></div>',
        f'<aside class="ad"><p>{some(number + 5, 15)}</p></aside>',
        f'<form class="newsletter-form"><p>{some(number + 9, 10)}</p><input name="e"></form>',
    ]
    after = [
        f'<section id="comments"><h2>{some(number, 1)}</h2><div class="comment"><p>{some(number + 20, 30)}</p></div>'
        f'<div class="comment"><p>{some(number + 60, 18)}</p></div></section>',
        f'<aside class="sidebar"><h3>{some(number, 2)}</h3><p>{some(number + 30, 25)}</p><ul><li><a href="/r">{some(number, 5)}</a></li></ul></aside>',
        f'<div class="related"><h3>{some(number, 2)}</h3><p><a href="/r">{some(number + 13, 9)}</a></p></div>',
    ]
    out = re.sub(r"<(article|main)\b", before[number % 4] + r"<\1", page, count=1)
    return re.sub(r"</(article|main)>", inside[number % 3] + r"</\1>" + after[number % 3], out, count=1)


_PLAIN = {
    "article": ('<div class="post-content">', "</div>"), "main": ('<div id="main-content">', "</div>"),
    "nav": ('<div class="nav-menu">', "</div>"), "footer": ('<div class="footer">', "</div>"),
    "header": ('<div class="header">', "</div>"), "aside": ('<div class="sidebar">', "</div>"),
}


def _plain(page: str, anonymous: bool) -> str:
    """Semantic tags as plain ones, with a class that tells the same or, for content, none."""
    for tag, (start, end) in _PLAIN.items():
        opening = "<div>" if anonymous and tag in _GOOD_TAGS else start
        page = re.sub(rf"<{tag}\b[^>]*>", opening, page)
        page = page.replace(f"</{tag}>", end)
    return page


_TELLING = re.compile(r"\s(?:class|id|role)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.IGNORECASE)


def _bare(page: str) -> str:
    """The page without semantic tags, classes and ids, so that only text, links, place and shape tell."""
    return _TELLING.sub("", re.sub(rf"<(/?)(?:{'|'.join(_PLAIN)})\b[^>]*>", r"<\1div>", page))


_PATTERN = (
    "<body><nav><ul><li><a href='/'>One</a></li><li><a href='/b'>Two</a></li></ul></nav><article><h1>A heading</h1>"
    "<p>A first paragraph, which is long enough to look like text, and then some more of it.</p>"
    "<p>A second paragraph follows the first one. It has two sentences.</p></article><footer>Imprint, contact</footer></body>"
)


def fit_extractor(pages: list[str]) -> Boosted:
    """Trees from pages whose markup tells content from the rest, and from their rewritten forms."""
    xs, ys = [], []
    for number, page in enumerate(pages or [_PATTERN]):
        forms = [page, _disguised(page, number)]
        for k, form in enumerate(forms):
            nodes = parse(form)
            y = _truth(nodes)
            if y is None:
                continue
            xs.append(features(nodes))
            ys.append(y)
            # the rewriting keeps all nodes in place
            for rewritten in [_plain(form, number % 2 == 0)] * k + [_bare(form)] * (k == 0 and number % 3 == 0):
                nodes = parse(rewritten)
                if len(nodes) == len(y):
                    xs.append(features(nodes))
                    ys.append(y)
    if not xs:
        return fit_extractor([_PATTERN])
    return fit_boosted(np.concatenate(xs), np.concatenate(ys))


def sample_pages(pages: DataFrame, most: int = SAMPLE, chars: int = SAMPLE_CHARS) -> list[str]:
    """A hash sample of pages; its size on the driver is at most ``2 * most * chars``."""
    short = pages.where(F.col("html").isNotNull() & (F.length("html") <= chars))
    total = short.count()
    place = F.pmod(F.xxhash64("page_id"), F.lit(1_000_000)) / 1_000_000
    rows = short.where(place < most / max(total, 1)).select(F.col("html").cast("string").alias("html")).limit(2 * most)
    return sorted({r["html"] for r in rows.collect()})


def extract_text(pages: DataFrame, model: Boosted | None = None) -> DataFrame:
    """page_id, url and text (blocks joined by an empty line) of every page."""
    fitted = fit_extractor(sample_pages(pages)) if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            for start in range(0, len(batch), 64):
                parsed = [parse(x.as_py()) for x in batch["html"].slice(start, 64)]
                scores = fitted.logit(np.concatenate([features(n) for n in parsed]))
                at = 0
                for nodes in parsed:
                    labels = decode(nodes, scores[at : at + len(nodes)])
                    at += len(nodes)
                    texts.append("\n\n".join(n.text for n, kept in zip(nodes, labels, strict=True) if kept and n.text))
            yield pa.record_batch([batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string")
