"""Main text of web pages by a tree-structured graphical model.

Block elements are the nodes of a tree, each either content or not. A logistic model of markup and text features
gives every node its own potential, counts of labelled parents and children give the potential of an edge, and
sum-product messages, first up and then down the tree, give the marginal of content for every node. Both are
trained on labelled pages: the small set below, and pages of the input whose own markup names the article.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import slices

#: most pages of the input that take part in the training
TRAIN_PAGES = 300

BLOCKS = frozenset((
    "html body div p article section main nav header footer aside ul ol li dl dt dd h1 h2 h3 h4 h5 h6 table thead tbody tfoot tr td th caption form "
    "fieldset blockquote pre figure figcaption details summary address dialog center hgroup menu search").split())
#: elements whose content is no text; only the first two run to the end of the page where their end tag is missing
SKIPPED = "script style noscript template title svg math iframe object select textarea button canvas video audio datalist".split()
RAW = frozenset(SKIPPED[:2])
END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in SKIPPED}
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
WALLS = frozenset("ul ol dl table".split())
#: a quote of an attribute is one that ends before a blank or the end of the tag; where none does, the tag ends at the first >
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]{0,4096}"(?=[\s/>])|'[^']{0,4096}'(?=[\s/>]))*+(?=>)|[^>]*)>|<[!?][^>]*>""", re.S | re.I)
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
LABEL = re.compile(r'data-y="([01])"')
HINTS = {
    "ad": r"(^|[^a-z])(ads?|advert\w*|sponsor\w*|promo\w*|banner)([^a-z]|$)", "menu": r"nav|menu|breadcrumb|pagination|pager|skip|toc",
    "foot": r"foot|copyright|legal|imprint", "head": r"(^|[^a-z])(site-?|page-?|top-?)?head(er)?([^a-z]|$)|masthead|topbar|logo",
    "side": r"side|widget|rail|related|recommend|popular|trending|tag-?cloud|(^|[^a-z])(more|read-next)([^a-z]|$)", "talk": r"comment|disqus|repl(y|ies)|respond|discussion|reader",
    "notice": r"cookie|consent|notice|gdpr|alert|popup|modal|overlay|privacy|paywall", "form": r"form|subscri|newsletter|login|signup|search|register",
    "share": r"share|social|follow|byline-?links|toolbar|tools", "body": r"article|content|post|entry|story|main|body|text|prose|markdown"}
ASIDE = ("nav", "aside", "form", "footer", "dialog", "search")
APART = frozenset(("ad", "talk", "notice", "share", "form", "side", "menu", "foot", "head"))
HINT = {k: re.compile(v) for k, v in HINTS.items()}


class Node(NamedTuple):
    tag: str
    parent: int
    hints: frozenset
    label: int | None  # of labelled pages


class Page(NamedTuple):
    nodes: list[Node]
    spans: list[tuple[int, str]]  # node and text of every block, in page order
    chars: list[int]
    linked: list[int]


def parse(source: str) -> Page:
    """Block elements and the text between their boundaries; markup that does not nest is closed like a browser would."""
    nodes, chars, linked = [Node("body", -1, frozenset(), None)], [0], [0]
    stack, spans, words, link = [0], [], [], False
    opened: Counter[str] = Counter()
    endless: set[str] = set()

    def flush() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            spans.append((stack[-1], text))
            chars[stack[-1]] += len(text)

    def add(raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        words.append(text)
        if link:
            linked[stack[-1]] += len(text.strip())

    def close(k: int) -> None:
        opened.subtract(nodes[i].tag for i in stack[k:])
        del stack[k:]

    at = 0
    while m := TOKEN.search(source, at):
        if m.start() > at:
            add(source[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in BLOCKS:
            if tag in END:
                if m[1] or tag in endless or m[3].endswith("/") and tag not in RAW:
                    continue
                if (end := END[tag].search(source, at)) is not None:
                    at = end.end()
                elif tag in RAW:
                    at = len(source)
                else:
                    endless.add(tag)
            elif tag == "a":
                link = not m[1]
            elif tag in ("br", "hr", "img", "input", "wbr"):
                words.append(" " if tag != "wbr" else "")
            continue
        flush()
        link = False
        if m[1]:
            if opened[tag]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if nodes[stack[k]].tag == tag))
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES:
            for k in range(len(stack) - 1, 0, -1) if any(opened[t] for t in CLOSES[tag]) else ():
                if nodes[stack[k]].tag in CLOSES[tag]:
                    close(k)
                    break
                if nodes[stack[k]].tag in WALLS:
                    break
        elif nodes[stack[-1]].tag == "p":
            close(len(stack) - 1)
        attrs = m[3]
        hints = frozenset()
        if attrs and "=" in attrs:
            named = " ".join(next(filter(None, g), "") for g in NAMED.findall(attrs)).lower()
            if named:
                hints = frozenset(k for k, r in HINT.items() if r.search(named))
                if "body" in hints:
                    hints -= {"head"}  # the head of an entry belongs to it
        y = LABEL.search(attrs) if attrs else None
        nodes.append(Node(tag, stack[-1], hints, int(y[1]) if y else None))
        chars.append(0)
        linked.append(0)
        stack.append(len(nodes) - 1)
        opened[tag] += 1
    if at < len(source):
        add(source[at:])
    flush()
    return Page(nodes, spans, chars, linked)


def features(page: Page) -> list[list[str]]:
    """Names of the features that hold for each node."""
    n = len(page.nodes)
    total, links, dots = list(page.chars), list(page.linked), [0] * n
    for k, text in page.spans:
        dots[k] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
    marks = list(dots)
    for k in range(n - 1, 0, -1):
        p = page.nodes[k].parent
        total[p] += total[k]
        links[p] += links[k]
        marks[p] += marks[k]
    inside, under = [False] * n, [False] * n
    out = []
    for k, node in enumerate(page.nodes):
        if k:
            up = page.nodes[node.parent]
            under[k] = under[node.parent] or up.tag in ASIDE or not up.hints.isdisjoint(APART)
            inside[k] = not under[k] and (inside[node.parent] or up.tag in ("article", "main") or "body" in up.hints)
        f = ["bias", f"tag={node.tag}", "long" if total[k] >= 80 else "short"]
        f += [f"hint={h}" for h in node.hints]
        share = links[k] / total[k] if total[k] else 0.0
        f.append("links=most" if share > 0.6 else "links=some" if share > 0.2 else "links=few")
        if marks[k] > total[k] / 120 and total[k] > 40:
            f.append("sentences")
        if inside[k]:
            f += ["inside", f"inside:{node.tag}"]
        if under[k]:
            f.append("under")
        elif node.hints.isdisjoint(APART) and node.tag not in ASIDE:
            f += ["clear", "clear:" + f[2]]
            if "sentences" in f:
                f.append("clear:sentences")
        out.append(f)
    return out


class Model(NamedTuple):
    weight: dict[str, float]
    edge: list[list[float]]  # log potential of (parent label, child label)


LABELLED = [
    # Pages labelled by hand; data-y holds for an element and all below it until it is overridden.
    '<div data-y="0"><header class="site-header"><a href="/">Home</a></header><nav><ul><li><a>News</a></li><li><a>Sport</a></li></ul></nav></div>'
    '<main data-y="1"><article><h1>Bridge reopens</h1><p>The old bridge opened again on Monday, after two years of work.</p><p>Crowds came early, and stayed.</p>'
    '<div class="ad" data-y="0">Buy now.</div><div class="share" data-y="0"><a>Share this</a></div></article></main>'
    '<aside class="sidebar" data-y="0"><h3>Popular</h3><ul><li><a>One story</a></li></ul><p>Some words about us, and more.</p></aside><footer data-y="0">&copy; 2020 Paper. All rights reserved.</footer>',
    '<div class="cookie-notice" data-y="0"><p>We use cookies, as everybody does. Accept them to go on.</p></div><div id="menu" data-y="0"><a>Start</a> <a>About</a></div>'
    '<div id="content" data-y="1"><h2>Soup</h2><p>Cut the onions, then wait.</p><ul><li>Two onions, red.</li><li>Salt.</li></ul><table><tr><td>Time</td><td>One hour.</td></tr></table></div>'
    '<div class="comments" data-y="0"><h3>Comments</h3><div class="comment"><p>Nice soup, I made it twice, and it was good.</p></div><form><p>Leave a reply.</p></form></div><div class="footer" data-y="0"><p>Contact us.</p></div>',
    '<header data-y="0"><h1>Site name</h1><p>A slogan, of course.</p></header><article data-y="1"><header><h1>On walking</h1></header><p>We walked along the river, and talked about nothing.</p>'
    '<blockquote><p>Nothing is best.</p></blockquote><figure><figcaption>The river, seen from the east.</figcaption></figure><section><h2>Later</h2><p>It rained. We turned back, wet and happy.</p></section>'
    '<nav data-y="0"><a>Previous</a></nav><footer data-y="0"><p>Filed under travel.</p></footer><section class="comments" data-y="0"><p>I walked there too, last year. Lovely place.</p></section>'
    '<form data-y="0"><p>Subscribe to our letter, weekly.</p></form></article><footer data-y="0"><p>Imprint, privacy.</p></footer>',
    '<div class="page"><div class="topbar" data-y="0"><a>Log in</a></div><div data-y="1"><p>This page has no article element, but it has a long paragraph, with commas, and it goes on for a while so that it looks like prose.</p>'
    '<p>And it has another paragraph, which also has sentences. They end like this.</p></div><div class="newsletter" data-y="0"><p>Sign up, it is free.</p></div><div class="related-posts" data-y="0"><p><a>Another page, about other things.</a></p></div></div>',
    '<div class="popup" data-y="0"><p>Please turn off your blocker, we need it.</p></div><nav data-y="0"><p>Menu</p></nav><section class="post" data-y="1"><h1>Short</h1><p>Yes.</p><p>No.</p><pre>x = 1</pre></section>'
    '<section id="disqus_thread" data-y="0"><ul><li><p>First, as always. Thanks for the text, I liked it.</p></li></ul></section><aside data-y="0"><p>Read more in our shop, open daily.</p></aside>'
    '<dialog data-y="0"><p>Close this, please.</p></dialog><search data-y="0"><form><p>Find</p></form></search>',
]


def _labels(page: Page) -> list[int | None]:
    out: list[int | None] = []
    for node in page.nodes:
        up = out[node.parent] if node.parent >= 0 else None
        out.append(node.label if node.label is not None else up)
    return out


def _named_article(page: Page) -> list[int | None] | None:
    """Labels from the page's own markup, if it has exactly one article or main element."""
    tops = [k for k, n in enumerate(page.nodes) if n.tag in ("article", "main") and all(page.nodes[p].tag not in ("article", "main") for p in _above(page, k))]
    if len(tops) != 1:
        return None
    out: list[int | None] = []
    for k, n in enumerate(page.nodes):
        up = out[n.parent] if n.parent >= 0 else None
        other = n.tag in ASIDE or not n.hints.isdisjoint(APART)
        out.append(0 if other else 1 if k == tops[0] else up if up is not None else None if k == 0 else 0)
    return out


def _above(page: Page, k: int) -> Iterator[int]:
    k = page.nodes[k].parent
    while k >= 0:
        yield k
        k = page.nodes[k].parent


def _stretched(page: Page) -> Page:
    """A labelled page with long notices and short content, so that length alone does not decide."""
    y = _labels(page)
    spans = [(k, text[:30] if y[k] else " ".join([text] * (1 + 200 // len(text)))) for k, text in page.spans]
    chars = [0] * len(page.nodes)
    for k, text in spans:
        chars[k] += len(text)
    return page._replace(spans=spans, chars=chars, linked=[0] * len(chars))


def train(pages: list[str], *, rounds: int = 800) -> Model:
    """Logistic regression for the nodes, smoothed counts for the edges. Hand-labelled pages weigh as much as all others."""
    rows, ys, ws = [], [], []
    counts = np.full((2, 2), 4.0)
    by_hand = [parse(s) for s in LABELLED]
    by_hand += [_stretched(p) for p in by_hand]
    own = [p for s in pages if (p := parse(s)) and _named_article(p)]
    for page in by_hand + own:
        hand = any(n.label is not None for n in page.nodes)
        y = _labels(page) if hand else _named_article(page)
        w = 1.0 if hand else 0.1 * len(by_hand) / max(len(own), 1)
        for k, f in enumerate(features(page)):
            if y[k] is None:
                continue
            rows.append(f)
            ys.append(y[k])
            ws.append(w)
            p = page.nodes[k].parent
            if p >= 0 and y[p] is not None:
                counts[y[p], y[k]] += w
    names = sorted({n for f in rows for n in f})
    at = {n: k for k, n in enumerate(names)}
    row = np.repeat(np.arange(len(rows)), [len(f) for f in rows])
    col = np.array([at[n] for f in rows for n in f])
    y, w = np.array(ys, float), np.array(ws)
    weight, m, v = np.zeros(len(names)), np.zeros(len(names)), np.zeros(len(names))
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.bincount(row, weight[col], len(y))))
        g = np.bincount(col, ((p - y) * w)[row], len(names)) / w.sum() + 1e-4 * weight
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        weight = weight - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    share = counts / counts.sum(axis=1, keepdims=True)
    base = counts.sum(axis=0) / counts.sum()
    return Model(dict(zip(names, weight.tolist())), np.log(share / base).tolist())


def marginals(page: Page, model: Model) -> list[float]:
    """Content marginal of every node by sum-product: messages from the leaves to the root, then back."""
    get, e = model.weight.get, model.edge
    n = len(page.nodes)
    score = [sum([get(f, 0.0) for f in fs]) for fs in features(page)]
    up = [[0.0, s] for s in score]      # own potential and the messages of the children
    sent = [(0.0, 0.0)] * n
    add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
    for k in range(n - 1, 0, -1):
        a, b = up[k]
        sent[k] = (add(e[0][0] + a, e[0][1] + b), add(e[1][0] + a, e[1][1] + b))
        p = up[page.nodes[k].parent]
        p[0] += sent[k][0]
        p[1] += sent[k][1]
    full = [up[0]] + [[0.0, 0.0]] * (n - 1)
    for k in range(1, n):
        p = full[page.nodes[k].parent]
        a, b = p[0] - sent[k][0], p[1] - sent[k][1]
        full[k] = [up[k][0] + add(a + e[0][0], b + e[1][0]), up[k][1] + add(a + e[0][1], b + e[1][1])]
    return [1 / (1 + math.exp(min(700.0, max(-700.0, a - b)))) for a, b in full]


def main_text(source: str, model: Model) -> str:
    page = parse(source)
    keep = marginals(page, model)
    return "\n".join(text for k, text in page.spans if keep[k] >= 0.5)


def extract(pages: DataFrame, *, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row: blocks of content in page order, joined by line breaks.

    A null or empty page gives an empty text; rows that repeat give equal results; an empty table gives none, and a
    table without usable pages leaves the hand-labelled ones to train on. Pages are read whole.
    """
    sample = pages.filter(F.length("html") < 200_000).select("page_id", "html").orderBy(F.xxhash64("page_id", F.lit(61)), "page_id").limit(train_pages)
    model = train([r["html"] for r in sample.toLocalIterator()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                text = [main_text(s, model) if s else "" for s in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
