"""HTML extraction by minimum-cut labelling.

A page is cut into text blocks in page order. A linear classifier gives each block log-odds of content against boilerplate, whose two costs
are the capacities from the source (content) and to the sink (boilerplate). Blocks that follow each other, and blocks of one parent, are
joined by edges that are the stronger the nearer they are in the DOM. The minimum cut, found by maximum flow, is the labelling of least cost;
the blocks on the source's side are the main text.

The classifier is a logistic regression over the elements around a block, the senses of their names (class, id, role), its length, its share
of links, its last mark and a few phrases. It is fitted to FIT_PAGES generated pages with known main texts (layouts.py), the same in every
run, when it is first needed; nothing is learned from the table.

White space of any kind inside a block (after decoding character references) becomes one space, blocks are trimmed and joined by line feeds;
nothing else is dropped or capped. Scripts, styles, templates, titles, frames and the controls of forms have no text; formulas, drawings and
fallback texts are read like other elements. Broken markup is read as browsers do where that is simple: unknown ends are ignored, a quote that
is never closed is none, an open script runs to the page's end, a tag that is never closed is text, `p`, `li`, `dt`, `dd`, `tr`, `td`, `th`
and `option` end their like. Pages are read in linear time.

Rows: each input row gives one output row; a null or empty page has the text ''; a null url stays null; other columns pass through, and one
named like the output is replaced; repeated rows are each read; an empty table stays empty.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter, deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import layouts, spans

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
# Only a quote behind = opens a value.
_ATTRS = re.compile(r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+>""")
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""\bhidden\b|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

RAW = {x: re.compile(f"</{x}(?=[\\s/>])[^>]*>", re.IGNORECASE) for x in ("script", "style", "template", "textarea", "title", "iframe", "select", "button")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("body div section article ul ol dl table tbody thead tfoot main aside nav form blockquote header footer figure".split())

#: Tags that tell something about the blocks in them.
TAGS = ("article", "main", "section", "nav", "footer", "aside", "form", "header", "menu", "dialog", "label", "legend", "fieldset", "figcaption", "address", "p", "blockquote", "pre", "h1", "h2", "h3", "h4", "td", "li", "div")
#: Senses of the words in names. Against content wherever they stand; against it as the last word, which the others describe; for it, likewise.
AGAINST = frozenset("ad ads adv advert advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr popup modal overlay sidebar widget menu nav navbar navigation breadcrumb breadcrumbs footer footnav comment comments reply replies disqus related recommended recommendations newsletter subscribe subscription login signup signin pagination pager toolbar contentinfo complementary masthead".split())
AGAINST_LAST = frozenset("notice share sharing social search copyright legal disclaimer tags skip alert header widgets links teaser teasers".split())
FOR = frozenset("article post entry story".split())
#: Words that say little: the word before them counts.
PLAIN = frozenset("content main body text container wrapper inner outer box area block item list bar section wrap row col column".split())
SENSES = ("against", "for", "plain", "hidden", "title")
_PHRASES = re.compile(r"©|\(c\) ?[12][0-9]{3}|all rights reserved|cookie|subscribe|sign up|log ?in|privacy policy|terms of (?:use|service)|advertisement|read more|share this|tous droits|alle rechte|todos los derechos", re.IGNORECASE)

NEAR, FAR, SIBLING = 0.6, 0.12, 0.25
FIT_PAGES = 400
_TAGS = frozenset(TAGS)


class Block:
    __slots__ = ("around", "linked", "parent", "text", "up")

    def __init__(self, text: str, linked: int, around: frozenset[str], parent: int, up: int):
        self.text, self.linked, self.around, self.parent, self.up = text, linked, around, parent, up


def sense(name: str) -> str | None:
    """against, for or plain, from the words of one class, id or role."""
    words = [w.lower() for w in _PART.findall(name)]
    if any(w in AGAINST for w in words):
        return "against"
    for w in reversed(words):
        if w in AGAINST_LAST:
            return "against"
        if w in FOR:
            return "for"
        if w not in PLAIN:
            return None
    return "plain" if words else None


@lru_cache(maxsize=1 << 16)
def _senses(tag: str, attrs: str) -> frozenset[str]:
    """What an element tells about the blocks in it."""
    out = {tag} & _TAGS
    if attrs:
        found = {sense(x) for m in _NAMES.finditer(attrs) for x in (m[1] or m[2] or m[3] or "").split()}
        out |= {"against"} if "against" in found else {x for x in found if x} if tag not in ("html", "body") else set()
        if _HIDDEN.search(attrs):
            out.add("hidden")
    return frozenset(out)


def blocks(page: str) -> list[Block]:
    """Text blocks in page order."""
    out: list[Block] = []
    # Open elements: tag, what it and those around it tell, number.
    stack: list[tuple[str, frozenset[str], int]] = [("#root", frozenset(), 0)]
    open_tags: dict[str, int] = {}
    parts: list[str] = []
    linked, anchors, number, at = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                top = len(stack) - 1
                while top and stack[top][0] not in BLOCK:
                    top -= 1
                tag, around, own = stack[top]
                parent = stack[top - 1][2] if top else 0
                out.append(Block(text, min(linked, len(text)), around, parent if tag in CLOSES or tag[0] == "h" else own, stack[max(0, top - 2)][2]))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if anchors:
                linked += len(text.strip())

    def pop() -> None:
        nonlocal anchors
        tag, _, _ = stack.pop()
        open_tags[tag] -= 1
        if tag == "a":
            anchors -= 1

    quoted = True
    while True:
        to = page.find("<", at)
        if to < 0:
            add(page[at:])
            break
        add(page[at:to])
        head = page[to + 1 : to + 2]
        if page.startswith("!--", to + 1):
            at = page.find("-->", to + 4) + 3
            if at < 3:
                break
            continue
        close = head == "/"
        name = _NAME.match(page, to + 1 + close)
        if name is None and head not in ("!", "?", "/"):
            parts.append("<")  # no markup
            at = to + 1
            continue
        end = page.find(">", to) + 1
        if not end:  # no tag ends any more
            if name is not None:
                add(page[to:])
            break
        if name is None:
            at = end
            continue
        tag = name[0].lower()
        if close:
            at = end
            if tag in BLOCK:
                flush()
            if open_tags.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        # Where quotes are such that a tag would have no end, they count no more, here and further on.
        m = _ATTRS.match(page, name.end()) if quoted else None
        quoted = m is not None
        at = m.end() if m else max(end, name.end())
        attrs = page[name.end() : at - 1]
        if tag in RAW:
            end = RAW[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                parts.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if tag in CLOSES:
            i = len(stack) - 1
            while i and stack[i][0] not in SCOPE and stack[i][0] not in CLOSES[tag]:
                i -= 1
            if i and stack[i][0] in CLOSES[tag]:
                while len(stack) > i:
                    pop()
        number += 1
        told = (_senses if len(attrs) < 500 else _senses.__wrapped__)(tag, attrs)
        if tag == "header" and not stack[-1][1].isdisjoint(("article", "for")):
            told = told - {"header"} | {"title"}  # an article's own header
        stack.append((tag, stack[-1][1] | told, number))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        if tag == "a":
            anchors += 1
    flush()
    return out


def features(b: Block) -> tuple[float, ...]:
    """What the classifier sees of the block itself."""
    words = b.text.count(" ") + 1
    return 1.0, math.log(words / 8 + 0.2), b.linked / len(b.text), float(b.text[-1] in ".!?:;…»”\"'"), float(words < 30 and bool(_PHRASES.search(b.text)))


class Classifier:
    """Logistic regression: log-odds that a block is content."""

    def __init__(self, own: tuple[float, ...], around: dict[str, float]):
        self.own, self.around = own, around
        self.known: dict[frozenset[str], float] = {}

    def log_odds(self, b: Block) -> float:
        out = self.known.get(b.around)
        if out is None:
            if len(self.known) > 100_000:
                self.known.clear()
            out = self.known[b.around] = sum(self.around.get(x, 0.0) for x in sorted(b.around))
        return max(-8.0, min(8.0, out + sum(w * x for w, x in zip(self.own, features(b), strict=True))))


def fit(labelled: list[tuple[str, list[str]]], l2: float = 1.0, rounds: int = 30) -> Classifier:
    """From pages and the blocks of their main texts, by Newton's method."""
    names = [*TAGS, *SENSES]
    rows, truth = [], []
    for page, content in labelled:
        left = Counter(content)
        for b in blocks(page):
            truth.append(left[b.text] > 0)
            left[b.text] -= 1
            rows.append([*features(b), *(float(x in b.around) for x in names)])
    x, y = np.array(rows), np.array(truth, float)
    w = np.zeros(x.shape[1])
    pull = np.full(len(w), l2)
    pull[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (p - y) + pull * w)
    n = len(w) - len(names)
    return Classifier(tuple(w[:n].tolist()), dict(zip(names, w[n:].tolist(), strict=True)))


@lru_cache(maxsize=1)
def classifier() -> Classifier:
    """The one that the extraction uses."""
    return fit(layouts.pages(FIT_PAGES, seed=1))


def minimum_cut(content: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each node whether it lies on the source's side. content: log-odds; edges: (node, node, capacity of both directions).

    Dinic's algorithm. Flow straight from source over a node to sink is taken first, so one terminal edge of each node remains.
    """
    n = len(content)
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[float] = []

    def join(u: int, v: int, c: float, back: float) -> None:
        head[u].append(len(to))
        to.append(v)
        cap.append(c)
        head[v].append(len(to))
        to.append(u)
        cap.append(back)

    for v, x in enumerate(content):  # costs ln(1 + e^-x) and ln(1 + e^x) differ by x
        if x > 0:
            join(s, v, x, 0.0)
        elif x < 0:
            join(v, t, -x, 0.0)
    for u, v, c in edges:
        if u != v and c > 0:
            join(u, v, c, c)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in head[u]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[v] >= 0 for v in range(n)]
        nxt = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                least = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= least
                    cap[e ^ 1] += least
                k = next(i for i, e in enumerate(path) if cap[e] <= tiny)
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while nxt[u] < len(head[u]):
                e = head[u][nxt[u]]
                if cap[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                nxt[u] += 1
            if nxt[u] < len(head[u]):
                path.append(head[u][nxt[u]])
                u = to[path[-1]]
            elif path:
                e = path.pop()
                u = to[e ^ 1]
                nxt[u] += 1
            else:
                break


def label(page: str, model: Classifier | None = None) -> list[tuple[Block, bool]]:
    """Blocks and whether each is content."""
    found, model = blocks(page), model or classifier()
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            a = found[i - 1]
            near = NEAR if a.parent == b.parent else FAR if a.up == b.up else FAR / 3
            edges.append((i - 1, i, near))
            j = last.get(b.parent)
            if j is not None and j != i - 1:
                edges.append((j, i, SIBLING))
        last[b.parent] = i
    return list(zip(found, minimum_cut([model.log_odds(b) for b in found], edges), strict=True))


def main_text(page: str | None, model: Classifier | None = None) -> str:
    return "\n".join(b.text for b, content in label(page, model) if content) if page else ""


def extract(df: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """Adds the main text of every whole page as out_col."""
    model = classifier()
    return spans.with_column(df, out_col, T.StringType(), lambda part: pa.array([main_text(p, model) for p in part.column(html_col).to_pylist()], pa.string()), html_col)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
