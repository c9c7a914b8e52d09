"""Operator 2: main text of web pages by minimum-cut labelling.

A page is cut into blocks of text. A classifier's costs of calling a block content or boilerplate become the
capacities of the edges to the two terminals. They have two parts: points for a block's place in the document tree, its
links, length and wording, and the log odds of a logistic classifier of text and links, fitted on blocks of a bounded
sample of those pages that mark their article (``fit``). What marks the article and the names of elements are no inputs of it.
As for the edges between blocks, neighbours in reading order and blocks of one parent are joined by smoothness
edges that weaken with their distance in the tree. The minimum cut, found by maximum flow, is the labelling
of least total cost: blocks on the source's side are the main text.

Defined results: null and empty pages and pages without content give the empty text; character
references are decoded, white space within a block becomes one space, blocks are trimmed and joined by one
newline in page order; repeated pages are treated alike; other columns aren't looked at; an empty table gives an empty result. Elements may be nested
to any depth: what a block inherits is kept once for each element, so time and memory grow with the page's length. Without
pages that mark an article nothing is fitted, and the points decide alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title svg iframe object select option datalist canvas audio video textarea annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mfenced mover munder munderover mstyle semantics".split())
#: A start tag of these ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Start tags that leave the head open, and those that end an unclosed silent element besides ENDS_P.
OF_HEAD = frozenset("html head title meta link base basefont bgsound style script noscript template".split())
ENDS_SILENT = ENDS_P | frozenset("body li dt dd td th tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CHROME = frozenset("nav footer aside form button menu dialog".split())
NAMED_BAD = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|nav\w*|menu|breadcrumbs?|pagination|pager|sidebar|side|rail|widget|footer|foot|masthead|topbar|toolbar|comments?|remarks?|feedback|discussions?|reactions?|opinions|guestbook|talkback|disqus|replies|respond|reviews?|share|sharing|social|related|recommended|trending|newsletter|subscribe|signup|login|search|form|skip|copyright|legal|disclaimer|tags?)(?=$|[\s_-])", re.I)
NAMED_HEADER = re.compile(r"(?:^|[\s_-])header(?=$|[\s_-])", re.I)
NAMED_GOOD = re.compile(r"(?:^|[\s_-])(?:article|content|entry|post|story|main|body|text|hentry)(?=$|[\s_-])", re.I)
LEGAL = re.compile(r"©|\(c\) \d{4}|all rights reserved|cookie|subscribe|sign up|log ?in\b|advertis", re.I)

CONSENT = re.compile(r"\b(?:uses?|using|accept(?: all)?|store|set) cookies\b|\bcookie (?:policy|settings|preferences)\b|\bconsent to\b|\bprivacy (?:policy|settings|choices)\b", re.I)
ENDINGS = tuple(".!?:;\"”…")

#: Most pages that a fit reads, and blocks of each page.
MAX_PAGES, MAX_BLOCKS = 2000, 64
#: Part of the fitted log odds that counts, and its limit, so that it can't outweigh a page's own marks.
ODDS, MOST = 0.5, 1.5

#: Capacities in thousandths.
UNIT = 1000
NEXT_TO, SAME_PARENT = 1.6, 0.5


class Node:
    """An open element that isn't inline: its place in the tree and what its blocks inherit."""

    __slots__ = ("parent", "depth", "tag", "chrome", "body", "header", "good", "bad_above", "bad")

    def __init__(self, parent: Node | None, tag: str, name: str):
        self.parent, self.tag = parent, tag
        self.depth = parent.depth + 1 if parent else 0
        named_bad = bool(name) and NAMED_BAD.search(name) is not None
        opens_body = tag in ("article", "main")
        #: In an article or main element; bad names of elements above the innermost of them, and from it on.
        self.body = opens_body or bool(parent and parent.body)
        self.bad_above = bool(parent and (parent.bad_above or opens_body and parent.bad))
        self.bad = named_bad or bool(parent and parent.bad and not opens_body)
        self.chrome = tag in CHROME or bool(parent and parent.chrome)
        self.header = tag == "header" or bool(name and NAMED_HEADER.search(name)) or bool(parent and parent.header)
        self.good = bool(name and NAMED_GOOD.search(name)) or bool(parent and parent.good)


ROOT = Node(None, "", "")


@dataclass
class Block:
    text: str
    node: Node
    linked: int  # code points inside links


class _Parser(HTMLParser):
    def __init__(self, page: str = ""):
        super().__init__(convert_charrefs=True)
        #: End tags of silent elements that are still to come; an element that opens after the last one isn't closed.
        self.ends = Counter(t for t in re.findall(r"</([a-z-]+)", page.lower()) if t in SILENT)
        self.unclosed: set[int] = set()
        self.open: list[tuple[str, int, Node]] = []
        #: Open elements of each tag, and open ones that nothing closes.
        self.count: Counter[str] = Counter()
        self.left_open = 0
        self.blocks: list[Block] = []
        self.buffer: list[str] = []
        self.linked = 0
        self.silent = self.links = self.made = 0
        self.where = ROOT

    def flush(self):
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.blocks.append(Block(text, self.where, min(self.linked, len(text))))
            self.buffer = []
        self.linked = 0

    def pop(self, at: int):
        for tag, number, _ in self.open[at:]:
            self.silent -= tag in SILENT
            self.links -= tag == "a"
            self.count[tag] -= 1
            self.left_open -= number in self.unclosed
        del self.open[at:]

    def close_open(self, tag: str, until: frozenset[str] = frozenset()):
        for k in range(len(self.open) - 1, -1, -1) if self.count[tag] else ():
            if self.open[k][0] == tag:
                self.pop(k)
                return
            if self.open[k][0] in until:
                return

    def set_cdata_mode(self, elem, **more):
        if elem in ("script", "style") or self.ends[elem] > 0:  # others that nothing closes would take in the rest of the page
            super().set_cdata_mode(elem, **more)

    def end_head(self):
        for k, (tag, _, _) in enumerate(self.open) if self.count["head"] else ():
            if tag == "head":
                if not any(t in ("noscript", "template") for t, _, _ in self.open[k:]):
                    self.pop(k)
                return

    def handle_starttag(self, tag, attrs):
        if self.silent:
            if self.left_open and (tag in ENDS_SILENT or tag == "meta" or tag == "link"):
                at = next((k for k, e in enumerate(self.open) if e[1] in self.unclosed), None)
                if at is not None:
                    self.pop(at)
            if tag not in OF_HEAD:
                self.end_head()
        if tag not in INLINE:
            self.flush()
        elif tag == "br":
            self.buffer.append(" ")
        if tag in ENDS_P:
            self.close_open("p", frozenset(("button", "td", "th", "li", "table")))
        elif tag == "li":
            self.close_open("li", frozenset(("ul", "ol", "menu")))
        elif tag in ("dt", "dd"):
            self.close_open("dt", frozenset(("dl",)))
            self.close_open("dd", frozenset(("dl",)))
        elif tag in ("td", "th", "tr"):
            for t in ("td", "th", *(("tr",) if tag == "tr" else ())):
                self.close_open(t, frozenset(("table",)))
        elif tag == "body":
            self.close_open("head")
        elif tag == "a":
            self.close_open("a", ENDS_P)
        if tag in VOID:
            return
        self.made += 1
        above = self.open[-1][2] if self.open else ROOT
        named = "" if tag in ("html", "body") else " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        self.open.append((tag, self.made, above if tag in INLINE else Node(above, tag, named)))
        self.silent += tag in SILENT
        self.links += tag == "a"
        self.count[tag] += 1
        if tag in SILENT and tag != "head" and self.ends[tag] <= 0:
            self.unclosed.add(self.made)
            self.left_open += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.ends[tag] -= 1
        if tag not in INLINE:
            self.flush()
        self.close_open(tag)

    def handle_data(self, data):
        if self.silent and self.open[-1][0] == "head" and data.strip():
            self.end_head()
        if self.silent:
            return
        if not self.buffer:
            if not data.strip():
                return
            self.where = self.open[-1][2] if self.open else ROOT
        self.buffer.append(data)
        if self.links:
            self.linked += len(data.strip())


def blocks_of(page: str) -> list[Block]:
    p = _Parser(page)
    p.feed(page)
    p.close()
    p.flush()
    return p.blocks


def points(b: Block) -> tuple[float, float]:
    """Points against and for a block by its place in the tree, links, length and wording."""
    bad = good = 0.0
    n, at = len(b.text), b.node
    if at.chrome:
        bad += 9
    # a page's own wrappers say little about an article that they hold
    if at.bad:
        bad += 9
    elif at.bad_above:
        bad += 5
    if at.body:
        good += 3
    elif at.header:
        bad += 6
    good += 1.5 * at.good
    bad += 4 * max(0.0, b.linked / n - 0.3) / 0.7
    good += min(3.0, 0.6 * max(0.0, math.log(n / 20)))
    if at.tag in HEADINGS:
        good += 1.5
    elif at.tag in ("p", "blockquote", "pre"):
        good += 0.7
    if n < 25:
        bad += 0.8
    if b.text.endswith(ENDINGS):
        good += 0.6
    if n < 250 and LEGAL.search(b.text):
        bad += 2
    if n < 600 and CONSENT.search(b.text):
        bad += 1 if at.body else 4
    return bad, good


#: Bytes that are counted in each block: commas, spaces, capitals and digits of ASCII.
_COUNTED = np.zeros((256, 4))
for _k, _of in enumerate((b",", b" ", bytes(range(65, 91)), bytes(range(48, 58)))):
    _COUNTED[list(_of), _k] = 1


def inputs(blocks: list[Block]) -> np.ndarray:
    """A row of numbers for each block, from its text, links and neighbours alone."""
    texts = [b.text for b in blocks]
    raw = [t.encode("utf-8", "replace") for t in texts]
    n = np.array([len(t) for t in texts], float)
    size = np.array([len(r) for r in raw])
    joined = np.frombuffer(b"".join(raw), np.uint8)
    starts = np.cumsum(size) - size
    commas, spaces, capitals, digits = (np.add.reduceat(_COUNTED[:, k][joined], starts) for k in range(4))
    words = spaces + 1
    linked = np.array([b.linked for b in blocks]) / n
    kinds = np.array([(t.endswith(ENDINGS), b.node.tag in HEADINGS, b.node.tag in ("p", "blockquote", "pre"), len(t) < 250 and LEGAL.search(t) is not None) for t, b in zip(texts, blocks, strict=True)], float)
    x = np.column_stack([np.log(n), linked, n < 25, commas / words, np.log(n / words), capitals / n, digits / n, kinds])
    apart = np.zeros((1, 2))
    return np.hstack([x, np.vstack([apart, x[:-1, :2]]), np.vstack([x[1:, :2], apart])])


@dataclass(frozen=True)
class Odds:
    """Log odds of content: ``bias`` + ``inputs`` . ``weights``."""

    weights: np.ndarray
    bias: float

    def of(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def fit_odds(x: np.ndarray, content: np.ndarray, ridge: float = 1e-2, steps: int = 25) -> Odds | None:
    """Newton steps on the mean log loss with a ridge; both kinds weigh the same. None without blocks of both kinds."""
    if not len(x) or content.all() or not content.any():
        return None
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    share = np.where(content, 0.5 / content.sum(), 0.5 / (~content).sum())
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve((z * (share * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (share * (content - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    weights = w[:-1] / scale
    return Odds(weights, float(w[-1] - mean @ weights))


def marked_blocks(page: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Inputs of at most ``MAX_BLOCKS`` blocks, evenly spread, of a page that marks its article, and which are of it."""
    blocks = blocks_of(page or "")
    if not any(b.node.body for b in blocks):
        return None
    at = np.unique(np.linspace(0, len(blocks) - 1, MAX_BLOCKS).astype(int)) if len(blocks) > MAX_BLOCKS else np.arange(len(blocks))
    return inputs(blocks)[at], np.array([b.node.body and not b.node.chrome and not b.node.bad for b in blocks])[at]


def costs(blocks: list[Block], odds: Odds | None = None) -> list[tuple[float, float]]:
    """What it costs to call each block content, and to call it boilerplate."""
    out = [points(b) for b in blocks]
    if odds is None:
        return out
    fitted = np.clip(ODDS * odds.of(inputs(blocks)), -MOST, MOST).tolist()
    return [(bad + max(0.0, -f), good + max(0.0, f)) for (bad, good), f in zip(out, fitted, strict=True)]


def tree_steps(a: Node, b: Node) -> int:
    """Edges of the tree between two elements; over a page's blocks in order these add up to twice its elements at most."""
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    out = []
    last_of: dict[int, int] = {}
    for k, b in enumerate(blocks):
        if k:
            out.append((k - 1, k, NEXT_TO / (1 + max(0, tree_steps(blocks[k - 1].node, b.node) - 2))))
        parent = id(b.node.parent or b.node)
        before = last_of.get(parent)
        if before is not None and before != k - 1:
            out.append((before, k, SAME_PARENT))
        last_of[parent] = k
    return out


def min_cut(terminal: list[tuple[float, float]], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node is on the source's side of a minimum cut.

    ``terminal``: costs of being on the source's side and on the sink's side; ``edges`` cost their
    weight if their ends are apart. Shortest augmenting paths by levels (Dinic).
    """
    n = len(terminal)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[int] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: int, back: int) -> None:
        at[a].append(len(to))
        to.append(b)
        cap.append(there)
        at[b].append(len(to))
        to.append(a)
        cap.append(back)

    for k, (source_side, sink_side) in enumerate(terminal):
        spare = round(UNIT * (sink_side - source_side))  # what flows straight through is taken off
        if spare > 0:
            join(s, k, spare, 0)
        elif spare < 0:
            join(k, t, -spare, 0)
    for a, b, w in edges:
        c = round(UNIT * w)
        if c:
            join(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in at[u]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        nxt = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                flow = min(cap[e] for e in path)
                back = len(path)
                for k, e in enumerate(path):
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                    if not cap[e] and k < back:
                        back = k
                u = to[path[back] ^ 1]
                del path[back:]
                continue
            while nxt[u] < len(at[u]):
                e = at[u][nxt[u]]
                if cap[e] and level[to[e]] == level[u] + 1:
                    path.append(e)
                    u = to[e]
                    break
                nxt[u] += 1
            else:
                if u == s:
                    break
                level[u] = -1
                u = to[path.pop() ^ 1]


def main_text(page: str | None, odds: Odds | None = None) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    keep = min_cut(costs(blocks, odds), smoothness(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def fit(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_pages: int = MAX_PAGES) -> Odds | None:
    """The classifier of the costs, from those of ``max_pages`` pages with the smallest hashes of id and address that mark their article.

    One row of at most ``MAX_BLOCKS`` blocks comes back for each of these pages.
    """
    place = F.xxhash64(id_col, url_col)
    last = pages.select(place.alias("h")).distinct().orderBy("h").limit(max_pages).agg(F.max("h")).first()[0]
    if last is None:
        return None

    def run(batches):
        for b in batches:
            for h, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = marked_blocks(page)
                if found:
                    yield pa.record_batch([pa.array([h]), pa.array([found[0].astype("<f4").tobytes()]), pa.array([found[1].tobytes()])], ["h", "x", "y"])

    sample = pages.select(place.alias("h"), html_col).where(F.col("h") <= last).mapInArrow(run, "h long, x binary, y binary")
    rows = sample.groupBy("h").agg(F.min(F.struct("x", "y")).alias("b")).orderBy("h").select("b.x", "b.y").collect()
    y = np.frombuffer(b"".join(r["y"] for r in rows), bool)
    return fit_odds(np.frombuffer(b"".join(r["x"] for r in rows), "<f4").astype(float).reshape(len(y), -1), y) if len(y) else None


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", odds: Odds | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; ``odds`` as ``fit`` gives it."""

    def run(batches):
        for b in batches:
            text = [main_text(h, odds) for h in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], [id_col, url_col, "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")
