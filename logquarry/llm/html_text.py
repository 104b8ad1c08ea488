"""Main text of web pages by a minimum cut.

A page becomes a row of text blocks. A classifier gives each block a cost of being content and a cost of
being boilerplate; neighbours in the page and in the document tree pay for being told apart. The cheapest
labelling is a minimum cut, found as a maximum flow; blocks on the source's side are the text.
"""

from __future__ import annotations

import re
from collections import deque
from dataclasses import dataclass, field
from html import unescape
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import text_slices, unused

#: What begins markup: a tag with its name, a comment, or a declaration. Any other ``<`` is text.
MARK = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|(!--)|[!?])")
#: Steps through the attributes of a tag.
TO_VALUE, VALUE = re.compile(r"[^>=]*"), re.compile(r"=\s*(?:([\"'])|[^\s>]*)")
#: Elements whose whole content is no text of the page.
HIDDEN = frozenset(
    "script style noscript template svg iframe object canvas audio video head title select option textarea button datalist".split()
)
#: Searched in the page itself: its lower case may have other places.
END_TAGS = {name: re.compile(f"</{name}", re.I | re.A) for name in HIDDEN}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var "
    "math semantics mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup mover munder munderover mstyle".split()
)
#: A new one of these ends an open one of the same group.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
BAD_TAGS = frozenset("nav footer aside form header menu dialog".split())
ARTICLE = re.compile(r"<article\b", re.I | re.A)
GOOD_TAGS = frozenset("article main".split())
#: A name is one of boilerplate if it has one of these words, and besides them only words of layout.
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner banners promo promos promotion sponsor sponsored sponsors nav navbar navigation subnav "
    "menu menus breadcrumb breadcrumbs footer header masthead sidebar widget widgets cookie cookies consent notice notices popup modal newsletter "
    "subscribe subscription share sharing social comment comments disqus reply replies related recommend recommended recommendations tags toolbar "
    "login signup copyright pagination pager hidden".split()
)
LAYOUT_WORDS = frozenset(
    "area article articles bar block bottom box btn button buttons center col column container content div element footer form global group holder "
    "icon icons id img inline inner item items left link links list main media module outer page panel post posts primary right row secondary "
    "section site slot story thread title top user wrap wrapper".split()
)
#: Elements that hold text themselves: their names say less than those of a container.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre figcaption td th dt dd".split())
#: Names that tell how a page is laid out, not what an element is.
LAYOUT = re.compile(r"(?<!\S)(?:(?:no|has|with|without|left|right)-\S+|\S+-(?:open|closed|enabled|disabled|left|right))(?!\S)", re.I)
GOOD_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|post|entry|story|body|main|text)(?:$|[\s_-])", re.I)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

FEATURES = ("bias", "length", "link_share", "sentences", "heading", "paragraph", "list_item", "misnamed", "bad", "good", "outside")
#: The last of them tell where a block stands. Labels for training are made of those, so their weights are not trained.
PLACES = 4
#: What weights are drawn to where the sample tells nothing.
PRIOR = np.array([-0.5, 0.4, -3.0, 0.5, 1.0, 1.0, -0.5, -2.5, -8.0, 2.5, -3.0])
#: Cost of telling apart: blocks next to each other, and more so if they have one parent.
NEXT, SIBLING = 0.3, 0.6


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    parent: int = 0
    tag: str = ""
    bad: bool = False
    good: bool = False
    misnamed: bool = False
    linked: int = 0
    text: str = ""


class Markup:
    """Reads tags forward. Nothing is searched for twice, so the time grows with the length of the page alone."""

    def __init__(self, html: str):
        self.html, self.missing = html, set()

    def find(self, sign: str, at: int) -> int:
        """Place of ``sign``, or -1; once it was not found, it is nowhere behind either."""
        if sign in self.missing:
            return -1
        place = self.html.find(sign, at)
        if place < 0:
            self.missing.add(sign)
        return place

    def end_tag(self, name: str, at: int) -> int:
        if name in self.missing:
            return -1
        match = END_TAGS[name].search(self.html, at)
        if match is None:
            self.missing.add(name)
            return -1
        return match.start()

    def attributes_end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag; -1 if there is none. A quote counts where a value begins, if it ends."""
        html, pos = self.html, at
        while True:
            pos = TO_VALUE.match(html, pos).end()
            if pos >= len(html):
                return self.find(">", at)  # a quote took the rest of the page
            if html[pos] == ">":
                return pos
            value = VALUE.match(html, pos)
            pos = value.end()
            if value[1]:
                close = self.find(value[1], pos)
                pos = close + 1 if close >= 0 else pos


def boilerplate_name(names: str) -> bool:
    for name in LAYOUT.sub(" ", names).lower().split():
        words = set(re.findall("[a-z]+", name))
        if words & BAD_WORDS and words <= BAD_WORDS | LAYOUT_WORDS:
            return True
    return False


class Open:
    """The open elements. Where the nearest one of a name is, and the nearest one that is no inline element, is known
    at any depth."""

    def __init__(self):
        # Name, number; whether a tag around it is bad, or good; whether a container around it, or a text element, has
        # a name of boilerplate.
        self.stack: list[tuple[str, int, bool, bool, bool, bool]] = [("", 0, False, False, False, False)]
        self.places: dict[str, list[int]] = {}
        self.boxes = [0]

    def push(self, element: tuple) -> None:
        depth = len(self.stack)
        self.places.setdefault(element[0], []).append(depth)
        if element[0] not in INLINE:
            self.boxes.append(depth)
        self.stack.append(element)

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            name = self.stack.pop()[0]
            self.places[name].pop()
            if name not in INLINE:
                self.boxes.pop()

    def close(self, name: str) -> None:
        """The end tag of ``name``: an inline one never ends what holds it."""
        places = self.places.get(name)
        if places and (name not in INLINE or places[-1] > self.boxes[-1]):
            self.cut(places[-1])


def blocks(html: str) -> list[Block]:
    """Text blocks in page order, with what the elements around them say. Any string is read: unknown,
    unclosed and unmatched tags are taken as they come; a tag that never ends hides what follows it."""
    found: list[Block] = []
    markup, tree = Markup(html), Open()
    lone_article = len(ARTICLE.findall(html)) == 1
    opened = links = 0
    current: Block | None = None
    at, size = 0, len(html)

    def add(text: str) -> None:
        nonlocal current
        if current is None:
            if text.isspace():
                return
            depth, (_, _, bad, good, boxed, misnamed) = tree.boxes[-1], tree.stack[-1]
            # Siblings are blocks of one grandparent: each paragraph is an element of its own.
            parent, tag = tree.stack[max(0, depth - 1)][1], tree.stack[depth][0]
            current = Block(parent=parent, tag=tag, bad=bad or boxed, good=good, misnamed=misnamed)
            found.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text)

    while at < size:
        match = MARK.search(html, at)
        if match is None:
            add(unescape(html[at:]))
            break
        if match.start() > at:
            add(unescape(html[at : match.start()]))
        name = match[2]
        if name is None:
            ending = "-->" if match[3] else ">"
            # ``<!-->`` is a whole comment.
            end = markup.find(ending, match.end() - 2 if match[3] else match.end())
            at = end + len(ending) if end >= 0 else size
            continue
        end = markup.attributes_end(match.end())
        if end < 0:
            break
        written, at = html[match.end() : end], end + 1
        name = name.lower()
        if match[1]:
            links -= name == "a" and links > 0
            if name not in INLINE:
                current = None
            tree.close(name)
            continue
        if name in HIDDEN:
            if name != "head" and not written.endswith("/"):
                end = markup.end_tag(name, at)
                at = end if end >= 0 else size if name in ("script", "style") else at
            continue
        if name in VOID:
            if name == "hr":
                current = None
            elif name == "br" and current is not None:
                current.parts.append(" ")
            continue
        if name not in INLINE:
            current = None
            if tree.stack[tree.boxes[-1]][0] in ENDS.get(name, ("p",)):
                tree.cut(tree.boxes[-1])
        elif name == "a":
            links += 1
        opened += 1
        _, _, bad, good, boxed, misnamed = tree.stack[-1]
        named = " ".join(x for y in NAMES.findall(written) for x in y if x) if written else ""
        # Names of what is around the page's own article say nothing of it.
        central = not good and (name == "main" or name == "article" and lone_article)
        boxed = boxed and not central
        if named and not (central or name in ("html", "body")) and boilerplate_name(named):
            text_level = name in TEXT_TAGS or name in INLINE
            boxed, misnamed = boxed or not text_level, misnamed or text_level
        good = good or name in GOOD_TAGS or bool(named and GOOD_NAMES.search(named))
        bad = bad or name in BAD_TAGS
        if not written.endswith("/"):
            tree.push((name, opened, bad, good, boxed, misnamed))
    kept = []
    for block in found:
        block.text = " ".join("".join(block.parts).split())
        if block.text:
            kept.append(block)
    return kept


def features(page: list[Block]) -> np.ndarray:
    central = any(x.good and not x.bad for x in page)
    rows = []
    for block in page:
        n = len(block.text)
        rows.append(
            (
                1.0,
                min(log(n + 1), 7.0) - 3.0,
                min(1.0, block.linked / n),
                min(4, sum(map(block.text.count, ".!?"))) / 2,
                float(block.tag in ("h1", "h2", "h3", "h4", "h5", "h6")),
                float(block.tag in ("p", "blockquote", "pre")),
                float(block.tag in ("li", "td", "th", "option", "dt", "dd")),
                float(block.misnamed),
                float(block.bad),
                float(block.good),
                float(central and not block.good),
            )
        )
    return np.array(rows).reshape(len(rows), len(FEATURES))


def fit(rows: np.ndarray, labels: np.ndarray, prior: np.ndarray, steps: int = 30, pull: float = 4.0) -> np.ndarray:
    """Logistic regression, drawn to ``prior`` by ``pull`` (Newton's method)."""
    weights = prior.copy()
    for _ in range(steps if len(rows) else 0):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (p - labels) + pull * (weights - prior)
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + pull * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def maximum_flow(n: int, edges: list[tuple[int, int, float, float]], source: int, sink: int) -> set[int]:
    """The source's side of a minimum cut (shortest augmenting paths by levels). Edges have a capacity
    each way."""
    to, capacity, out = [], [], [[] for _ in range(n)]
    for a, b, forth, back in edges:
        out[a].append(len(to))
        to.append(b)
        capacity.append(forth)
        out[b].append(len(to))
        to.append(a)
        capacity.append(back)
    while True:
        level = [-1] * n
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if capacity[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return {a for a in range(n) if level[a] >= 0}
        following = [0] * n
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(capacity[e] for e in path)
                for e in path:
                    capacity[e] -= least
                    capacity[e ^ 1] += least
                first = next(i for i, e in enumerate(path) if capacity[e] <= 1e-9)
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while following[a] < len(out[a]):
                e = out[a][following[a]]
                if capacity[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                    break
                following[a] += 1
            else:
                if a == source:
                    break
                e = path.pop()
                a = to[e ^ 1]
                following[a] += 1


def cut(page: list[Block], weights: np.ndarray) -> list[bool]:
    """Which blocks are content: the labelling of least cost. Blocks whose own costs outweigh all they
    share with others are settled first, exactly; the flow is over the rest."""
    n = len(page)
    scores = np.clip(features(page) @ weights, -20, 20).tolist()
    own = scores  # cost of boilerplate less cost of content: the log-odds
    near: list[dict[int, float]] = [{} for _ in range(n)]
    last_of: dict[int, int] = {}
    for i, block in enumerate(page):
        for j, cost in ((i - 1, NEXT), (last_of.get(block.parent, -1), SIBLING)):
            if j >= 0:
                near[i][j] = near[i].get(j, 0.0) + cost
                near[j][i] = near[j].get(i, 0.0) + cost
        last_of[block.parent] = i
    label: list[bool | None] = [None] * n
    open_ = deque(range(n))
    while open_:
        i = open_.popleft()
        if label[i] is None and abs(own[i]) > sum(near[i].values()):
            label[i] = own[i] > 0
            for j, cost in near[i].items():
                del near[j][i]
                if label[j] is None:
                    own[j] += cost if label[i] else -cost
                    open_.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        source, sink = len(rest), len(rest) + 1
        edges = [(source, k, max(own[i], 0.0), 0.0) for i, k in place.items()]
        edges += [(k, sink, max(-own[i], 0.0), 0.0) for i, k in place.items()]
        edges += [(place[i], place[j], c, c) for i in rest for j, c in near[i].items() if i < j]
        side = maximum_flow(len(rest) + 2, edges, source, sink)
        for i, k in place.items():
            label[i] = k in side
    return [bool(x) for x in label]


def main_text(html: str | None, weights: np.ndarray = PRIOR) -> str:
    page = blocks(html) if html else []
    return "\n".join(x.text for x, content in zip(page, cut(page, weights)) if content) if page else ""


def trained_weights(pages: DataFrame, sample_pages: int = 256, most_alike: int = 50, html: str = "html") -> np.ndarray:
    """Weights fitted to blocks of at most ``sample_pages`` pages (those of least hash) that stand inside ``article`` or
    ``main`` and nothing else, or inside navigation, forms, notices and nothing else.

    Those places make the labels, so only the weights of the text's own features are fitted, and the places keep
    their ``PRIOR``. Blocks with equal features count ``most_alike`` times at most.
    """
    own = len(FEATURES) - PLACES

    def rows(batches):
        for part in text_slices(batches, "html"):
            for value in part.column("html").to_pylist():
                page = blocks(value) if value else []
                if page:
                    sums: dict[tuple, int] = {}
                    for row, block in zip(features(page).tolist(), page):
                        if block.bad != block.good:
                            key = (*(round(x, 1) for x in row[:own]), float(block.good))
                            sums[key] = sums.get(key, 0) + 1
                    table = [pa.array([list(k) for k in sums], pa.list_(pa.float64())), pa.array(list(sums.values()), pa.int64())]
                    yield pa.RecordBatch.from_arrays(table, ["row", "n"])

    chosen = pages.select(F.col(f"`{html}`").alias("html")).orderBy(F.xxhash64("html"), "html").limit(sample_pages)
    found = chosen.mapInArrow(rows, "row array<double>, n long").groupBy("row").agg(F.sum("n").alias("n")).collect()
    found = sorted((tuple(x.row), x.n) for x in found)
    data = np.array([x for x, _ in found]).reshape(len(found), own + 1)
    times = np.array([min(n, most_alike) for _, n in found], np.int64)
    fitted = fit(np.repeat(data[:, :-1], times, axis=0), np.repeat(data[:, -1], times), PRIOR[:own])
    return np.concatenate([fitted, PRIOR[own:]])


def extract(pages: DataFrame, weights: np.ndarray | None = None, html: str = "html") -> DataFrame:
    """Each page's columns but the markup, ``text`` and ``n_chars`` (code points). Blocks are joined by line
    ends. A null or empty page, and one without text, has an empty text; repeated rows are extracted each, and other columns
    stay, but for those named ``text`` and ``n_chars``."""
    weights = trained_weights(pages, html=html) if weights is None else weights
    rest = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    held = unused("html", rest)
    given = pages.select(*[f"`{c}`" for c in rest], F.col(f"`{html}`").alias(held))

    def run(batches):
        for part in text_slices(batches, held):
            texts = [main_text(x, weights) for x in part.column(held).to_pylist()]
            columns = [*part.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:-1], "text", "n_chars"])

    return given.mapInArrow(run, given.drop(held).schema.add("text", "string").add("n_chars", "long"))
