"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks: the text between block-level tags, with the tags and
class words around it. A linear classifier over each block's signs gives the
odds that it is content; the odds become the capacities from the source and
to the sink. Blocks next to each other, and consecutive blocks of one parent
element, are joined by smoothness edges that are weaker the further apart the
blocks are in the element tree. The cheapest cut (maximum flow) parts content
from boilerplate: a doubtful block goes with its neighbours, a sure one doesn't.

Scripts, styles, comments and other invisible parts have no blocks. Null and
empty pages, and pages without content, give an empty text; cut-off tags and
references at the end are taken as far as they go; repeated rows stay;
other columns are ignored; an empty table gives an empty result. Rows are
independent: one page is all that a task must hold.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Elements that end a block of text where they begin or end.
BLOCK_TAGS = frozenset("""address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre search section select summary table tbody
td textarea tfoot th thead title tr ul""".split())
#: Elements without an end tag.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never shown text.
HIDDEN_TAGS = frozenset("script style noscript template svg math iframe object canvas video audio head title".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe xmp".split())
#: Elements whose text is not the article's.
AWAY_TAGS = frozenset("nav header footer aside form button select option textarea label fieldset legend menu dialog search".split())
#: Elements that hold the article.
HOME_TAGS = frozenset("article main".split())
#: Words of class, id and role that tell boilerplate and content.
AWAY_WORDS = frozenset("""ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright
disclaimer disqus footer header login masthead menu modal nav navbar navigation newsletter notice pagination popup promo promoted related
respond share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget complementary contentinfo alert replies reply""".split())
HOME_WORDS = frozenset("article content main post story entry body text prose".split())

#: Weights of the classifier, in units of log odds.
WEIGHTS = {"bias": -0.4, "away_tag": -6.0, "away_word": -5.0, "home_tag": 3.0, "home_word": 1.2, "link_share": -4.0, "words": 0.5,
           "sentence": 0.8, "heading": 0.8, "paragraph": 1.0, "list_item": -0.6}
#: Signs of a page's layout (a form or a wrapper named after a part) count only for elements with less than this share of its text.
WHOLE_PAGE = 0.8
LAYOUT_WORDS = frozenset("banner footer header menu modal nav navbar navigation sidebar toolbar widget".split())
#: Capacity between neighbours of equal path; divided by one more than the steps between their elements.
SMOOTHNESS = 1.2

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_PART = re.compile(r"[a-z]+")


class Block:
    """A block of text in element number ``node``; ``marks`` come from its elements."""

    __slots__ = ("parts", "node", "near", "marks", "linked", "text")

    def __init__(self, node: int, near: frozenset):
        self.parts, self.node, self.near, self.marks, self.linked, self.text = [], node, near, near, 0, ""


class Elements:
    """The page's elements by number, parents before children."""

    def __init__(self):
        self.parent, self.depth, self.signs = [-1], [0], [frozenset()]

    def add(self, parent: int, signs: frozenset) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.signs.append(signs)
        return len(self.parent) - 1

    def distance(self, a: int, b: int) -> int:
        """Steps between two elements of the tree. Between neighbours on the page that
        is at most the number of tags between them."""
        steps = 0
        while a != b:
            if self.depth[a] < self.depth[b]:
                a, b = b, a
            a = self.parent[a]
            steps += 1
        return steps

    def inherited(self, weight: list[int]) -> list[frozenset]:
        """Signs of each element and those around it; ``weight`` is the text directly in
        each. Layout signs of an element with nearly all of the page's text say nothing."""
        held = list(weight)
        for e in range(len(held) - 1, 0, -1):
            held[self.parent[e]] += held[e]
        out = [frozenset()]
        for e in range(1, len(held)):
            own = self.signs[e]
            if own and held[e] >= WHOLE_PAGE * held[0]:
                own = own - {"page_form", "page_word"}
            above = out[self.parent[e]]
            out.append(above if own <= above else above | own)
        return out


#: The open element that a start tag ends, and the elements whose inside it looks no further than.
_CLOSES = {"li": ("li", ("ul", "ol", "menu")), "p": ("p", ("div", "article", "section", "td", "li", "body")), "tr": ("tr", ("table",)),
           "td": ("td", ("tr", "table")), "dd": ("dt", ("dl",)), "dt": ("dd", ("dl",)), "option": ("option", ("select",))}


def marks_of(tag: str, attributes: str) -> tuple[frozenset, bool]:
    """Signs of an element (for all inside it), and whether it is hidden."""
    found, hidden = set(), tag in HIDDEN_TAGS
    if tag in AWAY_TAGS:
        found.add("page_form" if tag == "form" else "away_tag")
    elif tag in HOME_TAGS:
        found.add("home_tag")
    for name, value in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            hidden = True
        elif name in ("class", "id", "role"):
            words = _PART.findall(value)
            if tag in ("body", "html"):  # words about the page's layout
                continue
            if away := AWAY_WORDS.intersection(words):
                found.add("page_word" if away <= LAYOUT_WORDS else "away_word")
            elif not HOME_WORDS.isdisjoint(words):
                found.add("home_word")
    return frozenset(found), hidden


def blocks(html: str) -> tuple[list[Block], Elements]:
    """The page's blocks with text, in page order, and its elements. The open
    elements of each tag are kept by their place on the stack, so each tag of
    the page costs the same however deep it stands."""
    out: list[Block] = []
    tree = Elements()
    # open elements: (tag, number, hidden), and their places by tag and of all block tags
    stack: list[tuple[str, int, bool]] = [("", 0, False)]
    places: dict[str, list[int]] = {}
    walls: list[int] = []
    at = 0
    now = None

    def say(text: str) -> None:
        nonlocal now
        if not text or stack[-1][2]:
            return
        if now is None:
            if text.isspace():
                return
            now = Block(stack[-1][1], frozenset("in_" + e[0] for e in stack[-4:]))
            out.append(now)
        now.parts.append(text)
        if places.get("a"):
            now.linked += len(text)

    def last(tag: str) -> int:
        held = places.get(tag)
        return held[-1] if held else 0

    def close(place: int) -> None:
        while len(stack) > place:
            tag = stack.pop()[0]
            places[tag].pop()
            if tag in BLOCK_TAGS:
                walls.pop()

    raw = ""
    while True:
        m = _TAG.search(html, at) if not raw else re.compile(rf"<(/)({raw})([^>]*)(?:>|\Z)", re.I).search(html, at)
        if m is None:
            say(html[at:])
            break
        say(html[at:m.start()])
        at = max(m.end(), m.start() + 1)
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        raw = ""
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCK_TAGS:
            now = None
        if m.group(1):
            opened = last(tag)
            # an inline end tag doesn't close blocks around it
            if opened and (tag in BLOCK_TAGS or not walls or walls[-1] < opened):
                close(opened)
            continue
        if tag in BLOCK_TAGS:  # a block ends an open paragraph, an item the one before it
            end, within = _CLOSES.get(tag, ("p", ("td", "li", "button")))
            opened = last(end)
            if opened and opened >= max((last(w) for w in within if w != end), default=0):
                close(opened)
        if tag in VOID_TAGS or m.group(3).rstrip().endswith("/") and tag not in BLOCK_TAGS and tag not in RAW_TAGS:
            continue
        marks, hidden = marks_of(tag, m.group(3))
        places.setdefault(tag, []).append(len(stack))
        if tag in BLOCK_TAGS:
            walls.append(len(stack))
        stack.append((tag, tree.add(stack[-1][1], marks), stack[-1][2] or hidden))
        raw = tag if tag in RAW_TAGS else ""
    kept, weight = [], [0] * len(tree.parent)
    for b in out:
        whole = "".join(b.parts)
        b.text = " ".join((unescape(whole) if "&" in whole else whole).split())
        if b.text:
            b.linked = min(1.0, b.linked / max(1, len(whole)))
            weight[b.node] += len(b.text)
            kept.append(b)
    around = tree.inherited(weight)
    for b in kept:
        b.marks = around[b.node] | b.near
    return kept, tree


def odds(b: Block) -> float:
    """Log odds that a block is content."""
    w, n = WEIGHTS, b.text.count(" ") + 1
    x = w["bias"] + sum(w[k] for k in ("home_tag", "home_word") if k in b.marks)
    x += w["away_tag"] * bool(b.marks & {"away_tag", "page_form"}) + w["away_word"] * bool(b.marks & {"away_word", "page_word"})
    x += w["link_share"] * b.linked + w["words"] * min(n, 40) ** 0.5 / 2
    x += w["sentence"] * (b.text[-1] in ".!?…:;\"'”»)")
    x += w["heading"] * any(f"in_h{k}" in b.marks for k in range(1, 7))
    x += w["paragraph"] * ("in_p" in b.marks) + w["list_item"] * ("in_li" in b.marks)
    return x


def edges(nodes: list[int], tree: Elements) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours on the page, and consecutive children of one element."""
    out = [(i - 1, i, SMOOTHNESS / (1 + tree.distance(nodes[i - 1], nodes[i]))) for i in range(1, len(nodes))]
    last: dict[int, int] = {}
    for i, node in enumerate(nodes):
        j = last.get(tree.parent[node])
        if j is not None and j < i - 1:
            out.append((j, i, SMOOTHNESS / (1 + (0 if nodes[j] == node else 2))))
        last[tree.parent[node]] = i
    return out


def minimum_cut(unary: list[float], pairs: list[tuple[int, int, float]]) -> list[bool]:
    """Labels that minimise: |odds| for each block labelled against its odds, plus the
    capacity of each pair labelled apart. Maximum flow by shortest augmenting
    levels (Dinic); the source side is content."""
    n = len(unary)
    source, sink = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, c: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(c)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, x in enumerate(unary):
        add(source, i, x, 0.0) if x > 0 else add(i, sink, -x, 0.0)
    for a, b, c in pairs:
        add(a, b, c, c)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        nexts = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                least = min(cap[e] for e in path)
                for k, e in enumerate(path):
                    cap[e] -= least
                    cap[e ^ 1] += least
                cut = next(k for k, e in enumerate(path) if cap[e] <= tiny)
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while nexts[u] < len(out[u]):
                e = out[u][nexts[u]]
                if cap[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                nexts[u] += 1
            if nexts[u] < len(out[u]):
                path.append(out[u][nexts[u]])
                u = to[out[u][nexts[u]]]
            elif path:
                u = to[path.pop() ^ 1]
                nexts[u] += 1
            else:
                break


def main_text(html: str | None) -> str:
    found, tree = blocks(html) if html else ([], None)
    if not found:
        return ""
    keep = minimum_cut([odds(b) for b in found], edges([b.node for b in found], tree))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, html_col: str = "html", out: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all but the html) of each page, with its main text."""
    columns = [c for c in pages.columns if c != html_col and c != out] if keep is None else keep
    schema = ", ".join([*(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in columns), f"`{out}` string"])
    names = [*columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_html"):
                texts = [main_text(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(columns))], pa.array(texts, pa.string())], names=names)

    return pages.select(*columns, F.col(html_col).alias("_html")).mapInArrow(run, schema)
