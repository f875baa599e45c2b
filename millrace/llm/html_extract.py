"""Main text of a page by minimum cut: each text block is content or boilerplate, at the least cost of the whole page."""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter, defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r">|=\s*[\"']")
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_MARKED = re.compile(r"class|id|role|item|hidden|style|label", re.I)

# HTML element names by role (fixed by the HTML standard)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template iframe object svg math canvas select button textarea title head audio video".split())
RAW = frozenset("script style textarea title noscript iframe".split())
IN_HEAD = frozenset("head base link meta script style title noscript template".split())
BLOCK = frozenset(
    "html body head address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption option".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARAGRAPH, _PARAGRAPHS = ({"p"}, BLOCK - {"p"}), ({"p"} | HEADINGS, BLOCK - {"p"} - HEADINGS)
#: An opening tag ends these open elements: an element, and where the search for it stops.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

# What an element is for, by its tag and by the words of its class, id and role. Hard words name things that are never
# an article; soft ones are also used for parts of articles and for wrappers.
HARD_TAGS = frozenset("nav footer aside menu dialog search".split())
SOFT_TAGS = frozenset("form header".split())
HARD_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr popup modal newsletter subscribe subscription share sharing comment comments respond replies disqus pagination pager masthead banner outbrain taboola complementary contentinfo".split()
)
SOFT_WORDS = frozenset("side aside widget widgets foot header head promo promotion notice notices alert overlay signup social related recommended recommendations reply login search copyright toolbar rail dialog form legal disclaimer teaser tags skip".split())
GOOD_WORDS = frozenset("article content post entry story main body text maincontent articlebody".split())
#: A word behind one of these tells of a state of the element, not of what it is.
STATES = frozenset("has no not with without is hide hides hidden".split())


@dataclass(frozen=True)
class Weights:
    """Evidence of a block's text (a terminal capacity, within +-``most``), of elements, and the strengths of the edges.

    Elements that a tag or a class marks are nodes of the cut too. Their evidence is a share of all the page's positive
    text evidence, so one that holds most of the text is outvoted by its blocks. ``tie_*`` is the edge from a block to
    each marked element around it.
    """

    bias: float = -1.3
    length: float = 0.6
    sentence: float = 0.5
    paragraph: float = 0.75
    cell: float = 0.25
    heading: float = 0.75
    link_density: float = 5.0
    most: float = 2.5
    article: float = 1.0
    good: float = 0.3
    outside: float = 0.5
    soft: float = 0.3
    hard: float = 0.85
    tie_article: float = 2.0
    tie_good: float = 1.0
    tie_outside: float = 3.0
    tie_soft: float = 3.5
    tie_hard: float = 6.0
    adjacent: float = 2.0
    sibling: float = 0.5
    boundary: float = 0.3


@dataclass
class Element:
    tag: str
    parent: int  # place among the page's elements, -1 for none
    depth: int
    kind: str  # "article", "hard", "soft", "good" or ""


@dataclass
class Block:
    text: str
    element: int  # its innermost element, -1 for none
    tag: str
    link_share: float


@dataclass
class Page:
    """Reads tags and text into blocks and the elements around them; tolerant of anything that is not well formed."""

    elements: list[Element] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    stack: list[int] = field(default_factory=list)
    open: Counter = field(default_factory=Counter)
    places: dict[str, list[int]] = field(default_factory=lambda: defaultdict(list))  # in the stack, of the open elements by tag
    block_places: list[int] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    anchors: int = 0
    silent: int = 0

    def flush(self) -> None:
        if not self.parts:
            return
        text = " ".join(entities.unescape("".join(self.parts)).split())
        self.parts.clear()
        linked, self.linked = self.linked, 0
        if text:
            at = self.stack[-1] if self.stack else -1
            block = self.stack[self.block_places[-1]] if self.block_places else -1
            self.blocks.append(Block(text, at if block < 0 else block, self.elements[block].tag if block >= 0 else "", min(1.0, linked / max(1, len(text)))))

    def text(self, raw: str) -> None:
        if self.open["head"] and self.elements[self.stack[-1]].tag == "head" and not raw.isspace():
            self.close(len(self.stack) - 1)
        if self.silent:
            return
        self.parts.append(raw)
        if self.anchors:
            self.linked += len(raw.strip())

    def close(self, k: int) -> None:
        """End the open elements from place ``k`` on."""
        tags = [self.elements[e].tag for e in self.stack[k:]]
        if any(t in BLOCK for t in tags):
            self.flush()
        for t in tags:
            self.open[t] -= 1
            self.places[t].pop()
            self.silent -= t in SILENT
            self.anchors -= t == "a"
        del self.stack[k:]
        while self.block_places and self.block_places[-1] >= k:
            self.block_places.pop()

    def _nearest(self, ended: frozenset[str] | set[str], stop: frozenset[str] | set[str]) -> int:
        """Place of the innermost open element among ``ended``, unless one of ``stop`` lies within it; -1 for none.

        Looked up by tag, so that the depth of the page does not matter.
        """
        last = max([self.places[t][-1] for t in ended if self.open[t]], default=-1)
        if last < 0:
            return -1
        return -1 if last < max([self.places[t][-1] for t in stop if self.open[t]], default=-1) else last

    def start(self, tag: str, attributes: str) -> None:
        if self.open["head"] and tag not in IN_HEAD and (k := self._nearest({"head"}, set())) >= 0:
            self.close(k)
        if tag == "br":
            self.text(" ")
            return
        if tag in BLOCK:
            self.flush()
        if tag in VOID or attributes.endswith("/") and (tag in ("svg", "math") or self.open["svg"] or self.open["math"]):
            return
        if tag in BLOCK and tag not in ("html", "body"):
            # a block ends an open paragraph or heading and the inline elements in it
            if (k := self._nearest(*(_PARAGRAPHS if tag == "p" or tag in HEADINGS else _PARAGRAPH))) >= 0:
                self.close(k)
        if tag in IMPLIED and (k := self._nearest(*IMPLIED[tag])) >= 0:
            self.close(k)
        kind = ""
        if tag in ("article", "main"):
            kind = "article"
        elif tag in HARD_TAGS:
            kind = "hard"
        elif tag in SOFT_TAGS and not (tag == "header" and self.open["article"] + self.open["main"]):
            kind = "soft"
        if attributes and tag not in ("html", "body", "main") and _MARKED.search(attributes):
            told = kind_of(attributes)
            kind = told if told in ("hard", "soft") and kind != "hard" else kind or told
        self.elements.append(Element(tag, self.stack[-1] if self.stack else -1, len(self.stack), kind))
        self.places[tag].append(len(self.stack))
        if tag in BLOCK:
            self.block_places.append(len(self.stack))
        self.stack.append(len(self.elements) - 1)
        self.open[tag] += 1
        self.silent += tag in SILENT
        self.anchors += tag == "a"

    def end(self, tag: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        if (k := self._nearest({tag}, frozenset() if tag in BLOCK else {"table", "article", "main", "body"})) >= 0:
            self.close(k)
            return
        if tag in BLOCK:
            self.flush()


def kind_of(attributes: str) -> str:
    """What class, id, role and the like say of an element: "hard", "soft" (boilerplate), "good" or "" (nothing)."""
    found: set[str] = set()
    for name, *values in _ATTR.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return "hard"
        if name in ("class", "id", "role", "itemprop", "itemtype", "aria-label"):
            for token in value.split():
                words = [w.lower() for w in _WORD.findall(token)]
                words = {w for k, w in enumerate(words) if not (k and words[k - 1] in STATES)}
                found |= {"hard"} if words & HARD_WORDS else set()
                found |= {"soft"} if words & SOFT_WORDS else set()
                found |= {"good"} if words & GOOD_WORDS else set()
    if "hard" in found:
        return "hard"
    if {"soft", "good"} <= found:
        return ""
    return found.pop() if found else ""


def _tag_end(page: str, at: int, endless: set[int]) -> int:
    """Where the tag that ``at`` lies in ends, behind its ">"; quoted values may hold one. -1 if it does not end.

    Where quotes do not close, the first ">" counts. ``endless`` are places from which no end was found: a later tag that
    comes upon one goes no further, so that a page full of open quotes is looked at once.
    """
    here, seen = at, []
    while (stop := _STOP.search(page, here)) is not None and stop.start() not in endless:
        if stop[0] == ">":
            return stop.end()
        seen.append(stop.start())
        here = page.find(stop[0][-1], stop.end()) + 1
        if not here:
            break
    endless.update(seen)
    return page.find(">", at) + 1 or -1


def read_page(page: str) -> Page:
    """The blocks and elements of a page. Each character is looked at a bounded number of times, whatever the markup."""
    state, at, last, endless = Page(), 0, page.rfind(">"), set()
    while at < len(page):
        less = page.find("<", at)
        if less < 0:
            state.text(page[at:])
            break
        if less > at:
            state.text(page[at:less])
        if page.startswith("<!--", less):
            end = page.find("-->", less + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        if page.startswith("<![CDATA[", less):
            end = page.find("]]>", less)
            state.text(page[less + 9 : end if end >= 0 else len(page)])
            at = end + 3 if end >= 0 else len(page)
            continue
        name = _NAME.match(page, less + 1)
        if name is None and page[less + 1 : less + 2] not in ("!", "?", "/"):
            state.text("<")
            at = less + 1
            continue
        if less > last:  # a tag that the page ends in
            break
        if name is None:
            at = page.find(">", less) + 1
            continue
        at = _tag_end(page, name.end(), endless)
        tag, attributes = name[2].lower(), page[name.end() : at - 1]
        if name[1]:
            state.end(tag)
        elif tag in RAW:
            state.start(tag, attributes) if tag not in IN_HEAD else None
            close = _raw_end(tag).search(page, at)
            if close or not attributes.endswith("/"):
                at = close.end() if close else len(page)
            if tag not in IN_HEAD:
                state.end(tag)
        elif tag == "body":
            state.close(0)
            state.start(tag, attributes)
        else:
            state.start(tag, attributes)
    state.close(0)
    state.flush()
    return state


_RAW_ENDS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in RAW}


def _raw_end(tag: str) -> re.Pattern:
    return _RAW_ENDS[tag]


def text_evidence(block: Block, w: Weights) -> float:
    """Log-odds of a block being content, from its own text and tag alone, within +-``w.most``."""
    n = block.text.count(" ") + 1
    s = w.bias + w.length * math.log2(1 + n) - w.link_density * block.link_share
    s += w.sentence * (block.text[-1] in ".!?…\"”»:;" and n > 3)
    if block.tag in ("p", "pre", "blockquote", "dd", "figcaption"):
        s += w.paragraph
    elif block.tag in HEADINGS:
        s += w.heading
    elif block.tag in ("li", "td"):
        s += w.cell
    return max(-w.most, min(w.most, s))


def build_graph(page: Page, w: Weights) -> tuple[list[float], list[tuple[int, int, float]]]:
    """Terminal capacities and edges: nodes are the blocks, then the marked elements, then what lies outside the article.

    Edges join a block with the block before it (weaker with their distance in the tree, and across the border of a
    marked element), with the block before it in the same parent, and with the marked elements around it.
    """
    blocks, elements = page.blocks, page.elements
    gain = [text_evidence(b, w) for b in blocks]
    total = max(1.0, sum(g for g in gain if g > 0))
    # characters of unlinked text below each element, of blocks that may be content
    mass, whole = [0.0] * len(elements), 0.0
    for b, g in zip(blocks, gain):
        own = len(b.text) * (1 - b.link_share) * (g > 0) + 1e-3
        whole += own
        if b.element >= 0:
            mass[b.element] += own
    bad = [e.kind in ("hard", "soft") for e in elements]
    for k, e in enumerate(elements):
        bad[k] = bad[k] or e.parent >= 0 and bad[e.parent]
    last = list(range(len(elements)))  # within each element, as they are numbered in the order of the page
    for k in range(len(elements) - 1, -1, -1):
        if elements[k].parent >= 0:
            mass[elements[k].parent] += mass[k]
            last[elements[k].parent] = max(last[elements[k].parent], last[k])
    # the article: of those that are in nothing bad (or of all) the one with most text, or the part of it that holds most
    named = [k for k, e in enumerate(elements) if e.kind == "article" and mass[k] > 0]
    named = [k for k in named if not bad[k]] or named
    main = max(named, key=lambda k: (mass[k], -k), default=-1)
    for k in named:
        if main >= 0 and k > main and mass[k] >= 0.6 * mass[main] and k <= last[main]:
            main = k
    around = set()
    k = main
    while k >= 0:
        around.add(k)
        k = elements[k].parent
    # marked elements of each element, as nodes with the strength of the edge
    node: dict[int, int] = {}
    marks: list[tuple[tuple[int, float], ...]] = []
    inside: list[bool] = []
    caps: list[float] = []
    reach = [(w.hard, w.tie_hard), (w.soft, w.tie_soft)]
    for k, e in enumerate(elements):
        own = marks[e.parent] if e.parent >= 0 else ()
        inside.append(k == main or e.parent >= 0 and inside[e.parent])
        cap = tie = 0.0
        if k == main:
            cap, tie = w.article * total, w.tie_article
        elif e.kind in ("hard", "soft") and k not in around:
            share, tie = reach[e.kind == "soft"]
            cap = -total * (share if main < 0 else 2.0 if e.kind == "hard" else share + 0.2)
        elif e.kind == "good" and main < 0:
            cap, tie = w.good * total, w.tie_good
        if tie:
            node[k] = len(blocks) + len(caps)
            caps.append(cap)
            # of elements of a kind within each other the innermost counts, and the article only where nothing hard is in it
            kept = [m for m in own if (m[1] != tie) and not (tie == w.tie_hard and m[1] == w.tie_article)]
            own = (*kept, (node[k], tie))
        marks.append(own)
    gain += caps
    outside = -1
    if main >= 0 and mass[main] >= 0.3 * whole:
        outside = len(gain)
        gain.append(-w.outside * total)
    edges: list[tuple[int, int, float]] = []
    last_in: dict[int, int] = {}
    for k, b in enumerate(blocks):
        own = marks[b.element] if b.element >= 0 else ()
        edges += [(k, n, tie) for n, tie in own]
        if outside >= 0 and not (b.element >= 0 and inside[b.element]):
            edges.append((k, outside, w.tie_outside))
        if k:
            a = blocks[k - 1]
            near = w.adjacent / (1 + _apart(elements, a.element, b.element) / 2)
            edges.append((k - 1, k, near if (marks[a.element] if a.element >= 0 else ()) == own else near * w.boundary))
        parent = elements[b.element].parent if b.element >= 0 else -1
        before = last_in.get(parent)
        if before is not None and before != k - 1:
            edges.append((before, k, w.sibling))
        last_in[parent] = k
    return gain, edges


def _apart(elements: list[Element], a: int, b: int) -> int:
    """Steps from one element to the other in the tree. Over a page's blocks in order all of them are about its elements."""
    steps = 0
    while a != b:
        if a > b:  # elements are numbered in the order of the page, so the larger one is not an ancestor
            a, b = b, a
        b = elements[b].parent
        steps += 1
    return steps


def min_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling of least cost: an unlabelled gain is paid if positive, a labelled one if negative, an edge if it is cut.

    Nodes whose own gain outweighs all their edges are settled first (no labelling of the others changes them); the
    rest is a maximum flow by shortest augmenting paths, in levels. Of equal cuts the one with the fewest nodes labelled.
    """
    n = len(gain)
    gain = list(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        k = todo.popleft()
        if label[k] is None and abs(gain[k]) > sum(near[k].values()):
            label[k] = gain[k] > 0
            for j, c in near[k].items():
                gain[j] += c if label[k] else -c
                del near[j][k]
                todo.append(j)
            near[k] = {}
    left = [k for k in range(n) if label[k] is None]
    if not left:
        return [bool(x) for x in label]
    source, sink = n, n + 1
    room: dict[int, dict[int, float]] = {k: dict(near[k]) for k in left}
    room[source], room[sink] = {}, {}
    for k in left:
        if gain[k] > 0:
            room[source][k], room[k][source] = gain[k], 0.0
        elif gain[k] < 0:
            room[k][sink], room[sink][k] = -gain[k], 0.0
    tiny = 1e-12
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            k = queue.popleft()
            for j, c in room[k].items():
                if c > tiny and j not in level:
                    level[j] = level[k] + 1
                    queue.append(j)
        if sink not in level:
            return [x if x is not None else k in level for k, x in enumerate(label)]
        arcs = {k: list(room[k]) for k in level}
        path = [source]
        while path:
            k = path[-1]
            if k == sink:
                flow = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= flow
                    room[b][a] = room[b].get(a, 0.0) + flow
                cut = next(i for i, (a, b) in enumerate(zip(path, path[1:])) if room[a][b] <= tiny)
                del path[cut + 1 :]
                continue
            while arcs[k] and not (level.get(arcs[k][-1]) == level[k] + 1 and room[k][arcs[k][-1]] > tiny):
                arcs[k].pop()
            if arcs[k]:
                path.append(arcs[k][-1])
            else:
                path.pop()
                if path:
                    arcs[path[-1]].pop()


def main_text(page: str | None, weights: Weights | None = None) -> str:
    """Content blocks of a page, white space collapsed, joined by an empty line; "" if there are none."""
    read = read_page(page or "")
    if not read.blocks:
        return ""
    content = min_cut(*build_graph(read, weights or Weights()))
    return "\n\n".join(b.text for b, keep in zip(read.blocks, content) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: Weights | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row of ``pages``.

    Null, empty and text-free pages give an empty text; nulls in other columns stay; repeated rows get equal answers;
    an empty table gives an empty result. A page is read whole, whatever its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), weights) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
