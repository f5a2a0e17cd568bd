"""Main text of web pages: blocks are labelled by a minimum cut.

What the tags around a block and its text say becomes the capacity of its edge to the source
(content) or the sink (boilerplate); neighbouring blocks, and blocks under one element, are
joined by edges, so that a cut between them costs something.
"""
from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from spanveil.llm.text import map_texts, slices

#: Evidence of the elements around a block, in units of log odds; positive means content.
MARKED, NAMED, REFUSED = 8.0, 4.0, -12.0
#: A header counts as refused, unless it is that of a part with evidence for content.
HEADER = -11.0
#: Evidence against blocks outside, where a page marks its article by an element, or by a class.
OUTSIDE_MARKED, OUTSIDE_NAMED = -6.0, -3.0
#: What the text of a block can say at most.
MOST = 3.0
#: Smoothness: neighbours under one element, under elements side by side, and further apart; block and element around it.
BESIDE, NEAR, FAR, INSIDE = 1.0, 0.75, 0.25, 0.5
_UNIT = 16

# Names of HTML elements and words that sites use as classes and ids.
_BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td
tfoot th thead tr ul""".split())
_REFUSED = frozenset("aside button datalist dialog footer form head input label legend menu nav optgroup option search select textarea fieldset".split())
_SKIPPED = frozenset("""applet audio canvas iframe math noembed noframes noscript object script style svg template textarea title video
xmp""".split())
_RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_REFUSED_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar
tooltip""".split())
_REFUSED_WORDS = frozenset("""ad ads adsense advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs captcha
comment commentlist comments consent cookie cookies copyright disclaimer discussion disqus footer form gdpr hidden login masthead menu
menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promos promoted
promotion rail recommendations recommended related replies reply respond responses search share sharing sidebar signup skip social sponsor
sponsored sponsors subscribe subscription teaser toc toolbar topbar widget widgets""".split())
_NAMED_WORDS = frozenset("article body content entry main page post prose story text".split())
_TEXT_TAGS = {"p": "p", "li": "li", "dd": "li", "dt": "li", "td": "td", "th": "td", "pre": "p", "blockquote": "p",
              "h1": "h", "h2": "h", "h3": "h", "h4": "h", "h5": "h", "h6": "h"}
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
           "option": ("option",), "tbody": ("tr", "td", "th", "tbody", "thead"), "tfoot": ("tr", "td", "th", "tbody", "thead")}
_ENDS_SCOPE = frozenset("article aside body dl footer form header html main nav ol section table ul".split())

_TOKEN = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|/([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|/[^a-zA-Z>][^>]*(?:>|\Z)|/>|
    ([a-zA-Z][^\s/>]*)((?:[^>"'=]|=\s*(?:"[^"]*"|'[^']*')?|["'])*+)(?:>|\Z))""".replace("\n    ", ""), re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>][^\s=/>]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""")
_TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SIGNS = re.compile("[©|»›•]")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(slots=True)
class Element:
    """An open or closed element; ``own`` is what it says by itself."""

    name: str
    parent: int
    own: float
    words: frozenset = frozenset()
    articles: int = 0
    mains: int = 0
    titles: int = 0
    saved: "Block | None" = None
    inside: bool = False


@dataclass(slots=True)
class Block:
    """Text without a block border in it."""

    element: int
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@functools.lru_cache(4096)
def _says(name: str, attributes: str) -> tuple[float, frozenset]:
    """Evidence of an element by itself, and the words of its class and id that speak against it."""
    own = MARKED if name in ("article", "main") else HEADER if name == "header" else REFUSED if name in _REFUSED else 0.0
    against: frozenset = frozenset()
    if not attributes or not _TELLING.search(attributes):
        return own, against
    values = {}
    for key, value in _ATTRIBUTE.findall(attributes):
        values.setdefault(key.lower(), html.unescape(value.strip("\"'")))
    role = values.get("role", "").lower()
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true" or _NOT_SHOWN.search(values.get("style", "")):
        return REFUSED, frozenset(["hidden"])
    named = [w.lower() for w in _NAME_WORDS.findall(f"{values.get('class', '')} {values.get('id', '')}")]
    against = frozenset(named) & _REFUSED_WORDS if name not in ("html", "body") else against
    if role in _REFUSED_ROLES or against:
        return REFUSED, against
    if role in ("main", "article") or values.get("itemprop", "").lower() == "articlebody":
        return MARKED, against
    if not own and name in ("div", "section", "td"):
        return (HEADER if "header" in named else NAMED if _NAMED_WORDS.intersection(named) else own), against
    return own, against


class Page:
    """Blocks and elements of a page, read once and leniently, as browsers do."""

    def __init__(self, source: str):
        self.elements: list[Element] = [Element("", -1, 0.0)]
        self.blocks: list[Block] = []
        self.open: list[int] = [0]
        self.counts: Counter = Counter()
        self.block: Block | None = None
        self.link = False
        self._read(source)
        for block in self.blocks:
            block.text = " ".join("".join(block.pieces).split())
        self.blocks = [b for b in self.blocks if b.text]
        self._count_marks()

    def _read(self, source: str) -> None:
        at, search, n = 0, _TOKEN.search, len(source)
        while at < n:
            token = search(source, at)
            if token is None:
                self._text(source[at:])
                return
            if token.start() > at:
                self._text(source[at:token.start()])
            at = token.end()
            end, start = token[1], token[2]
            if end:
                self._end(end.lower())
            elif start:
                name = start.lower()
                if name in _SKIPPED:
                    if name in _RAW or not token[0].endswith("/>"):
                        at = self._after(source, name, at)
                else:
                    self._start(name, token[3])

    @staticmethod
    def _after(source: str, name: str, at: int) -> int:
        """Where the contents of an element end that are not shown; nested ones of its name end first."""
        depth = 1
        for mark in re.compile(rf"<(/?){name}(?=[\s/>])[^>]*>?", re.I).finditer(source, at):
            depth += -1 if mark[1] else name not in _RAW
            if not depth:
                return mark.end()
        return len(source)

    def _text(self, piece: str) -> None:
        if self.block is None:
            if piece.isspace():
                return
            self.block = Block(self.open[-1])
            self.blocks.append(self.block)
        piece = html.unescape(piece) if "&" in piece else piece
        self.block.pieces.append(piece)
        if self.link:
            self.block.linked += len(piece)

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            if self.block is not None:
                self.block.pieces.append(" ")
            return
        if name == "a":
            self.link = True
        block = name in _BLOCKS
        if block:
            self.block = None
            if name == "hr":
                return
            if self.counts["head"]:
                self._close("head", ())
            if self.counts["p"]:
                self._close("p", _BLOCKS - {"p"})
            for other in _CLOSES.get(name, ()):
                if self.counts[other]:
                    self._close(other, _ENDS_SCOPE)
        if name in _EMPTY:
            return
        own, against = _says(name, attributes) if len(attributes) < 400 else _says.__wrapped__(name, attributes)
        if not block and own >= 0:
            return
        parent = self.open[-1]
        if own == HEADER and self.elements[parent].inside:
            own = 0.0
        self.elements.append(Element(name, parent, own, against, saved=None if block else self.block,
                                     inside=own > 0 or own == 0 and self.elements[parent].inside))
        if not block:
            self.block = None
        self.open.append(len(self.elements) - 1)
        self.counts[name] += 1

    def _end(self, name: str) -> None:
        if name == "a":
            self.link = False
        if self.counts[name]:
            self._close(name, ())
        elif name in _BLOCKS:
            self.block = None

    def _close(self, name: str, within) -> None:
        """End the innermost element of a name, with those open inside it, unless one of ``within`` is in between."""
        for k in range(len(self.open) - 1, 0, -1):
            other = self.elements[self.open[k]].name
            if other == name:
                break
            if other in within:
                return
        else:
            return
        saved = None
        for e in self.open[k:]:
            self.counts[self.elements[e].name] -= 1
        if name not in _BLOCKS:
            saved = self.elements[self.open[k]].saved
        else:
            self.link = False
        del self.open[k:]
        self.block = saved

    def _count_marks(self) -> None:
        """What each element holds; one that speaks against its contents but holds the page's main, or all its articles and a title, is a wrapper."""
        for e in range(len(self.elements) - 1, 0, -1):
            element = self.elements[e]
            up = self.elements[element.parent]
            up.articles += element.articles + (element.name == "article" and element.own > 0)
            up.mains += element.mains + (element.name != "article" and element.own >= MARKED)
            up.titles += element.titles + (element.name == "h1")
        for element in self.elements[1:]:
            holds_all = element.articles and element.articles == self.elements[0].articles and element.titles
            if (element.mains or holds_all) and (element.name == "form" or element.words - {"hidden"}) and element.name not in ("nav", "aside", "footer"):
                element.own = max(element.own, 0.0)

    def evidence(self) -> list[float]:
        """For each block, what the elements around it say: one against it outweighs all for it."""
        around = [0.0] * len(self.elements)
        for e, element in enumerate(self.elements[1:], 1):
            above = around[element.parent]
            around[e] = above if above < 0 else element.own if element.own < 0 else max(above, element.own)
        best = max(around)
        outside = OUTSIDE_MARKED if best >= MARKED else OUTSIDE_NAMED if best >= NAMED else 0.0
        return [around[b.element] or outside for b in self.blocks]


def features(page: Page, block: Block) -> list[str]:
    """What the text of a block looks like."""
    words = block.text.split(" ")
    share = block.linked / max(1, len(block.text))
    return [f"linked {0 if not share else 1 if share < 0.34 else 2 if share < 0.8 else 3}", f"words {min(7, len(words).bit_length())}",
            f"tag {_TEXT_TAGS.get(page.elements[block.element].name, 'other')}", f"ends {block.text[-1] in '.!?…:;。！？'}",
            f"commas {min(3, block.text.count(', '))}", f"sign {_SIGNS.search(block.text) is not None}"]


def fit(pages: DataFrame, column: str = "html", at_most: int = 5_000) -> dict[str, float]:
    """Log odds of each feature, from the blocks that their elements mark clearly.

    Learns from at most ``at_most`` different pages, chosen by a hash of the page. The number of features is
    fixed, and so is what the driver receives. Features never seen, and all of an empty table, say
    nothing.
    """
    hashed = pages.select(F.xxhash64(column).alias("hash"), F.col(column))
    last = hashed.select("hash").distinct().orderBy("hash").limit(at_most).agg(F.max("hash")).first()[0]
    sample = hashed.where(F.col("hash") <= F.lit(last)).groupBy("hash").agg(F.first(column).alias(column)).select(column)

    def count(batches):
        sums = Counter()
        for batch in batches:
            for part in slices(batch, column):
                for source in part.column(0).to_pylist():
                    page = Page(source or "")
                    for block, said in zip(page.blocks, page.evidence()):
                        if said >= MARKED or said <= REFUSED:
                            sums.update((f, said > 0) for f in features(page, block))
        yield pa.RecordBatch.from_pylist([{"feature": f, "content": good, "n": n} for (f, good), n in sums.items()],
                                         pa.schema([("feature", pa.string()), ("content", pa.bool_()), ("n", pa.int64())]))

    seen = sample.mapInArrow(count, "feature string, content boolean, n long").groupBy("feature", "content").agg(F.sum("n"))
    sums = {(f, good): n for f, good, n in seen.collect()}
    whole = {good: max((sum(n for (f, g), n in sums.items() if g == good and f.startswith("words ")), 1)) for good in (True, False)}
    return {f: math.log((sums.get((f, True), 0) + 1) / (whole[True] + 2)) - math.log((sums.get((f, False), 0) + 1) / (whole[False] + 2))
            for f in {f for f, _ in sums}}


def content_side(supplies: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Vertices on the content side of a minimum cut; of equal cuts, the one with most of them there.

    ``supplies`` are capacities from the source (positive) or to the sink (negative); ``edges`` are
    (a, b, capacity) in both directions. Maximum flow by blocking flows on level graphs.
    """
    n = len(supplies)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[int] = []

    def join(a: int, b: int, there: int, back: int) -> None:
        graph[a].append(len(to))
        graph[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for v, supply in enumerate(supplies):
        if supply > 0:
            join(source, v, supply, 0)
        elif supply < 0:
            join(v, sink, -supply, 0)
    if min(supplies, default=0) >= 0:
        return [True] * n
    for a, b, capacity in edges:
        join(a, b, capacity, capacity)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        layer = [source]
        while layer and level[sink] < 0:
            following = []
            for a in layer:
                for e in graph[a]:
                    if room[e] and level[to[e]] < 0:
                        level[to[e]] = level[a] + 1
                        following.append(to[e])
            layer = following
        if level[sink] < 0:
            break
        turn = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                short = next(k for k, e in enumerate(path) if not room[e])
                at = to[path[short] ^ 1]
                del path[short:]
                continue
            while turn[at] < len(graph[at]):
                e = graph[at][turn[at]]
                if room[e] and level[to[e]] == level[at] + 1:
                    path.append(e)
                    at = to[e]
                    break
                turn[at] += 1
            else:
                if at == source:
                    break
                level[at] = -1
                at = to[path.pop() ^ 1]
    reaches = [False] * (n + 2)
    reaches[sink] = True
    layer = [sink]
    while layer:
        b = layer.pop()
        for e in graph[b]:
            if room[e ^ 1] and not reaches[to[e]]:
                reaches[to[e]] = True
                layer.append(to[e])
    return [not r for r in reaches[:n]]


def label(page: Page, odds: dict[str, float]) -> list[bool]:
    """Whether each block of a page is content."""
    supplies = []
    for block, said in zip(page.blocks, page.evidence()):
        looks = sum(odds.get(f, 0.0) for f in features(page, block))
        supplies.append(round(_UNIT * (said + max(-MOST, min(MOST, looks)))))
    n = len(supplies)
    if min(supplies, default=0) >= 0:
        return [True] * n
    # elements are vertices without an opinion; one with a single part is left out, since edges in a row act as one
    parts: Counter = Counter()
    for block in page.blocks:
        e = block.element
        while e > 0:
            parts[e] += 1
            if parts[e] > 1:
                break
            e = page.elements[e].parent
    vertex = {e: n + k for k, e in enumerate(e for e, m in parts.items() if m > 1)}
    edges = []
    for below, e in [*((b, block.element) for b, block in enumerate(page.blocks)), *((v, page.elements[e].parent) for e, v in vertex.items())]:
        while e > 0 and e not in vertex:
            e = page.elements[e].parent
        if e > 0:
            edges.append((below, vertex[e], int(_UNIT * INSIDE)))
    parent = [page.elements[b.element].parent for b in page.blocks]
    for b in range(n - 1):
        one, two = page.blocks[b].element, page.blocks[b + 1].element
        side = BESIDE if one == two else NEAR if parent[b] == parent[b + 1] or two == parent[b] or one == parent[b + 1] else FAR
        edges.append((b, b + 1, int(_UNIT * side)))
    return content_side(supplies + [0] * len(vertex), edges)[:n]


def extract(pages: DataFrame, odds: dict[str, float], column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Adds ``text``, the blocks of the main text, one a line, and ``n_chars``, its code points.

    White space within a block is one space; character references are decoded. A null or empty
    page, and one without content, has an empty text. Unclosed and misplaced tags are read as
    browsers do. Each row is judged by itself, whatever its id; pages are read whole. Input
    columns called like the new ones are replaced; ``keep`` names the input columns of the result
    (all, if not given).
    """
    def text(source: str | None) -> str:
        page = Page(source or "")
        return "\n".join(block.text for block, good in zip(page.blocks, label(page, odds)) if good)

    def work(sources):
        texts = [text(s) for s in sources]
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return map_texts(pages, column, lambda: work, [StructField("text", StringType(), False), StructField("n_chars", LongType(), False)], keep)
