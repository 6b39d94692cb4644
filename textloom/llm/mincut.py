"""Main text of HTML by minimum-cut labelling of its text blocks.

A tolerant scanner splits a page into blocks of text with their places in the tree. A classifier's
costs for content and for boilerplate become a block's capacities from the source and to the sink;
neighbours in page order, and blocks near each other in the tree, are tied by edges whose capacity
is the price of labelling them apart. The minimum cut is the labelling of least cost: blocks left
on the source's side are the text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import kept

#: Elements whose content is no text of the page, whatever stands in it.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas head title textarea select option datalist".split())
#: Of these, elements whose content is not markup: only their own end tag ends them.
RAW = frozenset("script style textarea title iframe noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr nobr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the first kind ends an open element of the second, up to the nearest of the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
ENDS_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

#: Evidence in log-odds that a block under the element is boilerplate (positive) or text (negative).
ELEMENT_ODDS = {"nav": 8.0, "footer": 8.0, "aside": 7.0, "form": 7.0, "button": 8.0, "menu": 7.0, "dialog": 7.0, "fieldset": 6.0, "header": 3.0, "article": -4.0, "main": -3.0}
ROLE_ODDS = {"navigation": 8.0, "banner": 5.0, "contentinfo": 8.0, "complementary": 7.0, "search": 8.0, "form": 7.0, "menu": 7.0, "menubar": 7.0, "dialog": 7.0, "alertdialog": 7.0, "alert": 6.0, "main": -3.0, "article": -4.0}
#: Log-odds of a header that is the page's own, not an article's or a section's.
BANNER_ODDS = 6.0
#: A word of a class or id, in several languages, and its log-odds.
NAME_ODDS = dict.fromkeys("ad ads advert advertisement adverts adsense banner sponsor sponsored promo promotion outbrain taboola werbung anzeige anzeigen publicite annonce publicidad anuncio pubblicita reclame reklama".split(), 8.0)
NAME_ODDS |= dict.fromkeys("comment comments disqus replies respond reply kommentar kommentare commentaire commentaires comentario comentarios commento commenti reacties komentarze".split(), 8.0)
NAME_ODDS |= dict.fromkeys("cookie cookies consent gdpr notice notices notification disclaimer disclosure announcement popup modal overlay paywall hinweis".split(), 7.5)
#: Names up to here hold their content whatever share of the page that is.
_FIRM = frozenset(NAME_ODDS)
NAME_ODDS |= dict.fromkeys("nav navbar navi navigation navigacion navigazione menu menue menü breadcrumb breadcrumbs pagination pager toc skip".split(), 7.0)
NAME_ODDS |= dict.fromkeys("footer foot fusszeile fuss pied piedepagina copyright legal impressum colophon".split(), 7.0)
NAME_ODDS |= dict.fromkeys("sidebar side aside seitenleiste barre barra widget rail related recommended recommendations popular trending tags share sharing social newsletter subscribe signup login search suche recherche buscar masthead".split(), 6.5)
NAME_ODDS |= dict.fromkeys("header topbar toolbar kopfzeile".split(), 2.5)
NAME_ODDS |= dict.fromkeys("article artikel articulo articolo content inhalt contenu contenido post entry body story text main prose beitrag".split(), -2.0)
#: A compound name with one of these tells of the page's state or layout, not of what the element holds.
_STATE = frozenset("has with without no not is layout template theme col cols columns".split())
_NAMES = re.compile(r"[^\W\d_A-Z]+|[A-Z][^\W\d_A-Z]*")
#: Elements that hold boilerplate for certain take away what their surroundings say for text, from these odds on.
_CERTAIN = 5.0
#: Share of the page's running text (blocks of ten words, outside links) from which a form, or an element named like
#: boilerplate, is but a wrapper around the page.
WRAPS = 0.9
_RUNNING_WORDS = 10
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Costs of labelling apart neighbours in page order, siblings, and cousins at each further step up.
ORDER_WEIGHT, SIBLING_WEIGHT, DECAY = 0.6, 1.2, 0.5
#: Blocks this many places apart are tied if they are near in the tree.
REACH = 3
_PRIOR = -0.6

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")


@dataclass
class Evidence:
    """What an element's own tag says: log-odds for boilerplate by its kind and by its names, and for text (negative)."""

    kind: float = 0.0
    named: float = 0.0
    text: float = 0.0
    firm: bool = True


_NONE = Evidence()


@dataclass
class Node:
    """An open element: its name, its parent and its own evidence; once the page is read, its log-odds."""

    name: str
    parent: Node | None
    own: Evidence
    skipped: bool
    depth: int
    #: Letters of running text below, and whether an element of the page's main structure is.
    running: int = 0
    holds: bool = False
    #: Whether it is inside an element that has a header of its own.
    within: bool = False
    boiler: float = 0.0
    content: float = 0.0
    #: Whether certain boilerplate begins here, so that nothing inside is near what is outside.
    fence: bool = False

    @property
    def odds(self) -> float:
        return self.boiler + self.content


@dataclass
class Block:
    """A run of text that no block element interrupts."""

    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    #: Words, counted over the whole text as far as they make a difference.
    words: int = 0

    @property
    def imprint(self) -> bool:
        """Whether it begins with a copyright line."""
        return _IMPRINT.match(self.text) is not None


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)} if source.strip(" /\t\n\r\f") else {}


def _evidence(name: str, attributes: dict[str, str]) -> Evidence:
    """Names of the page's root say nothing; in a compound name what is boilerplate outweighs what is text, as in
    article-comments; separate names that contradict each other, as in "widget article", nearly cancel out."""
    element = ELEMENT_ODDS.get(name, 0.0)
    role = ROLE_ODDS.get(attributes.get("role", "").lower(), 0.0) if attributes else 0.0
    kind, content = max(element, role, 0.0), min(element, role, 0.0)
    named, firm = 0.0, True
    if attributes and name not in ("html", "body"):
        for compound in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
            words = {w.lower() for w in _NAMES.findall(compound)} | {compound.lower()}
            if words & _STATE:
                continue
            odds = [NAME_ODDS[w] for w in words if w in NAME_ODDS]
            if odds and max(odds) > named:
                named, firm = max(odds), not words.isdisjoint(_FIRM)
            elif odds and max(odds) < 0:
                content = min(content, min(odds))
    if named and content:
        named = max(0.0, named - 6.0)
    return Evidence(kind, named, content, firm) if kind or named or content else _NONE


def _settle(nodes: list[Node], blocks: list[Block]) -> None:
    """Every node's log-odds, handed down from the root; parents come before their children in ``nodes``."""
    for b in blocks:
        if b.words >= _RUNNING_WORDS:
            b.node.running += max(0, len(b.text) - b.linked)
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.running += node.running
            node.parent.holds |= node.holds or node.name in _STRUCTURE
    whole = nodes[0].running
    for node in nodes[1:]:
        own, up = node.own, node.parent
        node.within = up.within or up.name in _SECTIONS
        wraps = whole > 0 and node.running > WRAPS * whole
        kind = 0.0 if node.name == "form" and (wraps or node.holds) else own.kind
        named = own.named if own.firm or not wraps else 0.0
        evidence = max(kind, named)
        if node.name == "header" and not wraps and not node.within:
            evidence = max(evidence, BANNER_ODDS)
        node.fence = evidence >= _CERTAIN
        node.boiler = max(up.boiler, evidence)
        # Inside certain boilerplate nothing speaks for text any more: a card in a sidebar, an aside in an article.
        node.content = 0.0 if evidence >= _CERTAIN else up.content if up.boiler >= _CERTAIN else min(up.content, own.text)


#: Elements whose header is theirs and not the page's.
_SECTIONS = frozenset("article main section aside nav".split())
#: Elements that no form holds but one around the whole page.
_STRUCTURE = frozenset("article main nav header footer aside h1".split())


def blocks_of(source: str) -> list[Block]:
    """The blocks of a page in order, text decoded and white space as one space; blocks without text are left out."""
    root = Node("", None, _NONE, False, 0)
    node, blocks, current, nodes = root, [], None, [root]
    links = at = 0
    opened: Counter[str] = Counter()  # open elements by name, so that no search for one that isn't there climbs the tree

    def text(piece: str) -> None:
        nonlocal current
        if node.skipped or not piece:
            return
        if current is None:
            if not piece.strip():
                return
            owner = node
            while owner.name in INLINE and owner.parent is not None:
                owner = owner.parent
            current = Block(owner)
            blocks.append(current)
        current.parts.append(piece)
        if links:
            current.linked += len(piece)

    def shut(upto: Node) -> None:
        nonlocal node, links, current
        while node is not upto:
            opened[node.name] -= 1
            if node.name == "a":
                links -= 1
            elif node.name not in INLINE:
                current = None
            node = node.parent

    def nearest(names: set[str], stop: set[str] | frozenset[str]) -> Node | None:
        own = node if any(opened[x] for x in names) else root
        while own is not root and own.name not in stop:
            if own.name in names:
                return own
            own = own.parent
        return None

    size = len(source)
    while at < size:
        m = _TOKEN.search(source, at)
        if m is None:
            text(html.unescape(source[at:]))
            break
        if m.start() > at:
            text(html.unescape(source[at : m.start()]))
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        name = m[2].lower()
        if m[1]:
            own = node if opened[name] else root
            while own is not root and own.name != name:
                own = own.parent
            if own is not root:
                shut(own.parent)
            if name not in INLINE:
                current = None
            continue
        if name == "br":
            if not node.skipped and current is not None:
                current.parts.append("\n")
            continue
        if name not in INLINE:
            current = None
        if name in VOID:
            continue
        if name in ENDS_P and (p := nearest({"p"}, {"button", "table", "td", "th", "caption"})):
            shut(p.parent)
        elif name in CLOSES and (old := nearest(*CLOSES[name])):
            shut(old.parent)
        elif name == "a" and (old := nearest({"a"}, ENDS_P)):
            shut(old.parent)
        attributes = _attributes(m[3])
        hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or bool(_HIDDEN.search(attributes.get("style", "")))
        closed = m[3].endswith("/") and name in ("svg", "math")
        if not closed:
            node = Node(name, node, _evidence(name, attributes), node.skipped or name in SKIPPED or hidden, node.depth + 1)
            nodes.append(node)
            opened[name] += 1
            links += name == "a"
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else size
            shut(node.parent)
    for b in blocks:
        b.text = _SPACE.sub(" ", "".join(b.parts)).strip()
        b.words = sum(1 for _ in islice(_WORD.finditer(b.text), _MOST_WORDS))
    blocks = [b for b in blocks if b.text]
    _settle(nodes, blocks)
    return blocks


_WORD = re.compile(r"\w+")
#: From so many words on their number makes no difference to the costs, so no more are counted.
_MOST_WORDS = 60


_IMPRINT = re.compile(r"(?:copyright\s*)?©", re.I)


def costs(block: Block) -> tuple[float, float]:
    """(cost of calling the block boilerplate, cost of calling it text): minus the logarithms of a logistic classifier's chances."""
    n = len(block.text)
    words = block.words
    linked = min(1.0, block.linked / n)
    odds = _PRIOR + block.node.odds + 6.0 * (linked - 0.15) - 0.5 * min(4.0, math.log2(1 + words / 4))  # 4 from 60 words on
    if block.text[-1] in ".!?…:;\"'”»" and words > 6:
        odds -= 0.8
    if block.node.name in ("p", "blockquote", "pre", "h1", "h2", "h3"):
        odds -= 0.8
    if "©" in block.text:
        odds += 6.0 if block.imprint else 3.0
    keep = 1 / (1 + math.exp(max(-30.0, min(30.0, odds))))
    return -math.log(max(1e-9, 1 - keep)), -math.log(max(1e-9, keep))


def proximity(a: Node, b: Node) -> float:
    """1 for siblings (and a block's own element), less by DECAY for each further step to the common ancestor; 0 from
    nine steps on, where less than a hundredth would be left, and across the border of certain boilerplate."""
    steps = 0
    while a is not b:
        if steps > 8:
            return 0.0
        lower = a if a.depth >= b.depth else b
        if lower.fence:
            return 0.0
        if lower is a:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return DECAY ** max(0, steps - 2)


def min_cut(content: list[float], boiler: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source's side of a minimum cut: labelled text.

    ``content`` is what cutting a node off the source costs, ``boiler`` what cutting it off the sink
    costs. Only what a node has too much or too little of one needs to flow: the rest is saturated at
    once. Dinic's blocking flows; ties go to boilerplate, as nodes that the source doesn't reach.
    """
    n = len(content)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to, room = [], []

    def add(u: int, v: int, there: float, back: float) -> None:
        heads[u].append(len(to))
        to.append(v)
        room.append(there)
        heads[v].append(len(to))
        to.append(u)
        room.append(back)

    for i in range(n):
        spare = content[i] - boiler[i]
        if spare > 0:
            add(source, i, spare, 0.0)
        elif spare < 0:
            add(i, sink, -spare, 0.0)
    for u, v, w in edges:
        add(u, v, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in heads[u]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        place = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(k for k, e in enumerate(path) if room[e] <= 1e-12)
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while place[u] < len(heads[u]):
                e = heads[u][place[u]]
                if room[e] > 1e-12 and level[to[e]] == level[u] + 1:
                    break
                place[u] += 1
            if place[u] < len(heads[u]):
                path.append(heads[u][place[u]])
                u = to[path[-1]]
            elif path:
                level[u] = -1
                u = to[path.pop() ^ 1]
            else:
                break


def label(blocks: list[Block]) -> list[bool]:
    """Whether each block is text."""
    priced, imprints = [costs(b) for b in blocks], [b.imprint for b in blocks]
    edges = []
    for i, a in enumerate(blocks):
        for j in range(i + 1, min(len(blocks), i + 1 + REACH)):
            near = proximity(a.node, blocks[j].node) if imprints[i] == imprints[j] else 0.0
            weight = SIBLING_WEIGHT * near / (j - i) + (ORDER_WEIGHT if j == i + 1 else 0.0)
            if weight > 0.05:
                edges.append((i, j, weight))
    return min_cut([p[0] for p in priced], [p[1] for p in priced], edges)


def main_text(source: str | None) -> str:
    """The text blocks of a page joined by line feeds; empty if there are none."""
    blocks = blocks_of(source or "")
    return "\n".join(b.text for b, keep in zip(blocks, label(blocks), strict=True) if keep)


def extract(df: DataFrame, source: str = "html", carry: list[str] | None = None) -> DataFrame:
    """The carried columns with ``text`` and ``n_chars``, a row per row.

    A null or empty page, and one of boilerplate alone, has an empty text. Pages are read whole at any length,
    and damaged markup as far as it goes. Where both labels cost the same, a block is boilerplate. Repeated rows
    give equal results; columns that aren't carried are left out whatever their names.
    """
    carry = kept(carry, "text", "n_chars")
    narrow = df.select(*carry, F.col(source).alias("__html"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in narrow.dtypes if c != "__html"), "text string, n_chars bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(len(carry))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*carry, "text", "n_chars"])

    return narrow.mapInArrow(run, schema)
