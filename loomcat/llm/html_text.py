"""Main text of web pages by a minimum cut.

A page is cut into blocks: the text between tags of block elements. A linear classifier gives each block
its log odds of being content, from its text (words, share of links, sentence end, heading, list item), its tag path
(menu, footer, sidebar, form, page header) and the class and id words of the elements around it. They are the capacities
to the two terminals. Neighbours in page order and blocks of one kind under one parent are joined by edges whose
capacity falls with the distance in the tree, and each block is tied to a node that stands for the page's main element, if it
is within, or for the rest of the page. Edges and ties are as strong as the costs of a block, so that the minimum
cut decides: a short line goes with the text around it, and a block that reads like text but stands apart goes.

The page's main element is the one that holds most text among article, main and elements whose
class or id names an article; class words of elements around it are not inherited by what is in it.
A class such as has-sidebar is a state and not a place, and one with unknown words (legal-analysis, related-work) counts little.

The weights of the text features are fitted on the blocks of at most `SAMPLE` pages (those with the least hash of
their id), counted by cells of the features: what is in the main element against what is in a menu, footer, sidebar or form.
Tag path and class words have the weights below.

Defined results: null and empty pages, and pages without content, have the empty text. A tag
or comment that the page's end cuts off is dropped. Text in no block element counts as a block
of its parent. Pages are independent; ids may repeat or be null. Columns other than the id, url and html aren't looked at.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcat.llm.common import mapped

SAMPLE = 300
# Names of elements.
SILENT = frozenset("script style noscript template svg head title iframe object embed canvas audio video select option datalist textarea".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br button cite code data del dfn em font i img ins kbd label map mark math mi mn mo mrow msup msub mfrac mtext msqrt q rp rt ruby s samp small span strike strong sub sup time tt u var wbr nobr input semantics annotation".split())
PLACES = frozenset("nav footer aside form menu dialog fieldset".split())
MAIN = frozenset("article main".split())
HEADERS = frozenset("header hgroup".split())
ITEMS = frozenset("li dt dd td th".split())
LINES = frozenset("p li dt dd pre blockquote h1 h2 h3 h4 h5 h6".split())
BOILER_WORDS = frozenset(
    "nav navbar navigation menu menubar footer topbar sidebar aside ad ads adv advert adverts advertisement sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay "
    "comment comments reply replies respond disqus share sharing social related recommended breadcrumb breadcrumbs pagination pager subscribe newsletter signup login search toolbar widget copyright disclaimer skip".split()
)
HEAD_WORDS = frozenset("header masthead banner".split())
MAIN_WORDS = frozenset("content article post entry story main".split())
LAYOUT_WORDS = frozenset(
    "wrapper wrap container inner outer box block list item items link links left right top bottom primary secondary site page global mobile desktop fixed sticky area region section panel bar button buttons form widgets text title "
    "head body row col column group count meta holder slot unit inline big small large default first last posts articles stories thread id the of and content article post entry story main icons icon policy banner header".split()
)
STATES = frozenset("has with no is js without hide show hidden not".split())
HEADING_WORDS = frozenset("comment comments reply replies responses related share newsletter subscribe advertisement sponsored".split())
HEADING_FILL = frozenset("leave a add your this our the to articles posts stories links post more reader readers also you may like".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
# Weights of the tag path and of class words, in log odds.
PLACE, HEADER, CLASS, HIDDEN, SHARE = -4.5, -3.0, -5.5, -5.0, 1.0
# Capacities of the ties to the main element, to one around it, and to the rest of the page.
TO_MAIN, TO_OUTER, TO_REST, SURE = 1.5, 0.6, 2.8, 1e6
LEAST, MOST = -3.0, 2.0  # bounds of what a block's text can add
ADJACENT, ALIKE, SIBLING, DECAY, FAR = 0.5, 0.8, 0.5, 0.5, 8
SOME_WORDS, SOME_SHARE, MOST_SHARE = 20, 0.3, 0.6
DEFAULT = np.array([-1.6, 0.9, -3.5, 0.7, 0.8, -0.3])  # constant, log words, share of links, sentence end, heading, list item

_TOKEN = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(?=[/a-zA-Z])[^>]*(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Element:
    """place: a menu, footer ...; strength: how surely its class or id names boilerplate, 0 to 1."""

    name: str
    above: int
    depth: int
    kind: str = ""
    main: bool = False
    place: bool = False
    header: bool = False
    hidden: bool = False
    strength: float = 0.0
    words: int = 0


@dataclass
class Block:
    text: str
    element: int
    heading: int
    linked: int
    words: int
    cost: float = 0.0


def _strength(name: str) -> tuple[float, bool, bool]:
    """Of one class or id: how surely it names boilerplate, whether a page header, whether the main element."""
    words = [w.lower() for w in _NAME.findall(name)]
    if not words or words[0] in STATES:
        return 0.0, False, False
    known = all(w in BOILER_WORDS or w in LAYOUT_WORDS or w in HEAD_WORDS or w.isdigit() or len(w) == 1 for w in words)
    if any(w in BOILER_WORDS for w in words):
        return (1.0 if known else 0.35), False, False
    header = known and any(w in HEAD_WORDS for w in words)
    return 0.0, header, known and not header and any(w in MAIN_WORDS for w in words)


def _opened(name: str, attributes: str, above: int, depth: int) -> Element:
    e = Element(name, above, depth, name, name in MAIN, name in PLACES, name in HEADERS)
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        value, key = "".join(values), key.lower()
        if key == "hidden":
            e.hidden = value.lower() in ("", "hidden", "true")
        elif key == "role":
            e.main, e.place = e.main or value.lower() in ("main", "article"), e.place or value.lower() in ROLES - {"banner"}
            e.header = e.header or value.lower() == "banner"
        elif key == "itemprop":
            e.main = e.main or value.lower() == "articlebody"
        else:
            if key == "class":
                e.kind = f"{name} {value}"
            for one in value.split():
                strength, header, main = _strength(one)
                e.strength, e.header, e.main = max(e.strength, strength), e.header or header, e.main or main and name not in ("body", "html")
    if e.strength == 1.0 or e.header and name not in MAIN:
        e.main = False
    return e


def blocks(page: str) -> tuple[list[Element], list[Block]]:
    """The block elements, in page order, and the blocks of text."""
    elements: list[Element] = [Element("", -1, 0)]
    out: list[Block] = []
    stack: list[int] = [0]
    parts: list[str] = []
    at = silent_until = 0
    heading, link, linked = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, stack[-1], heading, min(linked, len(text)), text.count(" ") + 1))
        parts.clear()
        linked = 0

    for token in _TOKEN.finditer(page):
        begin = token.start()
        if begin < silent_until:
            continue
        if begin > at:
            parts.append(page[at:begin])
            linked += (begin - at) * (link > 0)
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name, closing = name.lower(), bool(token[1])
        if name in SILENT and not closing and name != "head":
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            if end or name in RAW:
                at = silent_until = end.end() if end else len(page)
            continue
        if name in INLINE:
            if name in ("a", "button"):
                link = max(0, link + (-1 if closing else 1))
            elif name == "br":
                parts.append(" ")
            continue
        flush()
        if name in VOID or name == "head":
            continue
        link = 0
        titled = len(name) == 2 and name[0] == "h" and name[1].isdigit()
        heading = int(name[1]) if titled and not closing else 0
        if closing:
            if any(elements[i].name == name for i in stack[1:]):
                while elements[stack.pop()].name != name:
                    pass
            continue
        if name == "body":
            elements[0].kind = "body"
        while len(stack) > 1 and (elements[stack[-1]].name in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or name == elements[stack[-1]].name and name in ("li", "dt", "dd", "tr", "td", "th", "option")):
            stack.pop()
        if name not in ("html", "body"):
            elements.append(_opened(name, token[3], stack[-1], len(stack)))
            stack.append(len(elements) - 1)
    if at < len(page):
        parts.append(page[at:])
    flush()
    return elements, out


def features(block: Block, element: Element) -> tuple[float, ...]:
    """The text features, rounded, so that they fall into few cells."""
    share = round(4 * block.linked / max(1, len(block.text))) / 4
    return (1.0, round(4 * min(4.25, math.log1p(block.words))) / 4, share, float(block.text[-1] in ".!?…:;\"”»"), float(block.heading > 0), float(element.name in ITEMS))


def _chain(elements: list[Element], i: int) -> Iterator[int]:
    while i >= 0:
        yield i
        i = elements[i].above


def _within(elements: list[Element], i: int, other: int) -> bool:
    while elements[i].depth > elements[other].depth:
        i = elements[i].above
    return i == other


def _main_elements(elements: list[Element]) -> tuple[list[int], set[int]]:
    """The page's main elements, and those around them."""
    hard = [False] * len(elements)  # in a menu, footer ... or comments
    for i, e in enumerate(elements):
        hard[i] = e.place or e.strength == 1.0 or e.hidden or e.above >= 0 and hard[e.above]
    found = [i for i, e in enumerate(elements) if e.main and e.words and not hard[i]]
    if not found:
        return [], set()
    best = max(found, key=lambda i: (elements[i].words, -i))
    for i in found:  # an inner one that holds most of it
        if i > best and elements[i].words >= MOST_SHARE * elements[best].words and _within(elements, i, best):
            best = i
    around, top = set(_chain(elements, elements[best].above)), []
    for i in found:  # further ones beside it
        if i == best or elements[i].words >= elements[best].words / 4 and i not in around and not _within(elements, i, best) and not (top and _within(elements, i, top[-1])):
            top.append(i)
    return top, around


def _mark(elements: list[Element], found: list[Block]) -> tuple[list[int], set[int], int]:
    """Counts words of text and settles what classes and headings say; the main elements, those around them, and all words of text."""
    for b in found:
        elements[b.element].words += round(b.words * (1 - b.linked / max(1, len(b.text))))
    for e in reversed(elements[1:]):
        elements[e.above].words += e.words
    total = elements[0].words
    first: dict[int, Block] = {}
    for b in found:
        first.setdefault(elements[b.element].above if b.heading else b.element, b)
    for i, b in first.items():  # a part that begins with a heading such as "3 Comments"
        words = {w.lower() for w in _NAME.findall(b.text)} if b.heading > 1 and b.words <= 5 else set()
        if i and words & HEADING_WORDS and all(w in HEADING_WORDS or w in HEADING_FILL or w.isdigit() for w in words):
            elements[i].strength = 1.0
    holds = [False] * len(elements)
    for i in range(len(elements) - 1, 0, -1):
        holds[i] = holds[i] or elements[i].main
        holds[elements[i].above] = holds[elements[i].above] or holds[i]
    for i, e in enumerate(elements):
        if e.strength and e.words >= MOST_SHARE * total and (holds[i] or not holds[0]):
            e.strength = 0.0  # what holds most of the page is no part beside it
    return *_main_elements(elements), total


def costs(elements: list[Element], found: list[Block], weights: np.ndarray) -> list[float]:
    """Sets each block's cost, its log odds of being content; each block's tie: to the main element if above 0, to the rest if below."""
    top, around, total = _mark(elements, found)
    outer = {i for i in around if elements[i].main}
    enough = bool(top) and sum(elements[i].words for i in top) >= min(SOME_WORDS, SOME_SHARE * total)
    part = [elements[b.element].above if elements[b.element].name in LINES else b.element for b in found]
    own: Counter = Counter()  # words of text right within an element
    for b, i in zip(found, part, strict=True):
        own[i] += round(b.words * (1 - b.linked / max(1, len(b.text))))
    largest = max([1, *own.values()])
    tops, n = set(top), len(elements)
    inside = [0] * n  # 2: in a main element, 1: in one around it
    strength, header, place, hidden = [0.0] * n, [False] * n, [False] * n, [False] * n
    for i, e in enumerate(elements):
        up = e.above
        inside[i] = 2 if i in tops or up >= 0 and inside[up] == 2 else 1 if i in outer or up >= 0 and inside[up] == 1 else 0
        if i in tops or i in around or up < 0:  # nothing is inherited through the main element
            continue
        strength[i], place[i], hidden[i] = max(e.strength, strength[up]), e.place or place[up], e.hidden or hidden[up]
        header[i] = (e.header and not inside[i]) or header[up]
    w, ties = weights.tolist(), []
    for b, at in zip(found, part, strict=True):
        e, i = elements[b.element], b.element
        z = max(LEAST, min(MOST, sum(x * y for x, y in zip(w, features(b, e), strict=True))))
        if not top:  # the part that holds most text, where no element is named the main one
            z += SHARE * min(1.0, 2 * own[at] / largest) - SHARE / 2
        b.cost = z + CLASS * strength[i] + PLACE * place[i] + HEADER * header[i] + HIDDEN * hidden[i]
        ties.append(TO_MAIN if inside[i] == 2 else TO_OUTER if inside[i] == 1 else -TO_REST if enough else 0.0)
    return ties


def minimum_cut(excess: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side; excess: capacity from the source less that to the sink, after their direct flow."""
    n = len(excess)
    around: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, c in edges:
        if c > 0 and i != j:
            around[i][j] = around[i].get(j, 0.0) + c
            around[j][i] = around[j].get(i, 0.0) + c
    excess = list(excess)
    side: list[bool | None] = [None] * n
    ready = deque(range(n))
    while ready:  # a node that outweighs its edges is decided, and its edges become its neighbours' terminals
        i = ready.popleft()
        if side[i] is not None or abs(excess[i]) < sum(around[i].values()):
            continue
        side[i] = excess[i] > 0
        for j, c in around[i].items():
            excess[j] += c if side[i] else -c
            del around[j][i]
            ready.append(j)
        around[i] = {}
    rest = [i for i in range(n) if side[i] is None]

    def search() -> tuple[dict[int, int], int]:
        came = {i: -1 for i in rest if excess[i] > 1e-12}
        todo = deque(came)
        while todo:
            i = todo.popleft()
            if excess[i] < -1e-12:
                return came, i
            for j, c in around[i].items():
                if c > 1e-12 and j not in came:
                    came[j] = i
                    todo.append(j)
        return came, -1

    while rest:
        came, end = search()
        if end < 0:
            for i in rest:
                side[i] = i in came
            break
        route = [end]
        while came[route[-1]] >= 0:
            route.append(came[route[-1]])
        flow = min([excess[route[-1]], -excess[end], *(around[b][a] for a, b in zip(route, route[1:], strict=False))])
        for a, b in zip(route, route[1:], strict=False):
            around[b][a] -= flow
            around[a][b] += flow
        excess[route[-1]] -= flow
        excess[end] += flow
    return [bool(x) for x in side]


def _far(elements: list[Element], a: int, b: int) -> int:
    """Steps between two elements, FAR at most."""
    n = 0
    while a != b and n < FAR:
        if elements[a].depth >= elements[b].depth:
            a = elements[a].above
        else:
            b = elements[b].above
        n += 1
    return n


def smoothness(elements: list[Element], found: list[Block]) -> list[tuple[int, int, float]]:
    edges, last = [], {}
    for i, b in enumerate(found):
        e = elements[b.element]
        if i:
            before = elements[found[i - 1].element]
            edges.append((i - 1, i, (ADJACENT + ALIKE * (before.kind == e.kind)) * DECAY ** max(0, _far(elements, found[i - 1].element, b.element) - 2)))
        key = (e.above, e.kind)
        if key in last and last[key] < i - 1:
            edges.append((last[key], i, SIBLING))
        last[key] = i
    return edges


def labelled(page: str | None, weights: np.ndarray = DEFAULT) -> list[tuple[str, float, bool]]:
    """Text, cost and label of each block."""
    elements, found = blocks(page) if page else ([], [])
    if not found:
        return []
    ties, n = costs(elements, found, weights), len(found)
    edges = smoothness(elements, found) + [(i, n + (x < 0), abs(x)) for i, x in enumerate(ties)]
    sides = minimum_cut([*(b.cost for b in found), SURE, -SURE], edges)
    return [(b.text, b.cost, keep) for b, keep in zip(found, sides, strict=False)]


def main_text(page: str | None, weights: np.ndarray = DEFAULT) -> str:
    return "\n".join(text for text, _, keep in labelled(page, weights) if keep)


def cells(page: str | None) -> Counter:
    """Counts of the text features with labels, for blocks whose place tells their label."""
    elements, found = blocks(page) if page else ([], [])
    out: Counter = Counter()
    if not found:
        return out
    top, around, _ = _mark(elements, found)
    inside, beside = [False] * len(elements), [False] * len(elements)
    for i, e in enumerate(elements):
        up = e.above
        inside[i] = i in top or up >= 0 and inside[up]
        beside[i] = i not in top and i not in around and (e.place or e.strength == 1.0 or up >= 0 and beside[up])
    for b in found:
        if inside[b.element] != beside[b.element]:
            out[(*features(b, elements[b.element])[1:], inside[b.element])] += 1
    return out


def fit(counts: dict[tuple, int], penalty: float = 20.0, steps: int = 100) -> np.ndarray:
    """Weights of the text features from counts of cells with labels, by logistic regression with DEFAULT as the prior; DEFAULT if either label is missing."""
    keys = sorted(counts)
    n, y = np.array([counts[k] for k in keys], dtype=float), np.array([float(k[-1]) for k in keys])
    if not len(keys) or y.min() == y.max():
        return DEFAULT
    x = np.array([(1.0, *k[:-1]) for k in keys])
    n = n / np.where(y > 0, n[y > 0].sum(), n[y == 0].sum()) * n.sum() / 2  # both labels weigh the same
    w = DEFAULT.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + penalty * (w - DEFAULT)
        w = w - np.linalg.solve(x.T @ (x * (n * p * (1 - p))[:, None]) + penalty * np.eye(len(w)), grad)
        if np.abs(grad).max() < 1e-6 * n.sum():
            break
    return w


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: Counter = Counter()
        for page in batch.column(0):
            total += cells(page.as_py())
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays([*[pa.array([float(k[j]) for k in keys], pa.float64()) for j in range(6)], pa.array([total[k] for k in keys], pa.int64())], [*"abcdef", "n"])


def learn(rows: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights from rows (id, html): the sample's blocks are counted by cells, of which there is a fixed number."""
    keyed = rows.filter("id is not null and html is not null").select("id", F.xxhash64("id").alias("h"), F.xxhash64("html").alias("m"), "html")
    first = keyed.select("id", "h", "m").distinct().orderBy("h", "id", "m").limit(sample)
    pages = keyed.join(F.broadcast(first), ["id", "h", "m"], "left_semi").dropDuplicates(["id", "m"])
    got = mapped(pages.select("html"), _counted, "a double, b double, c double, d double, e double, f double, n long").groupBy(*"abcdef").agg(F.sum("n").alias("n")).collect()
    return fit({(*r[:5], bool(r.f)): r.n for r in got})


def _texts(weights: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(p.as_py(), weights) for p in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample: int = SAMPLE) -> DataFrame:
    """One row per row of pages: id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return mapped(rows, _texts(learn(rows.select("id", "html"), sample)), "id long, url string, text string, n_chars long")
