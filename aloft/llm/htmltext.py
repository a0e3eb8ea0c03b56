"""Operator 1: main text of HTML pages by minimum-cut labelling.

A page is cut into text blocks at block-level tags.  A classifier gives each block a net
cost from its containers (element, class, id, role), link density, length and punctuation.  What
the containers say is bounded, so that long prose and its neighbours outweigh a class word, and
lists of links lose inside an article; only elements marked as hidden count twice.  Positive costs become capacities from the source (content), negative ones capacities to the
sink (boilerplate).  Smoothness edges join neighbours in page order, and successive blocks of one
container (DOM proximity), weaker the further apart they are in the tree.  The minimum cut
(maximum flow) separates content from boilerplate.

Most blocks are settled before any flow is pushed: if a block's own capacity outweighs all its
open edges, it is on that side of a minimum cut, and its edges become capacities of its
neighbours.  Augmenting paths run on what is left.

Character references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined in page order by one space.  Script, style, template, head and the like never
give blocks; comments, doctype and CDATA marks are skipped.  Broken markup does no harm:
unclosed elements end with their parent, stray end tags are ignored, an unclosed tag at the end
is dropped.  Null, empty and text-free pages give an empty text, repeated rows each their own; a node whose
capacities balance is boilerplate.  Very long pages are cut whole, in one row.
"""

from __future__ import annotations

import re
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from aloft.llm.common import per_text

# Element names and class words of HTML documents.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
NO_TEXT = frozenset("head template svg math object canvas audio video select button option "
                    "datalist map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
                   "meter nobr output q rp rt ruby s samp small span strike strong sub sup time "
                   "tt u var wbr img input".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar "
                         "dialog alert alertdialog toolbar".split())
BOILER_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager topbar toolbar "
    "header masthead footer foot bottom sidebar side aside rail widget widgets ad ads adv advert "
    "adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay subscribe subscription "
    "newsletter signup login register share sharing social follow comment comments commentlist "
    "disqus reply replies respond discussion related recommended recommendations more-stories teaser "
    "teasers outbrain taboola copyright legal disclaimer tags taglist skip print tools search "
    "searchbox form paywall trending popular hidden".split())
CONTENT_WORDS = frozenset(
    "article articlebody article-body content contents post postbody entry story storybody body text "
    "main maincontent page prose hentry entry-content post-content".split())
#: the most that containers count: less than long prose or a list of links has for itself
CONTAINER = 3.7
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?P<end>>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?P<end2>>|\Z)", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAMES = re.compile(r"[a-z0-9]+(?:-[a-z0-9]+)*")
_SENTENCE = re.compile(r"[.!?…。！？]")
#: start tags that end an open element of the given names, up to the nearest of the stops
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
         "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
         "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "option": ({"option"}, {"select"})}


def _evidence(name: str, attrs: str, in_content: bool) -> int:
    """1: a content container, -1: a boilerplate container, -2: a hidden one, 0: none of these."""
    found = {}
    if attrs:
        for m in _ATTR.finditer(attrs):
            found[m[1].lower()] = (m[2] or m[3] or m[4] or "").lower()
        style = found.get("style", "").replace(" ", "")
        if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style \
                or "visibility:hidden" in style:
            return -2
        role = found.get("role", "")
        if role in BOILER_ROLES:
            return -1
        if role in ("main", "article") or "articlebody" in found.get("itemprop", ""):
            return 1
        if "comment" in found.get("itemprop", ""):
            return -1
    if name in BOILER_TAGS:
        return -1
    if name == "header":
        return 0 if in_content else -1
    if name in ("body", "html") or name in HEADINGS:
        return 0
    if found:
        words = set()
        for key in ("class", "id"):
            for w in _NAMES.findall(found.get(key, "").replace("_", "-")):
                words.add(w)
                parts = w.split("-")
                # "has-sidebar" says what is beside the element, not what it is
                if parts[0] not in ("has", "no", "with", "without", "hide", "js"):
                    words.update(parts)
        if words & BOILER_WORDS and not ({"header", "side"} >= words & BOILER_WORDS and in_content):
            return -1
        if name in CONTENT_TAGS or words & CONTENT_WORDS:
            return 1
    return 1 if name in CONTENT_TAGS else 0


class Block:
    __slots__ = ("text", "linked", "tag", "path", "evidence", "container")

    def __init__(self, text, linked, tag, path, evidence, container=None):
        self.text, self.linked, self.tag, self.path, self.evidence = text, linked, tag, path, evidence
        self.container = container


def blocks(html: str) -> list[Block]:
    """Text blocks in page order.  ``path``: ids of the open block-level elements; ``evidence``:
    of their containers, innermost last; ``container``: id of that one."""
    out: list[Block] = []
    stack: list[tuple[str, int, int, bool]] = []  # name, evidence, id, gives text
    parts: list[str] = []
    linked = links = serial = at = 0
    silent = 0
    tag = ""

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, min(1.0, linked / max(1, len(text))), tag,
                                 [s[2] for s in stack if s[0] not in INLINE],
                                 [s[1] for s in stack if s[1]],
                                 next((s[2] for s in reversed(stack) if s[1]), None)))
            parts, linked = [], 0

    def text(raw: str):
        nonlocal linked
        if raw and not silent:
            if "&" in raw:
                raw = unescape(raw)
            parts.append(raw)
            if links:
                linked += len(raw.strip())

    def pop():
        nonlocal silent, links
        name, _, _, speaks = stack.pop()
        silent -= not speaks
        links -= name == "a"

    n = len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        if m["cdata"] is not None:
            text(m["cdata"])
            continue
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name = name.lower()
        if not (m["end"] or m["end2"]):
            continue  # cut off inside a tag
        if m["close"] or m["close2"]:
            if name not in INLINE and name not in VOID:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    while len(stack) > k:
                        pop()
                    break
                if name in INLINE and stack[k][0] not in INLINE:
                    break  # inline end tags do not close blocks
            if name not in INLINE:
                tag = next((s[0] for s in reversed(stack) if s[0] not in INLINE), "")
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = close.start() if close else n
            continue
        if name == "hr":
            flush()
        if name in VOID:
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if name not in INLINE:
            flush()
            if name == "body":
                while any(s[0] == "head" for s in stack):
                    pop()
            ends, stops = _ENDS.get(name, ({"p"}, {"td", "th", "li", "div", "section", "article"}))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in stops:
                    break
            tag = name
        if attrs.rstrip().endswith("/") and name not in INLINE and name in NO_TEXT:
            continue
        serial += 1
        inside = next((s[1] for s in reversed(stack) if s[1]), 0) > 0
        speaks = name not in NO_TEXT
        stack.append((name, _evidence(name, attrs, inside) if name not in INLINE or attrs else 0,
                      serial, speaks))
        silent += not speaks
        links += name == "a"
    flush()
    return out


def own_cost(b: Block) -> float:
    """What a block says for itself, by length, links, sentences and tag.  Positive: evidence for content,
    negative: for boilerplate."""
    n = len(b.text)
    shape = min(n / 80, 3.0) - 4.0 * b.linked
    shape += 0.8 if _SENTENCE.search(b.text) else -0.6
    if b.tag == "p":
        shape += 0.8
    elif b.tag in HEADINGS:
        shape += 0.6
    elif b.tag in ("li", "td", "th", "dt", "dd"):
        shape -= 0.4
    return shape - (0.2 if b.tag == "p" else 0.8)


def containers(evidence: list[int]) -> float:
    """-1 to 1 (-2 if one is hidden): the innermost container, and each outer one a quarter as much
    as the one within."""
    total, weight = 0.0, 1.0
    for e in reversed(evidence):
        total += weight * e
        weight /= 4
    return max(min([-1, *evidence]), min(1.0, total))


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness: neighbours in page order, and next blocks of one container."""
    out = []
    last_in: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            a = found[i - 1].path
            common = 0
            for x, y in zip(a, b.path):
                if x != y:
                    break
                common += 1
            apart = len(a) + len(b.path) - 2 * common
            out.append((i - 1, i, 1.2 / (1 + apart)))
        if len(b.path) > 1:
            parent = b.path[-2]
            j = last_in.get(parent)
            if j is not None:
                out.append((j, i, 0.6))
            last_in[parent] = i
    return out


def graph(found: list[Block]) -> tuple[list[float], list[tuple[int, int, float]]]:
    """Terminal capacities and edges.  The nodes are the blocks, then the containers that names or tags speak
    for or against.  A container is tied to its blocks by DOM proximity, up to :data:`CONTAINER`, and its own
    evidence is firm: it is never cut off for its blocks, but each block may leave it."""
    cost, links = [own_cost(b) for b in found], edges(found)
    node: dict[int, int] = {}
    for i, b in enumerate(found):
        if b.container is not None:
            value = containers(b.evidence)
            j = node.setdefault(b.container, len(found) + len(node))
            if j == len(cost):
                cost.append(1.0 if value > 0 else -1.0)
            cost[j] += CONTAINER * value
            links.append((i, j, CONTAINER * abs(value)))
    return cost, links


def min_cut(cost: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source (content) side of a minimum cut."""
    n = len(cost)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in links:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    cost = list(cost)
    open_ = [sum(d.values()) for d in near]
    side: list[bool | None] = [None] * n
    queue = list(range(n))
    while queue:
        i = queue.pop()
        if side[i] is not None or abs(cost[i]) < open_[i] or (cost[i] == 0 and open_[i] == 0):
            continue
        side[i] = cost[i] > 0
        for j, w in near[i].items():
            if side[j] is None:
                cost[j] += w if side[i] else -w
                open_[j] -= w
                queue.append(j)
    rest = [i for i in range(n) if side[i] is None]
    if not rest:
        return [bool(s) for s in side]
    # augmenting paths over the open nodes, from one content node after the other; what a node with
    # capacity left reaches without meeting the sink is closed: no later path can cross it
    cap = {i: {j: w for j, w in near[i].items() if side[j] is None} for i in rest}
    closed: set[int] = set()
    for s in rest:
        while cost[s] > 1e-9 and s not in closed:
            came, todo, end = {s: s}, deque([s]), None
            while todo and end is None:
                i = todo.popleft()
                for j, w in cap[i].items():
                    if w > 1e-9 and j not in came and j not in closed:
                        came[j] = i
                        todo.append(j)
                        if cost[j] < -1e-9:
                            end = j
                            break
            if end is None:
                closed.update(came)
                break
            path, j = [], end
            while j != s:
                path.append((came[j], j))
                j = came[j]
            flow = min(cost[s], -cost[end], *(cap[i][j] for i, j in path))
            cost[s] -= flow
            cost[end] += flow
            for i, j in path:
                cap[i][j] -= flow
                cap[j][i] += flow
    return [bool(x) if x is not None else i in closed for i, x in enumerate(side)]


def main_text(html: str) -> str:
    found = blocks(html)
    if not found:
        return ""
    content = min_cut(*graph(found))  # the blocks come first
    return " ".join(b.text for b, keep in zip(found, content) if keep)


def extract(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html",
            url_col: str = "url") -> DataFrame:
    """One row per row: id, url, text, n_chars."""
    from pyspark.sql import functions as F

    def work(texts: list[str]) -> dict:
        made = [main_text(t) for t in texts]
        return {"text": pa.array(made, pa.string()),
                "n_chars": pa.array([len(t) for t in made], pa.int64())}

    return per_text(pages, work, "text string, n_chars long", id_col=id_col, text_col=html_col,
                    out_id=id_col, extra=[F.col(url_col).alias("url")])
