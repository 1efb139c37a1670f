"""Main text of web pages by composite text density.

A page is read into a tree of its block elements; inline tags are transparent, links are counted. For every node of every
page the density is its characters per tag, weighed down by its share of link characters. The node whose children's
densities have the largest sum is the heart of the page, and is returned with its sum. If it is part of an ``article`` or
``main``, or if the page has only one such element with text, all of that is main text: nothing of an article is cut by
its own density. Else the smallest density on its way up to the body is the threshold, every node that reaches it adds
the best subtree below it, and an ``h1`` without links is added.

Elements that never are main text (menus, footers, scripts, forms, ...), by tag or by class, id or role, are left out
beforehand, unless they hold the page's ``article`` or ``main``, or are noise by name only and hold most of the text or
the title and most of the paragraphs.

Defined cases: a NULL or empty html, or a page without main text, gives an empty text. Unclosed and misnested tags are
closed as a browser would; a tag without end is text up to the last ``>``. Rows that repeat a ``page_id``, or have none,
are read one by one. Pages of any length are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from lettora.llm.tables import map_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
NOISE_TAGS = frozenset("nav footer aside form menu dialog search button select option label head object audio video canvas".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promo promotion cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription comment comments disqus respond replies reply sidebar "
    "rail widget widgets nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead topbar footer "
    "copyright share sharing social related recommended teaser login signup form search complementary contentinfo".split()
)
#: Behind these in a name, a word tells what else the page has: ``content-with-sidebar``, ``no-banner``.
ASIDE_WORDS = frozenset("with without has no".split())
#: Words for what is no part of the text however long it is; the others may name the text itself, or what is around it.
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr comment comments disqus "
    "respond replies reply newsletter popup modal copyright login signup".split()
)
#: In an article these may name a section (``related-work``); there they are noise only around links.
SECTION_WORDS = frozenset("related recommended search".split())
#: What an opening tag closes, and where the search for it stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}


class Node:
    """A block element. ``chars``, ``tags``, ``link_chars`` and ``link_tags`` cover its whole subtree once summed.

    ``words`` are those of its names that make it noise; empty if its tag does.
    """

    __slots__ = ("tag", "parent", "noise", "words", "chars", "tags", "link_chars", "link_tags", "density", "total", "best", "content")

    def __init__(self, tag: str, parent: Node | None, noise: bool, words: frozenset[str] = frozenset()):
        self.tag, self.parent, self.noise, self.words = tag, parent, noise, words
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.best, self.content = self, False


def _noise(tag: str, attributes: str, in_article: bool) -> tuple[bool, frozenset[str]]:
    """Whether an element is noise, and the words of its names that say so, if its tag does not."""
    if tag in ("html", "body", "main"):
        return False, frozenset()
    if tag in NOISE_TAGS or tag == "header" and not in_article:
        return True, frozenset()
    words = _noise_words(attributes, in_article)
    return bool(words), words


def _noise_words(attributes: str, in_article: bool) -> frozenset[str]:
    found = set()
    for kind, *value in _NAMES.findall(attributes):
        for name in "".join(value).lower().split():
            for word in re.split(r"[^a-z]+", name):
                if word in ASIDE_WORDS:
                    break
                if word in NOISE_WORDS and not (in_article and word == "header"):
                    # A role says what an element is, not what a section is about.
                    found |= {word, "role"} if kind.lower() == "role" else {word}
    return frozenset(found)


def parse(html: str) -> tuple[list[Node], list[tuple[Node, list[str]]]]:
    """Nodes in page order, and runs of text between block borders with the node they are in."""
    root = Node("html", None, False)
    nodes, stack, runs = [root], [root], [(root, [])]
    opened: Counter[str] = Counter()  # tags on the stack
    # The one letter that lower() makes longer would shift all places behind it.
    link_depth, low, at = 0, html.replace("\u0130", "i").lower(), 0

    def border() -> None:
        if runs[-1][1]:
            runs.append((stack[-1], []))
        else:
            runs[-1] = (stack[-1], [])

    def cut(depth: int) -> None:
        nonlocal link_depth
        opened.subtract(node.tag for node in stack[depth:])
        del stack[depth:]
        link_depth = 0 if link_depth > depth else link_depth
        border()

    def last_open(tags: set[str], stops: frozenset[str] | set[str] = frozenset()) -> int:
        """Depth of the innermost of ``tags``, or 0 if there is none above an element of ``stops``."""
        depth = len(stack) - 1
        while depth > 0 and stack[depth].tag not in tags:
            depth = 0 if stack[depth].tag in stops else depth - 1
        return depth

    def text(piece: str) -> None:
        if piece:
            piece = unescape(piece) if "&" in piece else piece
            runs[-1][1].append(piece)
            if size := len(piece.strip()):
                stack[-1].chars += size
                if link_depth:
                    stack[-1].link_chars += size

    end_of_tags = html.rfind(">") + 1
    while at < len(html):
        found = _TOKEN.search(html, at, end_of_tags)
        if not found:
            text(html[at:])
            break
        text(html[at : found.start()])
        at = found.end()
        closing = found[1] or found[4]
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if closing:
            if tag == "a":
                link_depth = 0
            elif tag in BLOCKS or tag in NOISE_TAGS:
                if opened[tag]:
                    cut(last_open({tag}))
                else:
                    border()
            continue
        if tag in RAW:
            end = low.find(f"</{tag}", at)
            close = low.find(">", end) + 1 if end >= 0 else 0
            at = close or len(html)
            continue
        if tag == "a":
            link_depth = len(stack)
            stack[-1].tags += 1
            stack[-1].link_tags += 1
        elif tag == "br":
            text(" ")
        elif tag in ("hr", "body", "html"):
            border()
            stack[-1].tags += tag == "hr"
        elif tag in BLOCKS or tag in NOISE_TAGS and tag not in VOID:
            attributes = found[3] if found[2] else found[6]
            if tag in BLOCKS and opened["p"]:
                cut(last_open({"p"}))
            if tag in CLOSES:
                closed, stops = CLOSES[tag]
                while any(opened[t] for t in closed) and (depth := last_open(closed, stops)):
                    cut(depth)
            node = Node(tag, stack[-1], *_noise(tag, attributes, opened["article"] + opened["main"] > 0))
            opened[tag] += 1
            nodes.append(node)
            stack.append(node)
            border()
            if attributes.endswith("/"):
                cut(len(stack) - 1)
    return nodes, runs


def density(chars: int, tags: int, link_chars: int, link_tags: int, page_links: float) -> float:
    """Characters per tag, weighed by how few of them, and of the tags, are links. ``page_links``: that share of the page."""
    if chars <= 0:
        return 0.0
    tags, plain = max(tags, 1), max(chars - link_chars, 1)
    base = log(chars / plain * link_chars + page_links * chars + e)
    if base <= 1 + 1e-9:  # no links in the node or the page
        return chars / tags
    spread = chars / max(link_chars, 1) * tags / max(link_tags, 1)
    return chars / tags * max(log(spread), 0.0) / log(base) if spread > 1 else 0.0


def _holders(nodes: list[Node], tags: set[str]) -> set[Node]:
    """All nodes with one of the tags, and all around them."""
    holders: set[Node] = set()
    for node in nodes:
        if node.tag in tags:
            while node is not None and node not in holders:
                holders.add(node)
                node = node.parent
    return holders


def _settle_noise(nodes: list[Node]) -> None:
    """Noise covers its subtree, but for what holds the only article, and for a form around the whole page."""
    named = {"article", "main"}
    for node in _holders(nodes, named | {"h1"}):
        node.noise = node.noise and node.tag != "form"
    inside = {nodes[0]: nodes[0].noise}
    for node in nodes[1:]:
        inside[node] = node.noise or inside[node.parent]
    if all(inside[node] for node in nodes if node.tag in named):
        for node in _holders(nodes, named):
            node.noise = False
    if any(node.noise and node.words for node in nodes):
        _settle_names(nodes)
    for node in nodes[1:]:
        node.noise = node.noise or node.parent.noise


def _settle_names(nodes: list[Node]) -> None:
    """An element is no noise by its names if it holds most of the text, or the title and most of the paragraphs.

    Most of the article or main around it, that is, where the title is enough; of the page, if no such element has text.
    """
    # Below every node, without noise by tag: characters outside links, those in links, those in paragraphs, titles.
    below: dict[Node, list[int]] = {}
    around: dict[Node, Node | None] = {nodes[0]: None}
    in_paragraph: set[Node] = set()
    inside = {nodes[0]: False}
    for node in nodes:
        plain = node.chars - node.link_chars
        if node.parent is not None:
            up = node.parent
            around[node] = up if up.tag in ("article", "main") and not inside[up] else around[up]
            inside[node] = node.noise or inside[up]
            if up in in_paragraph:
                in_paragraph.add(node)
        if node.tag == "p":
            in_paragraph.add(node)
        below[node] = [plain, node.link_chars, plain * (node in in_paragraph), int(node.tag == "h1")]
    for node in reversed(nodes[1:]):
        if not node.noise or node.words:
            below[node.parent] = [a + b for a, b in zip(below[node.parent], below[node])]
    named = any(node.tag in ("article", "main") and not inside[node] and sum(below[node][:2]) for node in nodes)
    for node in nodes:
        if not node.noise or not node.words:
            continue
        plain, links, paragraphs, titles = below[node]
        whole = around[node]
        if whole is not None and node.words <= SECTION_WORDS and links < plain:
            node.noise = False
        elif whole is not None or not named:
            all_plain, _, all_paragraphs, all_titles = below[whole or nodes[0]]
            # The text of a page can be in a column that is named for comments, but hardly next to other text.
            apart = node.words & APART_WORDS
            share = 0.9 if apart else 0.5
            title_alone = whole is not None and not apart
            titled = titles and titles == all_titles and (title_alone or 2 * paragraphs >= all_paragraphs)
            node.noise = not (plain > share * all_plain or titled)


def _summed(nodes: list[Node]) -> float:
    """Sum the counts towards the root, noise apart; the share of link characters of the whole page."""
    link_chars = sum(node.link_chars for node in nodes)
    chars = sum(node.chars for node in nodes)
    _settle_noise(nodes)
    for node in reversed(nodes[1:]):
        if not node.noise:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    return link_chars / chars if chars else 0.0


@dataclass(frozen=True)
class Choice:
    """The subtree of the largest sum of densities: the tags on the way to it, and that sum."""

    path: str
    total: float


def densest(kept: list[Node], page_links: float) -> Node:
    """Set densities and their sums of all nodes; the subtree with the largest sum, the first in page order of several."""
    children: dict[Node, list[Node]] = {node: [] for node in kept}
    for node in kept:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, page_links)
        if node.parent is not None:
            children[node.parent].append(node)
    for node in reversed(kept):
        below = children[node]
        node.total = sum(child.density for child in below) if below else node.density
        node.best = max([node, *(child.best for child in below)], key=lambda n: n.total)
    return kept[0].best


def _around(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _whole_of(best: Node, kept: list[Node]) -> Node | None:
    """The ``main`` or ``article`` that the chosen subtree is part of, or else the only one with text on the page."""
    for tag in ("main", "article"):
        around = [node for node in _around(best) if node.tag == tag]
        if around:
            return around[-1]
    for tag in ("main", "article"):
        named = [node for node in kept if node.tag == tag and node.chars]
        if len(named) == 1:
            return named[0]
    return None


def mark_content(nodes: list[Node]) -> Choice:
    """Mark what is content: the subtree that density chooses, with all of the article it is part of.

    Nothing of an ``article`` or ``main`` is cut by its own density, so short sections stay. Without one around the chosen
    subtree, other subtrees join it that are as dense as the thinnest node on the way to it.
    """
    page_links = _summed(nodes)
    kept = [node for node in nodes if not node.noise]
    if not kept:
        return Choice("", 0.0)
    best = densest(kept, page_links)
    whole = _whole_of(best, kept)
    if whole is None:
        _mark_dense(kept)
    else:
        whole.content = True
    for node in kept:
        if node.parent is not None and node.parent.content:
            node.content = True
    return Choice("/".join(node.tag for node in reversed(list(_around(best)))), best.total)


def _mark_dense(kept: list[Node]) -> None:
    """Mark the subtrees as dense as the way to the chosen one, and titles beside them."""
    root = kept[0]
    children: dict[Node, list[Node]] = {node: [] for node in kept}
    for node in kept[1:]:
        children[node.parent].append(node)
    threshold, node = root.density, root.best
    while node is not root:
        threshold, node = min(threshold, node.density), node.parent
    todo = [root]
    while todo:
        node = todo.pop()
        if node.density >= threshold:
            node.best.content = True
            todo += children[node]
    if not root.best.total:
        root.content = True
    for node in kept:
        if node.tag == "h1" and not node.link_chars:
            node.content = True


def extract(html: str | None) -> tuple[str, Choice]:
    """The main text, and the subtree that density has chosen."""
    if not html:
        return "", Choice("", 0.0)
    nodes, runs = parse(html)
    choice = mark_content(nodes)
    blocks = (" ".join("".join(parts).split()) for node, parts in runs if node.content and not node.noise)
    return "\n".join(block for block in blocks if block), choice


def main_text(html: str | None) -> str:
    return extract(html)[0]


def _text_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    found = [extract(html.as_py()) for html in batch.column(2)]
    texts = [text for text, _ in found]
    yield batch.column(0), batch.column(1), texts, [len(t) for t in texts], [c.path for _, c in found], [c.total for _, c in found]


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` (its code points), and the path and density sum of the chosen subtree."""
    schema = StructType().add("page_id", LongType()).add("url", StringType())
    schema.add("text", StringType()).add("n_chars", LongType()).add("chosen", StringType()).add("density", DoubleType())
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_batches(slim, _text_rows, schema)
