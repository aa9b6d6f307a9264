"""Main text of web pages by wrapper induction.

Pages are cut into blocks, each with the path of elements it stands in, and the blocks
that may be content form a tree of the page. Pages of a host are dealt into groups of
like layout, and neighbours in a group are aligned by simple tree matching: a node that
says the same in both is constant. A constant node that counts over all different pages of
the host confirm, by standing in most of them or in nearly all that have its path, is
template; what varies is a slot. A slot holds content unless it stands in an element for
menus, notices, adverts, forms, comments and the like, or is mostly links, outside the
article, at a path that holds links. The wrapper of a host is applied to each of its pages.

Every different page is in one group and is aligned with its neighbours there, so work
grows with the pages; groups are bounded, and counts are added up before the shuffle, so
no page is left out and a host with a third of all pages is no single task. Pages of a
host that consist of common texts nearly throughout are near copies of one article, not
evidence of a template; together they count as one page.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Callable, Generator, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from math import isqrt
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slyglot.session import scratch_path

from .shared import whole_text

#: Different pages of a host that must agree before a text is template.
AGREEING = 4
#: Share of the pages with a path, and of all pages of the host, from which a text is
#: template that most pages of the host lack: a host may have several layouts.
WITH_PATH, LAYOUT = 0.8, 0.1
#: Share of the unlinked text of a page in common texts, those on a share LAYOUT of the
#: pages of its host, from which it is a near copy.
COPIED = 0.8
#: Share of the unlinked text of a page from which a name does not mark an element, and
#: share in the article from which nothing but the article is the main text.
MOST, ARTICLE = 0.5, 0.33
#: Pages of a group that are aligned, about; layouts of fewer than AGREEING pages go together.
GROUP = 16
#: Lists of children whose lengths multiply to more than this gain by outlines and in numpy, and
#: beyond the next the table of their matchings is not kept whole; the matching is the same.
PAIRS, KEPT = 1_000, 4_000_000
#: Share of linked characters from which a slot is a list of links.
LINKED = 0.8

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|["']""")
READ = {"class", "id", "role", "hidden", "aria-hidden", "style"}
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "object", "canvas", "video", "audio"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
BLOCKS = {
    "html", "body", "head", "p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "thead", "tbody",
    "tfoot", "tr", "td", "th", "caption", "section", "article", "main", "blockquote", "pre", "figure", "figcaption", "address", "details",
    "summary", "hr", "nav", "header", "footer", "aside", "form", "fieldset", "menu", "dialog", "center",
}
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
STOPS = {"ul", "ol", "dl", "table", "menu"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
OUTSIDE = {"head", "nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "label", "fieldset"}
#: Words of class, id and role that mark what is not the article.
NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion",
    "nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "skip", "masthead",
    "header", "footer", "sidebar", "aside", "complementary", "contentinfo", "widget", "related", "recommended", "recommendations", "toc",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "paywall", "disclaimer", "copyright",
    "comment", "comments", "commentlist", "reply", "replies", "respond", "disqus", "discussion", "reviews", "form", "search", "login",
    "signup", "subscribe", "subscription", "newsletter", "share", "sharing", "social", "tags", "byline", "legal", "hidden",
}
#: Words that may stand beside those in a name, as in site-header or comment-list.
NEUTRAL = {
    "site", "page", "main", "top", "bottom", "left", "right", "global", "primary", "secondary", "area", "block", "box", "wrapper", "wrap",
    "container", "section", "list", "bar", "item", "items", "links", "link", "inner", "outer", "title", "text", "content", "body", "mobile", "",
}
#: What stays beside the article when it is named after it, as in article-comments.
BESIDE = {
    "comment", "comments", "replies", "related", "recommended", "share", "sharing", "social", "tags", "footer", "nav", "navigation", "pagination",
    "sidebar", "newsletter", "ad", "ads",
}
#: Of these, what may also name the title part of an article, and names of articles.
TITLES = {"header", "masthead"}
ARTICLES = {"article", "post", "entry", "story"}


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


@dataclass
class Node:
    """A block element: its name with classes, its own text, and the blocks in it."""

    name: str
    text: str = ""
    linked: int = 0
    outside: bool = False
    inside: bool = False
    children: list[Node] = field(default_factory=list)
    block: Block | None = None


@dataclass
class Block:
    path: int
    text: str
    linked: int
    outside: bool
    inside: bool
    marks: tuple[int, ...] = ()


def _is_mark(name: str, heading: bool) -> bool:
    """Whether one class, id or role names what stands beside the article.

    All its words must do so, or be neutral: sidebar and site-header do, has-sidebar and
    legal-article do not. Headings, and parts of articles, may be called header.
    """
    words = re.split(r"[^a-z]+", name)
    if heading:
        words = [w for w in words if w not in TITLES]
    if len(words) > 1 and words[0] in ARTICLES:
        return words[-1] in BESIDE
    return any(w in NAMES for w in words) and all(w in NAMES or w in NEUTRAL for w in words)


def _marks(attributes: str, heading: bool = False) -> tuple[str, bool, bool]:
    """Class and id of a tag, whether they mark something beside the article, and whether it is hidden."""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return "", False, False
    named, marked, hidden = [], False, False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key not in READ:
            continue
        if key == "hidden" or key == "aria-hidden" and value == "true":
            hidden = True
        elif key == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
        elif value and key != "aria-hidden":
            if key != "role":
                named.append(value)
            marked |= any(_is_mark(name, heading) for name in value.split())
    return ".".join(named), marked, hidden


class _Page:
    """One pass over the tokens of a page, with a stack of open elements."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.root = Node("page")
        # tag, hash of the path, block node, outside, inside, in a link, outside even for a heading, marks
        self.stack = [("", 0, self.root, False, False, False, False, ())]
        self.pieces: list[str] = []
        self.linked = self.marked = 0

    def text(self, raw: str) -> None:
        if raw:
            self.pieces.append(raw)
            if self.stack[-1][5]:
                self.linked += len(raw)

    def flush(self) -> None:
        if self.pieces:
            text = " ".join(html.unescape("".join(self.pieces)).split())
            if text:
                _, path, node, outside, inside, *_, marks = self.stack[-1]
                linked = min(self.linked, len(text))
                self.blocks.append(Block(path, text, linked, outside, inside, marks))
                leaf = Node("#", text, linked, outside, inside, block=self.blocks[-1])
                node.children.append(leaf)
            self.pieces, self.linked = [], 0

    def close(self, depth: int) -> None:
        if any(tag in BLOCKS for tag, *_ in self.stack[depth:]):
            self.flush()
        del self.stack[depth:]

    def end(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth][0] == tag:
                self.close(depth)
                return
            if self.stack[depth][0] in ("article", "main", "body") and tag not in ("html", "body"):
                return

    def start(self, tag: str, attributes: str) -> None:
        block = tag in BLOCKS
        if block:
            self.flush()
            for depth in range(len(self.stack) - 1, 0, -1):
                open_tag = self.stack[depth][0]
                if open_tag == "p" or open_tag in CLOSED_BY.get(tag, ()):
                    self.close(depth)
                    break
                if open_tag in STOPS or open_tag in BLOCKS and open_tag not in HEADINGS and tag not in CLOSED_BY:
                    break
        named, marked, hidden = _marks(attributes, tag in HEADINGS)
        _, path, node, outside, inside, link, barred, marks = self.stack[-1]
        core = tag in ("article", "main")
        if core:
            marked = marked and bool(re.search(r"comment|repl|related|promo|\bad", named))
        # The header of an article keeps its headings only; any other header is no content.
        own_header = tag == "header" and inside and not marked
        barred = barred or hidden or tag in OUTSIDE or tag == "header" and not own_header
        out = barred if tag in HEADINGS else outside or barred or own_header
        if marked and tag not in ("html", "body"):
            self.marked += 1
            marks = (*marks, self.marked)
        if block:
            name = f"{tag}.{named}" if named else tag
            path = _hash(f"{path}>{name}")
            child = Node(name, outside=out)
            node.children.append(child)
            node = child
        if tag == "br":
            self.text(" ")
        if tag not in VOID:
            self.stack.append((tag, path, node, out, inside or core, link or tag == "a", barred, marks))

    def settle(self) -> None:
        """Let names decide, but not over most of the unlinked text of a page with no article elsewhere."""
        free = [b for b in self.blocks if not b.outside]
        if any(b.inside and not b.marks for b in free):
            for b in free:
                b.outside = bool(b.marks)
            return
        held: dict[int, int] = {}
        for b in free:
            for mark in b.marks:
                held[mark] = held.get(mark, 0) + len(b.text) - b.linked
        least = MOST * sum(len(b.text) - b.linked for b in free)
        for b in free:
            b.outside = any(held[mark] <= least for mark in b.marks)


def parse(page: str) -> _Page:
    """Blocks of a page in order, and its tree; never fails on broken markup."""
    out, at = _Page(), 0
    for token in iter(lambda: TOKEN.search(page, at), None):
        out.text(page[at:token.start()])
        at = token.end()
        slash, tag, attributes = (token.group(i) or token.group(i + 3) or "" for i in (1, 2, 3))
        tag = tag.lower()
        if not tag:
            continue
        if slash:
            out.end(tag)
        elif tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        else:
            out.start(tag, attributes)
    out.text(page[at:])
    out.flush()
    out.settle()
    return out


def align(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the size of the best matching and its pairs of nodes.

    Equal texts weigh one more, so that repeated elements align by what they say. Trees may
    be of any depth, and lists of children of any length.
    """
    if a.name != b.name:
        return 0, []
    matching = _Matching(a, b)
    pairs, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        pairs.append((x, y))
        if x.children and y.children:
            todo += matching.pairs(x.children, y.children)
    return len(pairs) + sum(x.text != "" and x.text == y.text for x, y in pairs), pairs


#: A step that asks for the result of others, and is sent it: so trees may be of any depth.
Steps = Generator[Any, Any, Any]


def _run(step: Steps) -> Any:
    steps, result = [step], None
    while steps:
        try:
            steps.append(steps[-1].send(result))
            result = None
        except StopIteration as done:
            steps.pop()
            result = done.value
    return result


def _from_top(root: Any, below: Callable[[Any], Iterable[Any]]) -> list:
    """All that is in a tree; what is below a node comes after it."""
    found, todo = [], [root]
    while todo:
        found.append(todo.pop())
        todo += below(found[-1])
    return found


class _Matching:
    """The subtrees of two trees, by number, and the sizes of the best matchings of two of them.

    A text that only one of the trees has matches nothing and does not tell subtrees apart;
    those that are alike then have one number, and each two numbers are matched once.
    """

    def __init__(self, a: Node, b: Node) -> None:
        self.numbers: dict[tuple[str, str, tuple[int, ...]], int] = {}
        self.kinds: list[tuple[str, str, tuple[int, ...]]] = []  # name, text and numbers of the children
        self.weights: list[int] = []
        self.sizes: dict[tuple[int, int], int] = {}
        self.left: dict[tuple[int, frozenset[str]], int] = {}
        self.of: dict[int, int] = {}
        trees = [_from_top(root, lambda node: node.children) for root in (a, b)]
        both = {n.text for n in trees[0]} & {n.text for n in trees[1]}
        for nodes in trees:
            for node in reversed(nodes):
                text = node.text if node.text in both else ""
                self.of[id(node)] = self.number(node.name, text, tuple(self.of[id(c)] for c in node.children))

    def number(self, name: str, text: str, children: tuple[int, ...]) -> int:
        kind = (name, text, children)
        if kind not in self.numbers:
            self.numbers[kind] = len(self.kinds)
            self.kinds.append(kind)
            self.weights.append(1 + (text != "") + sum(self.weights[c] for c in children))
        return self.numbers[kind]

    def texts(self, u: int) -> frozenset[str]:
        return frozenset(self.kinds[k][1] for k in _from_top(u, lambda k: self.kinds[k][2])) - {""}

    def only(self, u: int, texts: frozenset[str]) -> int:
        """What is left of a subtree without the other texts."""
        if (u, texts) not in self.left:
            made: dict[int, int] = {}
            for k in reversed(_from_top(u, lambda k: self.kinds[k][2])):
                name, text, children = self.kinds[k]
                made[k] = self.number(name, text if text in texts else "", tuple(made[c] for c in children))
            self.left[u, texts] = made[u]
        return self.left[u, texts]

    def known(self, u: int, v: int) -> int | None:
        """The size of the best matching of two subtrees, unless their children are still to be matched."""
        if u == v:
            return self.weights[u]
        (name, text, xs), (other, said, ys) = self.kinds[u], self.kinds[v]
        if name != other:
            return 0
        if not xs or not ys:
            return 1 + (text != "" and text == said)
        return self.sizes.get((u, v))

    def size(self, u: int, v: int) -> Steps:
        (_, text, xs), (_, said, ys) = self.kinds[u], self.kinds[v]
        first, last = _ends(xs, ys)
        found = 1 + (text != "" and text == said) + sum(self.weights[x] for x in (*xs[:first], *xs[len(xs) - last:]))
        xs, ys = xs[first:len(xs) - last], ys[first:len(ys) - last]
        if xs and ys:
            row, best = (yield self._align_lists(xs, ys)), [0] * (len(ys) + 1)
            for i in range(len(xs)):
                best = _next_row(best, row(i))
            found += int(best[-1])
        self.sizes[u, v] = found
        return found

    def pairs(self, xs: list[Node], ys: list[Node]) -> list[tuple[Node, Node]]:
        """The best matching of two lists of subtrees that keeps their order."""
        us, vs = [self.of[id(x)] for x in xs], [self.of[id(y)] for y in ys]
        first, last = _ends(us, vs)
        found = [*zip(xs[:first], ys[:first]), *zip(xs[len(xs) - last:], ys[len(ys) - last:])]
        us, vs = us[first:len(us) - last], vs[first:len(vs) - last]
        if len(us) == len(vs) == 1:
            places = [(0, 0)] if self.kinds[us[0]][0] == self.kinds[vs[0]][0] else []
        else:
            places = _places(_run(self._align_lists(us, vs)), len(us), len(vs)) if us and vs else []
        return found + [(xs[first + i], ys[first + j]) for i, j in places]

    def _align_lists(self, xs: Sequence[int], ys: Sequence[int]) -> Steps:
        """What each of `xs` gains with each of `ys`: a function from a place in `xs` to the row of it."""
        if len(xs) * len(ys) > PAIRS:
            return (yield self._align_long(xs, ys))
        rows = []
        for u in xs:
            rows.append([])
            for v in ys:
                gain = self.known(u, v)
                rows[-1].append((yield self.size(u, v)) if gain is None else gain)
        return rows.__getitem__

    def _align_long(self, xs: Sequence[int], ys: Sequence[int]) -> Steps:
        """As `_align_lists`, without matching all pairs.

        Two subtrees match as well as what is left of them without the texts that only one
        says. So most pairs match as their outlines do, which have no text and are few, and
        only those that say the same anywhere are looked at one by one.
        """
        us, vs = list(dict.fromkeys(xs)), list(dict.fromkeys(ys))
        said = {k: self.texts(k) for k in (*us, *vs)}
        outline = {k: self.only(k, frozenset()) for k in said}
        outlines = {o: i for i, o in enumerate(dict.fromkeys(outline[v] for v in vs))}
        saying: dict[str, list[int]] = {}
        for j, v in enumerate(vs):
            for text in said[v]:
                saying.setdefault(text, []).append(j)
        plain: dict[int, np.ndarray] = {}
        nearer: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for u in us:
            o = outline[u]
            if o not in plain:
                gains = []
                for other in outlines:
                    gain = self.known(o, other)
                    gains.append((yield self.size(o, other)) if gain is None else gain)
                plain[o] = np.array(gains, np.int32)
            near = sorted({j for text in said[u] for j in saying.get(text, ())})
            gains = []
            for j in near:
                same = said[u] & said[vs[j]]
                left, right = self.only(u, same), self.only(vs[j], same)
                gain = self.known(left, right)
                gains.append((yield self.size(left, right)) if gain is None else gain)
            nearer[u] = np.array(near, np.int32), np.array(gains, np.int32)
        place = {v: j for j, v in enumerate(vs)}
        at, of_kind = np.array([place[y] for y in ys]), np.array([outlines[outline[v]] for v in vs])

        def row(i: int) -> np.ndarray:
            gains = plain[outline[xs[i]]][of_kind]
            where, more = nearer[xs[i]]
            gains[where] = more
            return gains[at]

        return row


def _ends(xs: Sequence[int], ys: Sequence[int]) -> tuple[int, int]:
    """How many subtrees are alike at the begin of two lists, and how many of the others at the end.

    No matching is better than one that has these, and it finds the same texts equal.
    """
    least, first, last = min(len(xs), len(ys)), 0, 0
    while first < least and xs[first] == ys[first]:
        first += 1
    while last < least - first and xs[-1 - last] == ys[-1 - last]:
        last += 1
    return first, last


def _next_row(before: Any, gains: Any) -> Any:
    """Sizes of the best matchings with each begin of the other list, from those of one subtree less."""
    if isinstance(gains, list):
        row, size = [0], 0
        for j, gain in enumerate(gains):
            size = max(size, before[j + 1], before[j] + gain)
            row.append(size)
        return row
    row = np.array(before, np.int32)
    np.maximum(row[1:], row[:-1] + gains, out=row[1:])
    return np.maximum.accumulate(row)


def _places(row: Callable[[int], Any], m: int, n: int) -> list[tuple[int, int]]:
    """The places of the best matching, later ones first; of long lists some rows are kept and the others made again."""
    step = m if m * n <= KEPT else isqrt(m) + 1
    kept = [[0] * (n + 1)]
    best, pairs, i, j = kept[0], [], m, n
    for k in range((m - 1) // step * step):
        best = _next_row(best, row(k))
        if (k + 1) % step == 0:
            kept.append(best)
    while i and j:
        start = (i - 1) // step * step
        rows, gains = [kept[start // step]], []
        for k in range(start, i):
            gains.append(row(k))
            rows.append(_next_row(rows[-1], gains[-1]))
        while i > start and j:
            gain, size, above = gains[i - 1 - start][j - 1], rows[i - start][j], rows[i - 1 - start]
            if gain and size == above[j - 1] + gain:
                pairs.append((i - 1, j - 1))
                i, j = i - 1, j - 1
            elif size == above[j]:
                i -= 1
            else:
                j -= 1
    return pairs


def tree_of(page: _Page, kept: list[Block], deepest: int | None = 200) -> list[tuple[int, int, int]]:
    """(depth, hash of the name, key) of the nodes that hold kept blocks, in order; a leaf has a key.

    A caller may want no tree deeper than `deepest`; the operator takes all.
    """
    wanted, out = {id(b) for b in kept}, []
    todo: list[tuple[Node, int]] = [(page.root, 0)]
    reached = 0
    while todo:
        node, depth = todo.pop()
        if deepest is not None and depth > deepest:
            return []
        reached = max(reached, depth)
        if node.block is not None:
            if id(node.block) in wanted:
                out.append((depth, 0, _key(node.block)))
        else:
            out.append((depth, _hash(node.name), 0))
            todo += [(child, depth + 1) for child in reversed(node.children)]
    held, kept_nodes = reached + 2, []
    for depth, name, key in reversed(out):  # so an element comes after what is in it
        if key or held == depth + 1:
            kept_nodes.append((depth, name, key))
            held = depth
    return kept_nodes[::-1]


def _grown(nodes: list) -> Node:
    """The tree of `tree_of`'s rows; texts are keys."""
    root = Node("page")
    path = [root]
    for depth, name, key in nodes:
        node = Node("#", str(key)) if key else Node(str(name))
        del path[depth + 1:]
        path[-1].children.append(node)
        path.append(node)
    return root


def constants(trees: list[list]) -> set[int]:
    """Keys of nodes that say the same in two neighbouring trees, aligned."""
    found: set[int] = set()
    grown = [_grown(nodes) for nodes in trees]
    for a, b in zip(grown, grown[1:]):
        found |= {int(x.text) for x, y in align(a, b)[1] if x.text and x.text == y.text}
    return found


def _key(block: Block) -> int:
    return _hash(f"{block.path}|{block.text}")


def content(page: str) -> list[Block]:
    """Blocks that stand in nothing marked; only those of the article where it holds a good part of the text."""
    return _content(parse(page))


def _content(page: _Page) -> list[Block]:
    blocks = [b for b in page.blocks if not b.outside]
    size = lambda some: sum(len(b.text) - b.linked for b in some)
    article = [b for b in blocks if b.inside]
    return article if article and size(article) >= ARTICLE * size(blocks) else blocks


def _link_slot(block: Block) -> bool:
    """Whether a block at a path of links is one itself; prose there, and lists in the article, are content."""
    return not block.inside and block.linked >= LINKED * len(block.text)


def extract(page: str, template: set[int], links: set[int]) -> str:
    """The content slots of a page, one line each, under hashes of template texts and link paths."""
    blocks = content(page)
    if template:
        blocks = [b for b in blocks if _key(b) not in template]
    if links:
        blocks = [b for b in blocks if not (_link_slot(b) and b.path in links)]
    return "\n".join(b.text for b in blocks)


BLOCK = "path long, key long, size long, linked long, times long, first boolean"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, body, layout, blocks and tree of every page with blocks: its different texts at their paths."""
    node = pa.struct([("depth", pa.int32()), ("name", pa.int64()), ("key", pa.int64())])
    block = pa.struct([(n, pa.bool_() if n == "first" else pa.int64()) for n in (f.split()[0] for f in BLOCK.split(", "))])
    for batch in batches:
        rows: tuple[list, ...] = [], [], [], [], []
        for host, html_text in zip(*batch.columns):
            page = parse(html_text.as_py())
            found = _content(page)
            if not found:
                continue
            texts: dict[int, dict] = {}
            paths: set[int] = set()
            for b in found:
                key, path = _key(b), b.path
                if key in texts:
                    texts[key]["times"] += 1
                else:
                    texts[key] = {"path": path, "key": key, "size": len(b.text), "linked": b.linked, "times": 1, "first": path not in paths}
                    paths.add(path)
            layout = _hash(" ".join(map(str, sorted(paths))))
            tree = [dict(zip(("depth", "name", "key"), n)) for n in tree_of(page, found, None)]
            for column, value in zip(rows, (host.as_py(), _hash("\n".join(b.text for b in found)), layout, list(texts.values()), tree)):
                column.append(value)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(block), pa.list_(node))
        yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], ["host", "body", "layout", "blocks", "tree"])


def _aligned(batch: pd.DataFrame) -> pd.DataFrame:
    """host and the constant keys of one group of pages."""
    trees = [[(n["depth"], n["name"], n["key"]) for n in tree] for tree in batch.sort_values("body")["tree"]]
    found = sorted(constants([t for t in trees if t]))
    return pd.DataFrame({"host": pd.Series([batch["host"].iloc[0]] * len(found), dtype=object), "key": pd.Series(found, dtype="int64")})


def constant_nodes(pages: DataFrame) -> DataFrame:
    """host, key: what the alignment of neighbouring pages finds constant, over all different pages.

    A group has pages of one layout (the set of their paths), or of layouts that few pages
    have; the more pages, the more groups.
    """
    of_host = W.partitionBy("host", "kind")
    sizes = pages.groupBy("host", "layout").agg(F.count("*").alias("n"))
    kinds = sizes.withColumn("kind", F.when(F.col("n") >= AGREEING, F.col("layout")).otherwise(F.lit(0)))
    kinds = kinds.withColumn("groups", F.ceil(F.sum("n").over(of_host) / GROUP)).select("host", "layout", "kind", "groups")
    dealt = pages.select("host", "layout", "body", "tree").join(kinds, ["host", "layout"])
    group = F.pmod(F.xxhash64("body"), F.col("groups")).alias("group")
    grouped = dealt.select("host", "kind", group, "body", "tree").groupBy("host", "kind", "group")
    return grouped.applyInPandas(_aligned, "host string, key long").distinct()


def _pages(copy: Column, each: Column | None = None) -> Column:
    """Pages in a group, near copies counted as one."""
    each = F.lit(True) if each is None else each
    return F.sum((each & ~copy).cast("long")) + F.max((each & copy).cast("long"))


def induce(pages: DataFrame, constant: DataFrame) -> DataFrame:
    """host, common, template, links: hashes of texts and of link paths, from all rows of `pages`.

    Template are the `constant` nodes (host, key) that the counts confirm. Near copies, by
    the column `copy`, count as one page of their host.
    """
    copy = F.col("copy")
    flat = pages.select("host", "copy", F.inline("blocks"))
    # Few paths and one count of pages a host: only these are joined by host.
    paths = flat.groupBy("host", "path").agg(
        _pages(copy, F.col("first")).alias("having"), F.sum(F.col("size") * F.col("times")).alias("size"),
        F.sum(F.col("linked") * F.col("times")).alias("linked"), F.sum("times").alias("times"),
    ).join(pages.groupBy("host").agg(_pages(copy).alias("pages")), "host").where(F.col("having") >= LAYOUT * F.col("pages"))
    texts = flat.groupBy("host", "path", "key").agg(_pages(copy).alias("n")).where(F.col("n") >= AGREEING)
    n, pages_of = F.col("n"), F.col("pages")
    common = texts.join(paths, ["host", "path"]).where(n >= LAYOUT * pages_of)
    common = common.join(constant.withColumn("constant", F.lit(True)), ["host", "key"], "left")
    template = F.when(F.col("constant") & ((2 * n > pages_of) | (n >= WITH_PATH * F.col("having"))), F.col("key"))
    links = paths.where((F.col("times") >= AGREEING) & (F.col("linked") >= LINKED * F.col("size")))
    none = F.lit(None).cast("long")
    each = common.select("host", "key", template.alias("template"), none.alias("link")).union(links.select("host", none, none, "path"))
    return each.groupBy("host").agg(*[
        F.sort_array(F.collect_set(c)).alias(name) for c, name in (("key", "common"), ("template", "template"), ("link", "links"))
    ])


def _copies(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """`pages` with `copy` also set where nearly all text that is not linked is common in the host."""
    def size(blocks: Column) -> Column:
        prose = F.filter(blocks, lambda b: b["linked"] < LINKED * b["size"])
        return F.aggregate(prose, F.lit(0).cast("long"), lambda n, b: n + b["size"] * b["times"])

    same = F.filter("blocks", lambda b: F.array_contains(F.coalesce("common", F.array().cast("array<long>")), b["key"]))
    near = (size(F.col("blocks")) > 0) & (size(same) >= COPIED * size(F.col("blocks")))
    return pages.join(wrappers.select("host", "common"), "host", "left").select("host", "blocks", (F.col("copy") | near).alias("copy"))


def wrappers_of(pages: DataFrame) -> DataFrame:
    """The written wrappers of `pages` (host, body, layout, blocks, tree), one row for each different page.

    Where nothing but little varies there is no slot: such pages are copies, and count as
    one. Without them other copies may come to hold most pages, so this goes on until no
    page is added.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "wrapper-constants")
    constant_nodes(pages).write.parquet(path)
    constant = spark.read.parquet(path)
    pages, n = pages.select("host", "blocks", F.lit(False).alias("copy")), 0
    while True:
        path = scratch_path(spark, "wrappers")
        induce(pages, constant).write.parquet(path)
        wrappers = spark.read.parquet(path)
        path = scratch_path(spark, "wrapper-copies")
        _copies(pages, wrappers).write.parquet(path)
        pages, before = spark.read.parquet(path), n
        n = pages.where("copy").count()
        if n == before:
            return wrappers


HOST = r"^[^:/?#]*://([^/?#]*)"


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A NULL or empty page has an empty text, and very long or deep ones are read whole. Equal
    rows give equal rows, and of alignments that match as much the later pair is taken. Pages with a NULL URL, or one without a host,
    share the wrapper of the empty host. Pages of the same content count once when a wrapper
    is learned and are extracted each. Other columns are not carried; an empty table gives an empty
    result.
    """
    spark = pages.sparkSession
    host = F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit("")))
    cut = pages.select("page_id", "url", host.alias("host"), whole_text("html").alias("html"))
    path = scratch_path(spark, "wrapper-pages")
    schema = f"host string, body long, layout long, blocks array<struct<{BLOCK.replace(' ', ': ')}>>, tree array<struct<depth: int, name: long, key: long>>"
    blocks = cut.select("host", "html").mapInArrow(_counted, schema.replace(",: ", ", "))
    one = F.min(F.struct("layout", "blocks", "tree")).alias("page")
    blocks.groupBy("host", "body").agg(one).select("host", "body", "page.*").write.parquet(path)
    different = spark.read.parquet(path)
    # A written table has a size, so Spark broadcasts it only under its own limit.
    wrappers = wrappers_of(different)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                extract(page.as_py(), set(template.as_py() or ()), set(links.as_py() or ()))
                for page, template, links in zip(*(batch.column(i) for i in (2, 3, 4)))
            ]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            })

    joined = cut.join(wrappers.drop("common"), "host", "left").select(F.col("page_id").cast("long"), "url", "html", "template", "links")
    return joined.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
