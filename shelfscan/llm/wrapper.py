"""Main text of web pages by wrapper induction.

A page is read into the tree of its blocks; inline markup and formulas belong to the text
around them, and siblings that repeat one after the other with the same labels throughout
are one repeated node. Trees of pages of a host are aligned by simple tree matching:
the largest order-keeping match of children, added up over levels. The aligned
tree is the host's wrapper. Every text slot in it is either constant, the same on
all the pages that have it, or varying. A constant slot is template where at least
``LEAST_PAGES`` different pages, and more than half of the host's different pages,
have it, on a host where something varies; all else is content. Pages are different
if the texts that may be content are, so copies count once: each task reads its pages,
one of each host's equal ones is kept, and every slot counts the pages that have it.
Copies that differ in a byline or a counter only are not told from a template by counting:
where template slots hold more than half of a marked article, or nine tenths of a page
without one, the page keeps them.

A section's fixed title is no template: a constant heading stays if what follows it under
the same parent, up to a heading of its rank, has content. Within a marked article constant text between
varying slots stays too, unless it is mostly links.

What pages say of themselves goes first: menus, forms, notices, adverts, comments
and the like, by element, role, class or id, are never content, and where a page
marks its article, content is only sought there. A class or id counts as a whole: each
of its words must name what is no content, or be neutral. What goes by its class or id,
or as a form, stays if it is or holds an article or main element not inside another
article, or most of the page's text outside links (comments may be longer than what
they are about). A header outside an article goes, unless it holds an h1 and no list or
menu and lies deeper than the body: then the wrapper judges it. On pages that mark no
article, blocks that are mostly links are menus, unless they follow running text under
the same parent, below the body, in a slot that most of the host's pages don't have: then
they are references (on hosts with fewer than ``LEAST_PAGES`` pages, position alone tells).

Wrappers are built from all pages: equal ones are dropped by host and number of the page,
which also spreads a host with a third of all pages over the tasks; each task merges its
pages of a host, handing on what it has whenever it holds ``MOST_SLOTS`` slots, then
parts of a host are merged in two steps. A wrapper's size follows the shapes of a host's
pages, not their number. Wrappers are joined by host; Spark sends them to all executors
where their measured size allows, and sorts both sides where it doesn't.

Defined results: a null or empty page has an empty text; an empty table gives an empty
result. Pages without a url, or with one without a host, form one group. Rows with the
same id, or equal in all columns, are pages of their own. Columns of the input stay,
whatever their names and types, but for ``html`` and one named as the result. Blocks
nested ``DEEPEST`` levels or more stand beside one another at that level, with the marks
of those they were in; their text is read in page order. Long pages are read whole; equal
blocks at both ends of two lists of blocks, and blocks with no like on the other side, are
aligned without a table, the rest with one of at most ``CELLS`` cells at once. Every two blocks
of a label weigh what their trees match, however many there are: a block is matched with
``FEW`` others one by one, with more of them all at once, to the same sizes. Long lists and
short ones are paired alike.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfscan.llm.tables import written

#: Different pages on which a slot must be the same to be template.
LEAST_PAGES = 3

#: Levels of blocks; deeper ones stand at the last.
DEEPEST = 200

#: Slots that a task holds before it hands on its wrappers.
MOST_SLOTS = 200_000

#: Cells of a table of matches held at once, and different blocks of a label that are matched one by one.
CELLS, FEW = 1 << 22, 32

#: Pairs of blocks whose match is remembered.
PAIRS = 1 << 18

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACES = re.compile(r"\s+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br img input meta link embed source track param math mi mn mo ms mtext "
    "mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd mstyle mspace mpadded "
    "mphantom menclose semantics".split()
)
#: Elements whose content is not markup, or says in another notation what stands beside it.
_RAW = frozenset("script style textarea title noframes iframe noembed xmp annotation annotation-xml".split())
#: Elements that are no content, within a line of text.
_WITHIN_LINES = frozenset("svg object canvas audio video map button select template noscript".split())
#: Elements that are never part of an article's text.
_OUT = frozenset(
    "head script style noscript template textarea title iframe object svg canvas audio video map nav footer aside "
    "form button select option menu dialog noframes noembed".split()
)
_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status "
    "tablist".split()
)
#: Words of a class or id that mark what is not the article.
_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu menubar sidebar sidenav topbar breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr "
    "notice notices notification popup modal overlay newsletter subscribe subscription signup login search share "
    "sharing social related recommended comment comments commentlist disqus respond reply replies pagination pager "
    "paging widget widgets toolbar skip hidden disclaimer".split()
)
#: Words that say nothing beside them.
_NEUTRAL_WORDS = frozenset(
    "site main page primary secondary top bottom left right global list item items box block area section container "
    "wrapper wrap inner bar links buttons form header text message inline post posts entry article author reader readers "
    "user users visitor visitors blog story".split()
)
#: Those that may outweigh the article.
_REPLY_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
_MAIN_ROLES = frozenset(["main", "article"])
#: What a header with a page's headline has not.
_MENUS = frozenset(["nav", "ul", "ol", "menu", "form"])
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
#: Elements of lists and tables: their blocks belong to what the list or table stands in.
_LISTS = frozenset("ul ol dl li dt dd table thead tbody tfoot tr td th".split())
#: What the start of an element closes.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
    "tfoot": {"tbody", "tr", "td", "th"},
}
#: Elements that such closing does not reach over.
_SCOPE = frozenset("ul ol dl table article section div main body html blockquote".split())


class Node:
    """A block: its label, its own text, its blocks in order, and marks."""

    __slots__ = ("children", "inside", "label", "main", "named", "out", "replies", "run", "tag", "text")

    def __init__(self, tag: str, label: str, out: bool = False, main: bool = False):
        self.tag, self.label, self.out, self.main = tag, label, out, main
        self.named = self.replies = False  # out by name or as a form only; as replies
        self.inside = False  # below an article or main
        self.run: Run | None = None  # the text that goes on after it
        self.children: list[Node] = []  # blocks and, in order between them, runs of text
        self.text: str | None = None


class Run(Node):
    """Text directly in a block, up to the next block."""

    __slots__ = ("linked", "pieces")

    def __init__(self) -> None:
        super().__init__("", "#text")
        self.pieces: list[str] = []
        self.linked = 0

    def words(self) -> str:
        """Its text, with white space as one space."""
        if self.text is None:
            self.text = _tidy("".join(self.pieces))
        return self.text


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def _out_words(names: str) -> set[str]:
    """The words that mark no content, of the classes and ids made of such and neutral ones only."""
    out: set[str] = set()
    for name in names.split():
        words = set(re.split(r"[^a-z0-9]+", name)) - {""}
        words = {w for w in words if not w.isdigit()}
        if not words.isdisjoint(_OUT_WORDS) and words <= _OUT_WORDS | _NEUTRAL_WORDS:
            out |= words & _OUT_WORDS
    return out


def _block(tag: str, source: str) -> Node:
    if not source.strip():
        node = Node(tag, tag, tag in _OUT, tag in ("article", "main"))
        node.named = tag == "form"
        return node
    found = _attributes(source)
    names = f"{found.get('class', '')} {found.get('id', '')}".lower()
    words = set(re.split(r"[^a-z]+", names)) - {""}
    role = found.get("role", "").lower()
    main = tag in ("article", "main") or role in _MAIN_ROLES or found.get("itemprop", "").lower() == "articlebody"
    marks = _out_words(names) if tag not in ("html", "body") else set()
    out = (
        (tag in _OUT and tag != "form")
        or role in _OUT_ROLES
        or "hidden" in found
        or found.get("aria-hidden", "").lower() == "true"
        or "display:none" in found.get("style", "").replace(" ", "").lower()
    )
    label = ".".join([tag, *sorted(words)])
    node = Node(tag, label, out or bool(marks) or tag == "form", main and not out)
    node.named = node.out and not out
    node.replies = bool(marks) and marks <= _REPLY_WORDS
    return node


def _put(stack: list[Node], part: Node) -> None:
    """Adds a block or run to the innermost open block, or beside it where that is too deep for more levels."""
    top = stack[-1]
    if len(stack) <= DEEPEST:
        top.children.append(part)
        return
    beside = stack[DEEPEST - 1].children
    if isinstance(part, Run):
        if beside[-1] is not top:  # goes on after a block of its own
            stack[-1] = again = Node(top.tag, top.label, top.out, top.main)
            again.named, again.replies, again.inside, again.run = top.named, top.replies, top.inside, top.run
            beside.append(again)
        stack[-1].children.append(part)
        return
    if top.out:
        part.named = top.named and (part.named or not part.out)
        part.out, part.replies = True, top.replies or part.replies
    part.main |= top.main
    beside.append(part)


def _close(stack: list[Node], opened: Counter, depth: int) -> None:
    for node in stack[depth:]:
        opened[node.tag] -= 1
        opened["#line"] -= node.tag in _WITHIN_LINES
    del stack[depth:]


def _close_for(tag: str, stack: list[Node], opened: Counter) -> None:
    """Closes the blocks that the start of another ends: paragraphs, and items of the same list or table."""
    closes = {"p"} | _CLOSES.get(tag, set())
    depth = len(stack)
    while depth > 1 and any(opened[c] > 0 for c in closes):
        depth -= 1
        name = stack[depth].tag
        if name in closes:
            _close(stack, opened, depth)
        elif name in _SCOPE or name in ("li", "td", "th", "dd"):
            break


def parse(source: str) -> Node:
    """The block tree of a page."""
    root = Node("#root", "#root")
    stack, opened, links, run, at = [root], Counter(), 0, None, 0
    named, headers = False, []
    while at <= len(source):
        token = _TOKEN.search(source, at)
        piece = source[at : token.start() if token else len(source)]
        if piece:
            if run is None:
                run = Run()
                _put(stack, run)
            known = entities.unescape(piece) if "&" in piece else piece
            run.pieces.append(known)
            run.linked += len(known) if links else 0
        if token is None:
            break
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        closing = bool(token[1])
        if tag in _RAW and not closing:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
            at = end.end() if end else len(source)
            run = None if tag == "xmp" else run
            continue
        if tag == "a":
            links = 0 if closing else 1
        if tag in _INLINE:
            if tag in ("br", "img") and run is not None:
                run.pieces.append(" ")
            continue
        before, run = run, None
        if closing:
            if opened[tag] > 0:
                depth = next(d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag)
                run = stack[depth].run
                _close(stack, opened, depth)
                links = 0
            elif tag in _WITHIN_LINES:
                run = before
            continue
        if tag not in _WITHIN_LINES and not opened["#line"]:
            _close_for(tag, stack, opened)
        node = _block(tag, token[3])
        parent = stack[-1]
        node.inside = parent.inside or parent.main
        if tag == "header" and not node.inside:
            if not node.out and parent.tag not in ("#root", "html", "body"):
                headers.append(node)
            node.out = True
        _put(stack, node)
        if tag not in _VOID and not (token[3] or "").endswith("/"):
            stack.append(node)
            opened[tag] += 1
            opened["#line"] += tag in _WITHIN_LINES
            links = 0
            node.run = before if tag in _WITHIN_LINES else None
        elif tag in _WITHIN_LINES:
            run = before
        named |= node.named
    for header in headers:
        header.out = not _has(header, {"h1"}) or _has(header, _MENUS)
    if named:
        _keep_content(root)
    return root


def _has(node: Node, tags: set | frozenset) -> bool:
    return any(c.tag in tags or _has(c, tags) for c in node.children)


def _keep_content(root: Node) -> None:
    """Takes back the marks by name of blocks that hold an article or most of the page's unlinked text."""
    sizes: dict[int, int] = {}

    def measure(node: Node) -> int:
        size = 0
        for child in node.children:
            if isinstance(child, Run):
                size += max(len(child.words()) - child.linked, 0)
            elif not child.out or child.named:
                size += measure(child)
        sizes[id(node)] = size
        return size

    total = measure(root)

    def holds(node: Node, inside: bool) -> bool:
        """Whether the block is or holds a marked article or main, articles within articles left aside."""
        article = node.main and node.tag == "article"
        found = node.main and not (inside and article)
        for child in node.children:
            if not isinstance(child, Run) and (not child.out or child.named):
                found |= holds(child, inside or article)
        if node.named and (found or (not node.replies and 2 * sizes[id(node)] > total)):
            node.out = node.named = False
        return found

    holds(root, False)


def _tidy(text: str) -> str:
    return _SPACES.sub(" ", text).strip()


class Tree:
    """A block to align: ``shape`` is the same for blocks with the same labels throughout."""

    __slots__ = ("children", "label", "shape", "size")

    def __init__(self, label: str, children: list):
        self.label, self.children = label, children
        self.shape = hash((label, *[c.shape for c in children]))
        self.size = 1 + sum(c.size for c in children)


class Part(Tree):
    """A block of a page with the runs that stand in it."""

    __slots__ = ("runs",)

    def __init__(self, label: str, children: list, runs: list[Run]):
        super().__init__(label, children)
        self.runs = runs


class Slot(Tree):
    """A block of a wrapper: the pages that have it, and its text as a checksum, None where it varies."""

    __slots__ = ("pages", "text")

    def __init__(self, label: str, children: list, pages: int, text: int | None):
        super().__init__(label, children)
        self.pages, self.text = pages, text

    def listed(self) -> list:
        return [self.label, [c.listed() for c in self.children], self.pages, self.text]

    @classmethod
    def of(cls, listed: list) -> Slot:
        label, children, pages, text = listed
        return cls(label, [cls.of(c) for c in children], pages, text)


def _fold(node: Node) -> Part:
    """What may be content below a block, alike neighbours as one.

    Parts that pages mark as no content are left out: they need no wrapper.
    """
    folded: list[Part] = []
    for child in node.children:
        if isinstance(child, Run):
            if not child.words():
                continue
            part = Part("#text", [], [child])
        elif child.out:
            continue
        else:
            part = _fold(child)
            if not part.children:
                continue
        if folded and part.label != "#text" and folded[-1].shape == part.shape:
            _join(folded[-1], part)
        else:
            folded.append(part)
    return Part(node.label, folded, [])


def _join(a: Part, b: Part) -> None:
    """Puts the runs of a block beside those of another of the same shape."""
    a.runs.extend(b.runs)
    for x, y in zip(a.children, b.children, strict=True):
        _join(x, y)


def _match(a: Tree, b: Tree, same: dict) -> int:
    """Size of the largest order-keeping match of two trees with the same root label."""
    if a.shape == b.shape:
        return a.size
    key = (a.shape, b.shape)
    if key not in same:
        start, left, right, end = _trimmed(a.children, b.children)
        inner = int(_rows(left, right, same)[-1]) if left and right else 0
        if len(same) >= PAIRS:
            same.clear()
        same[key] = 1 + sum(c.size for c in a.children[:start]) + inner + sum(c.size for c in end)
    return same[key]


def _trimmed(left: list, right: list) -> tuple[int, list, list, list]:
    """How many equal blocks two lists begin with, what is left of both, and the equal blocks they end with."""
    least = min(len(left), len(right))
    start = next((i for i in range(least) if left[i].shape != right[i].shape), least)
    least -= start
    end = next((i for i in range(least) if left[-1 - i].shape != right[-1 - i].shape), least)
    return start, left[start : len(left) - end], right[start : len(right) - end], left[len(left) - end :]


class Crowd:
    """Different blocks of one label, to match a block with all of them at once.

    Their lists of blocks stand one after the other in one row of a table. Each begins with a
    cell that holds more than any match before it can add up to, so that none goes on past it.
    ``known`` is shared with the crowds below, and must not outlive them.
    """

    __slots__ = ("begins", "below", "kinds", "known", "size")

    def __init__(self, blocks: list, known: dict):
        different: dict[str, dict] = {}
        for child in (c for block in blocks for c in block.children):
            different.setdefault(child.label, {}).setdefault(child.shape, child)
        self.known, self.size, self.below = known, len(blocks), {}
        number, first = {}, 1  # 0: where a list begins
        for label, kinds in different.items():
            number.update(zip(((label, shape) for shape in kinds), range(first, first + len(kinds)), strict=True))
            self.below[label] = first, first + len(kinds), list(kinds.values())
            first += len(kinds)
        lists = ([0, *[number[c.label, c.shape] for c in block.children]] for block in blocks)
        self.kinds = np.fromiter(chain.from_iterable(lists), np.int32)
        self.begins = np.flatnonzero(self.kinds == 0)

    def sizes(self, x: Tree) -> np.ndarray:
        """Size of the largest order-keeping match of ``x``, of the same label, with each."""
        row = self.known.get((id(self), x.shape))
        if row is None:
            row = self._sizes(x)
            if len(row) + self.known.get("cells", 0) > CELLS:
                self.known.clear()
            self.known["cells"] = self.known.get("cells", 0) + len(row)
            self.known[id(self), x.shape] = row
        return row

    def _sizes(self, x: Tree) -> np.ndarray:
        number = np.int32 if self.size * x.size < 1 << 31 else np.int64
        walls = np.arange(self.size, dtype=number) * number(x.size)
        row = np.repeat(walls, np.diff(self.begins, append=len(self.kinds)))
        weights = np.zeros(max((end for _, end, _ in self.below.values()), default=1), number)
        for child in x.children:
            if child.label not in self.below:
                continue
            first, end, kinds = self.below[child.label]
            if isinstance(kinds, list):
                kinds = Crowd(kinds, self.known)
                self.below[child.label] = first, end, kinds
            weights[first:end] = kinds.sizes(child)
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weights[self.kinds[1:]]))
            weights[first:end] = 0
        return (1 + row[np.append(self.begins[1:], len(row)) - 1] - walls).astype(np.int32)


def _weights(left: list, right: list, same: dict):
    """A function from a block of ``left`` to its matches with those of ``right``."""
    kinds = {y.shape: y for y in right}
    place = {shape: i for i, shape in enumerate(kinds)}
    of = np.array([place[y.shape] for y in right])
    by_label: dict[str, list] = {}
    for i, y in enumerate(kinds.values()):
        by_label.setdefault(y.label, []).append((i, y))
    crowds: dict[str, tuple[np.ndarray, Crowd]] = {}
    known: dict[int, np.ndarray] = {}
    in_crowds: dict = {}

    def weights(x: Tree) -> np.ndarray:
        row = known.get(x.shape)
        if row is None:
            row = np.zeros(len(kinds), dtype=np.int32)
            alike = by_label.get(x.label, ())
            if len(alike) <= FEW:
                for i, y in alike:
                    row[i] = _match(x, y, same)
            else:
                if x.label not in crowds:
                    crowds[x.label] = np.array([i for i, _ in alike]), Crowd([y for _, y in alike], in_crowds)
                at, crowd = crowds[x.label]
                row[at] = crowd.sizes(x)
            if len(known) * len(kinds) > CELLS:
                known.clear()
            known[x.shape] = row
        return row[of]

    return weights


def _below(row: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The row of a table of matches below another."""
    return np.concatenate((row[:1], np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weight))))


def _rows(left: list, right: list, same: dict) -> np.ndarray:
    """The last row of the table of matches of the beginnings of two lists."""
    weights = _weights(left, right, same)
    row = np.zeros(len(right) + 1, dtype=np.int32)
    for x in left:
        row = _below(row, weights(x))
    return row


def _pairs(left: list, right: list, same: dict) -> list[tuple]:
    """The pairs of the largest match of two lists; of several, the one that a walk back through the whole table finds.

    Of a table too large to hold some rows are kept, and those between two of them made again.
    """
    if not left or not right:
        return []
    weights, out = _weights(left, right, same), []

    def back(row: np.ndarray, start: int, end: int, j: int) -> int:
        """Walks from a place in the table's row ``end`` to row ``start``, which is given: the place it comes to."""
        step = -(-(end - start) // max(CELLS // (j + 1), 2))
        table = [row[: j + 1]]
        for i in range(start, end):
            row = _below(row[: j + 1], weights(left[i])[:j])
            if (i + 1 - start) % step == 0 and i + 1 < end or step == 1:
                table.append(row)
        if step > 1:
            for n in range(len(table) - 1, -1, -1):
                j = back(table.pop(), start + n * step, min(start + (n + 1) * step, end), j)
            return j
        i = end - start
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((left[start + i], right[j]))
        return j

    back(np.zeros(len(right) + 1, dtype=np.int32), 0, len(left), len(right))
    return out[::-1]


def _aligned(left: list, right: list) -> list[tuple]:
    """Children side by side, None where one side has no partner."""
    if [x.label for x in left] == [y.label for y in right]:
        return list(zip(left, right, strict=True))
    start, a, b, _ = _trimmed(left, right)
    labels = {x.label for x in a} & {y.label for y in b}
    paired = _pairs([x for x in a if x.label in labels], [y for y in b if y.label in labels], {})
    out = list(zip(left[:start], right[:start], strict=True))
    i = j = 0
    for x, y in [*paired, (None, None)]:
        while i < len(a) and a[i] is not x:
            out.append((a[i], None))
            i += 1
        while j < len(b) and b[j] is not y:
            out.append((None, b[j]))
            j += 1
        if x is not None:
            out.append((x, y))
            i, j = i + 1, j + 1
    return out + list(zip(left[start + len(a) :], right[start + len(b) :], strict=True))


def _texts(tree: Part) -> Iterator[str]:
    for run in tree.runs:
        yield run.words()
    for child in tree.children:
        yield from _texts(child)


def _page(tree: Part) -> int:
    """A number for what a page says."""
    joined = "\n".join(_texts(tree)).encode("utf-8", "replace")
    return int.from_bytes(hashlib.blake2b(joined, digest_size=8).digest(), signed=True)


def _sum(run: Run) -> int:
    return zlib.crc32(run.words().encode("utf-8", "replace"))


def _slots(tree: Part) -> Slot:
    """The wrapper of one page."""
    text = 0 if tree.label != "#text" else _sum(tree.runs[0]) if len(tree.runs) == 1 else None
    return Slot(tree.label, [_slots(c) for c in tree.children], 1, text)


def _merged(a: Slot, b: Slot) -> Slot:
    """The wrapper of two, of different pages."""
    children = [x or y if x is None or y is None else _merged(x, y) for x, y in _aligned(a.children, b.children)]
    return Slot(a.label, children, a.pages + b.pages, a.text if a.text == b.text else None)


def _varies(wrapper: Slot) -> bool:
    return wrapper.text is None or any(map(_varies, wrapper.children))


def _judged(tree: Part, slot: Slot, pages: int, template: set[int], common: set[int]) -> None:
    """Puts the runs of a page that stand in template slots into one set, those in slots of most pages into another."""
    if tree.label == "#text":
        if slot.pages >= LEAST_PAGES and 2 * slot.pages > pages:
            common.update(map(id, tree.runs))
            if slot.text is not None:
                template.update(id(run) for run in tree.runs if _sum(run) == slot.text)
        return
    for x, y in _aligned(tree.children, slot.children):
        if x is not None and y is not None:
            _judged(x, y, pages, template, common)


def _marked(node: Node) -> bool:
    return any((c.main and not c.out) or (not c.out and _marked(c)) for c in node.children if not isinstance(c, Run))


class Section:
    """What lists stand in, and whether running text came before them."""

    __slots__ = ("node", "text")

    def __init__(self, node: Node):
        self.node, self.text = node, False


class Line:
    """A run where content is sought, and what speaks for keeping it."""

    __slots__ = ("after", "article", "id", "keep", "linked", "menu", "text")

    def __init__(self, run: Run, article: Node | None, linked: bool, menu: bool, after: bool):
        self.id, self.text, self.article = id(run), run.words(), article
        self.linked, self.menu = linked, menu  # its block is mostly links; and one that menus are made of
        self.after = after  # it follows running text below the body
        self.keep = True


def _lines(root: Node, marked: bool) -> tuple[list[Line], list[tuple[int, int, int]]]:
    """All runs where content is sought, and of each heading where its lines begin and end, and its section."""
    lines: list[Line] = []
    headings: list[tuple[int, int, int]] = []

    def walk(node: Node, article: Node | None, section: Section, outer: Section) -> None:
        linked = _linked(node)
        over: list[tuple[str, int, int]] = []  # the headings whose sections are open
        for child in node.children:
            begin = len(lines)
            if isinstance(child, Run):
                if (article or not marked) and child.words():
                    after = section.text and section.node.tag not in ("#root", "html", "body")
                    lines.append(Line(child, article, linked, linked and node.tag in ("li", "td", "div", "ul"), after))
                    if not linked and child.words().count(" ") >= 4:
                        section.text = outer.text = True
            elif not child.out:
                inner = section if child.tag in _LISTS or (child.tag == "div" and _linked(child)) else Section(child)
                walk(child, article or (child if child.main else None), inner, section)
            if len(lines) > begin and child.tag in _HEADINGS:
                while over and over[-1][0] >= child.tag:
                    headings.append((*over.pop()[1:], begin))
                over.append((child.tag, begin, len(lines)))
        headings.extend((begin, end, len(lines)) for _, begin, end in over)

    top = Section(root)
    walk(root, None, top, top)
    return lines, headings


def _linked(node: Node) -> bool:
    texts = [c for c in node.children if isinstance(c, Run)]
    return sum(c.linked for c in texts) > 0.6 * sum(len(c.words()) for c in texts)


def main_text(source: str | None, wrapper: Slot | None = None) -> str:
    """The blocks of a page's content, one to a line."""
    if not source:
        return ""
    root = parse(source)
    template: set[int] = set()
    common: set[int] = set()
    if wrapper is not None and _varies(wrapper):
        _judged(_fold(root), wrapper, wrapper.pages, template, common)
    marked = _marked(root)
    lines, headings = _lines(root, marked)
    if template:
        held = sum(len(line.text) for line in lines if line.id in template)
        if held > (0.5 if marked else 0.9) * sum(len(line.text) for line in lines):
            template = set()
    last: dict[int, int] = {}  # of an article, the last line that is no template
    for i, line in enumerate(lines):
        line.keep = line.id not in template
        if marked and line.keep:
            last[id(line.article)] = i
    seen: set[int] = set()
    for i, line in enumerate(lines):
        if marked:
            if line.keep:
                seen.add(id(line.article))
            elif id(line.article) in seen and i < last[id(line.article)]:
                line.keep = not line.linked
        elif line.menu:
            line.keep &= line.after and line.id not in common
    content = list(accumulate((line.keep for line in lines), initial=0))
    for begin, end, after in headings:
        if content[after] > content[end]:
            for line in lines[begin:end]:
                line.keep = True
    return "\n".join(line.text for line in lines if line.keep)


def host_of(url: Column) -> Column:
    """Host of a url in lower case; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _written(wrapper: Slot) -> str:
    return json.dumps(wrapper.listed(), separators=(",", ":"))


def _read(wrapper: str) -> Slot:
    return Slot.of(json.loads(wrapper))


def induce(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """(host, wrapper): the aligned tree of all pages of each host, as JSON."""

    def of_pages(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found: dict[tuple[str, int], str] = {}
            for host, source in zip(part["host"], part["html"], strict=True):
                tree = _fold(parse(source))
                key, wrapper = (host, _page(tree)), _written(_slots(tree))
                found[key] = min(found.get(key, wrapper), wrapper)
            yield pd.DataFrame([(*key, wrapper) for key, wrapper in found.items()], columns=["host", "page", "wrapper"])

    def of_tasks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, Slot] = {}
        held = 0

        def handed_on() -> pd.DataFrame:
            return pd.DataFrame({"host": list(found), "wrapper": [_written(w) for w in found.values()]})

        for part in parts:
            for host, wrapper in zip(part["host"], part["wrapper"], strict=True):
                known, new = found.get(host), _read(wrapper)
                found[host] = _merged(known, new) if known else new
                held += found[host].size - (known.size if known else 0)
                if held > MOST_SLOTS:
                    yield handed_on()
                    found.clear()
                    held = 0
        if found:
            yield handed_on()

    def of_parts(part: pd.DataFrame) -> pd.DataFrame:
        first, *others = sorted(part["wrapper"])
        merged = _read(first)
        for wrapper in others:
            merged = _merged(merged, _read(wrapper))
        return pd.DataFrame({"host": [part["host"].iloc[0]], "wrapper": [_written(merged)]})

    schema = "host string, wrapper string"
    read = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")).filter("html <> ''")
    different = read.mapInPandas(of_pages, "host string, page long, wrapper string")
    different = different.groupBy("host", "page").agg(F.min("wrapper").alias("wrapper")).drop("page")
    parts = different.mapInPandas(of_tasks, schema).withColumn("part", F.spark_partition_id() % 64)
    parts = parts.groupBy("host", "part").applyInPandas(of_parts, schema)
    return parts.groupBy("host").applyInPandas(of_parts, schema)


def extract(pages: DataFrame, wrappers: DataFrame, html: str = "html", url: str = "url", text: str = "text") -> DataFrame:
    """``pages`` with the main text of each, by its host's wrapper. ``html`` is left out."""
    kept = [c for c in pages.columns if c not in (html, text)]
    schema = pages.select(*kept).schema.add(text, "string")
    held = pages.select(
        F.struct(*kept).alias("row"), F.col(html).alias("html"), host_of(F.col(url)).alias("host")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, Slot] = {}
        for batch in batches:
            texts = []
            for source, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                if wrapper is not None and wrapper not in read:
                    if len(read) > 256:
                        read.clear()
                    read[wrapper] = _read(wrapper)
                texts.append(main_text(source, read.get(wrapper)))
            columns = [*batch.column("row").flatten(), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, text])

    return held.join(wrappers, "host", "left").select("row", "html", "wrapper").mapInArrow(run, schema)


def op1_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    wrappers = written(induce(pages), "wrappers")
    return extract(pages, wrappers).withColumn("n_chars", F.length("text").cast("long"))
