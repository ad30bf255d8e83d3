"""Main-text extraction by wrappers inferred from pages of the same host.

A page is a stream of tags and texts. Runs of repeated siblings fold into
repeated groups, which gives the page's own pattern. The pattern of a host
starts as that of one page and is aligned with the next, level by level: what
both have stays, texts become slots, what only one has becomes optional, what
repeats in either repeats. The result is an expression without unions that
fits all pages of the host, with figures for every slot: how much text it
holds, how much of it in links, whether it is always the same.

Patterns are small, and aligning two of them gives a pattern again. So tasks
align the pages they read, and only patterns are shuffled: per host and part
first, then per host. From a host's pattern follows where its article stands;
each page is then cut by it.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import text_or_empty, written

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "object")
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: A tag that opens ends an open element of these names within the same parent.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS = frozenset("ul ol dl table body article main section div select".split())
ASIDE_TAGS = frozenset("head nav header footer aside form button select menu dialog fieldset".split())
ASIDE_NAMES = frozenset((
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer header login masthead menu modal nav navbar navigation newsletter notice "
    "popup promo promoted recommended related replies search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget"
).split())
#: A class of these and more ("has-sidebar") is a state of the element, not its name.
STATES = frozenset("has have is no non not show hide with without".split())
#: Ends of a class that say where the element is or what it is made of.
PLACES = frozenset(
    "area articles bar block body bottom box button buttons container content group inner item items left links list "
    "navigation outer panel post posts primary right secondary section slot stories top unit widget widgets wrap wrapper".split()
)
#: Readers' texts may outgrow the article.
READER_NAMES = frozenset("comment comments disqus replies".split())
WHOLE_TAGS = frozenset("html body main article".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
ARTICLE_NAMES = frozenset("article articlebody content entry post story".split())

#: Different pages a text must be the same on to be fixed.
FIXED_ON = 3
#: A region of several elements a page beside the one with the longest element holds this share of it at least.
BESIDE = 0.25
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text may be the same on many pages and yet belong to the article.
LABELS = HEADINGS | frozenset("dt dd th td li caption figcaption summary".split())
#: A class or id names elements of a host if this share of its pages has it.
COMMON = 0.01

_START = re.compile(r"<(?=[A-Za-z/!?])")
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_UNQUOTED = re.compile(r"""[^>"']*""")
_RAW_END = {name: re.compile(rf"</{name}\b", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_MARKS = {"class": ".", "id": "#", "role": "@", "itemprop": "!"}


class Node:
    """An element of a page or of a pattern; a text slot has the name ``#``."""

    __slots__ = ("name", "kids", "text", "links", "repeats", "optional", "pages", "chars", "link_chars", "seen", "contents", "count")

    def __init__(self, name: str):
        self.name, self.kids = name, []
        self.text, self.links = "", 0
        self.repeats = self.optional = False
        self.pages, self.chars, self.link_chars, self.seen = 1, 0, 0, None
        # Marks of the least contents of different pages that have the slot.
        self.contents: list[int] = []
        self.count = 1

    def as_list(self) -> list:
        """All nodes, parents before their children, each with its number of children."""
        return [
            [n.name, int(n.repeats), int(n.optional), n.pages, n.chars, n.link_chars, n.seen, n.contents, n.count, len(n.kids)]
            for n in in_order(self)
        ]

    @staticmethod
    def from_list(rows: list) -> Node:
        def made(row: list) -> Node:
            node = Node(row[0])
            node.repeats, node.optional = bool(row[1]), bool(row[2])
            node.pages, node.chars, node.link_chars, node.seen, node.contents, node.count = row[3:9]
            return node

        return _rebuilt(rows, made, lambda node: node.kids)


def _rebuilt(rows: list, made, kids_of):  # noqa: ANN001, ANN202
    """The tree of rows in order, each of which ends with its number of children."""
    root = made(rows[0])
    waiting = [(kids_of(root), rows[0][-1])]
    for row in rows[1:]:
        while not waiting[-1][1]:
            waiting.pop()
        kids, left = waiting[-1]
        waiting[-1] = (kids, left - 1)
        kids.append(made(row))
        waiting.append((kids_of(kids[-1]), row[-1]))
    return root


def in_order(root: Node) -> Iterator[Node]:
    """All nodes, parents before their children. Pages may be nested deeper than calls can be."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        yield node
        waiting.extend(reversed(node.kids))


@lru_cache(maxsize=1 << 14)
def tokens_of(attributes: str) -> tuple[str, ...]:
    """What attributes say of an element's purpose: classes, ids, roles, properties, numbers left out."""
    said = set()
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        for token in (a or b or c).lower().split():
            said.add(_MARKS[key.lower()] + re.sub(r"\d+", "0", re.sub(r"[.#@!/]", "_", token)))
    return tuple(sorted(said))


@lru_cache(maxsize=1 << 14)
def _purpose_tokens(token: str) -> tuple[str, ...]:
    """What is left of a token that is not common on its host: the words that decide."""
    if token[0] == "@":
        return (token,) if token[1:] in ASIDE_ROLES or token in ("@article", "@main") else ()
    words = set(re.split(r"[^a-z]+", token[1:]))
    found = {w for w in words if w in ARTICLE_NAMES}
    if token[0] in ".#":
        found |= _purposes(token[1:]) & ASIDE_NAMES
    return tuple(token[0] + w for w in found)


def _named(tag: str, attributes: str, known: frozenset | None) -> str:
    said = tokens_of(attributes)
    if known is not None and any(t not in known for t in said):
        said = sorted({u for t in said for u in ((t,) if t in known else _purpose_tokens(t))})
    return tag + "".join(said)


class _Scanner:
    """The tags of a page, one after the other, each place of it read once.

    A tag ends at the first ``>`` outside of quotes. A quote that is not closed
    is a character like others. If quotes hide all that could end a tag, they
    do not count for the rest of the page. Without any ``>`` behind it, a ``<``
    is text, or if nothing but an unfinished tag follows, that is passed over.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = {c: page.rfind(c) for c in "<>\"'"}
        self.quotes = True

    def _end(self, at: int) -> int:
        """The place of the ``>`` that ends the tag whose name ends here."""
        page, place = self.page, at
        while self.quotes:
            place = _UNQUOTED.match(page, place).end()
            if place == len(page):
                self.quotes = False
            elif page[place] == ">":
                return place
            else:
                closed = place < self.last[page[place]]
                place = page.index(page[place], place + 1) + 1 if closed else place + 1
        return page.index(">", at)

    def tags(self) -> Iterator[tuple[int, int, str, str, str]]:
        """Where each tag starts and ends, the stroke of an end tag, its name, its attributes.

        Comments and declarations have no name. ``skip`` leads past the content
        of a raw element.
        """
        page, self.at = self.page, 0
        while m := _START.search(page, self.at):
            start = m.start()
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                self.at = len(page) if end < 0 else end + 3
                yield start, self.at, "", "", ""
            elif page[start + 1] in "!?":
                end = page.find(">", start)
                self.at = len(page) if end < 0 else end + 1
                yield start, self.at, "", "", ""
            elif start > self.last[">"]:
                if start < self.last["<"]:
                    self.at = self.last["<"]
                    continue
                yield start, len(page), "", "", ""
                return
            elif tag := _TAG.match(page, start):
                end = self._end(tag.end())
                self.at = end + 1
                yield start, self.at, tag[1], tag[2].lower(), page[tag.end() : end]
            else:
                self.at = start + 1

    def skip(self, name: str) -> None:
        found = _RAW_END[name].search(self.page, self.at)
        end = self.page.find(">", found.end()) if found else -1
        self.at = len(self.page) if end < 0 else end + 1


def parse(page: str | None, known: frozenset | None = None) -> Node:
    """The elements and texts of a page; inline tags are part of the text.

    Whatever is left open ends with its parent, and end tags without a start
    are passed over. Of classes and ids that are not ``known`` only the words
    that say what an element is for are kept.
    """
    page, root = page or "", Node("")
    open_nodes: list[tuple[str, Node]] = [("", root)]
    n_open: dict[str, int] = {}
    pieces: dict[int, list[str]] = {}
    texts: list[Node] = []
    links = at = 0

    def add(piece: str) -> None:
        if piece:
            kids = open_nodes[-1][1].kids
            if not kids or kids[-1].name != "#":
                kids.append(Node("#"))
                texts.append(kids[-1])
            pieces.setdefault(id(kids[-1]), []).append(piece)
            kids[-1].links += len(piece) if links else 0

    def end(names: tuple, stops=frozenset()) -> None:
        if not any(n_open.get(n) for n in names):
            return
        for depth in range(len(open_nodes) - 1, 0, -1):
            tag = open_nodes[depth][0]
            if tag in names:
                for closed, _ in open_nodes[depth:]:
                    n_open[closed] -= 1
                del open_nodes[depth:]
                return
            if tag in stops:
                return

    scanner = _Scanner(page)
    for start, after, closing, tag, attributes in scanner.tags():
        add(html.unescape(page[at:start]))
        at = after
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
            elif tag == "br":
                add(" ")
            continue
        links = 0
        if closing:
            end((tag,))
            continue
        if tag in RAW:
            scanner.skip(tag)
            at = scanner.at
            continue
        end(("p",), STOPS)
        if tag in ENDS:
            end(ENDS[tag], STOPS - {"div", "section"})
        node = Node(_named(tag, attributes, known))
        open_nodes[-1][1].kids.append(node)
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            open_nodes.append((tag, node))
            n_open[tag] = n_open.get(tag, 0) + 1
    add(html.unescape(page[at:]))
    for node in texts:
        node.text = "".join(pieces[id(node)])
    return root


def _mark(words: str) -> int:
    return zlib.crc32(words.encode("utf-8", "surrogatepass"))


def _content(page: Node) -> int:
    """A mark of what a page says outside of asides and links: the same for copies."""
    said: list[str] = []
    waiting = [page]
    while waiting:
        node = waiting.pop()
        if node.name == "#":
            words = " ".join(node.text.split())
            if words and not _mostly_links(node, words):
                said.append(words)
        elif not is_aside(node.name):
            waiting.extend(reversed(node.kids))
    return _mark("\n".join(said))


def _mostly_links(text: Node, words: str) -> bool:
    return 2 * min(text.links, len(words)) > len(words)


def _is_blank(node: Node) -> bool:
    return node.name == "#" and node.text.isspace()


def fold(page: Node) -> Node:
    """The pattern of one page: texts become slots, repeated siblings one group."""
    content = _content(page)
    folded: dict[int, Node] = {}
    for node in reversed(list(in_order(page))):
        out = folded[id(node)] = Node(node.name)
        if node.name == "#":
            words = " ".join(node.text.split())
            out.chars, out.link_chars = len(words), min(node.links, len(words))
            out.seen, out.contents = _mark(words), [content]
            continue
        for _, ones in groups_of(node.kids):
            kid = folded[id(ones[0])]
            for other in ones[1:]:
                kid = merge(kid, folded[id(other)], same_page=True)
                kid.repeats = True
            out.kids.append(kid)
    return folded[id(page)]


def groups_of(kids: list[Node]) -> list[tuple[str, list[Node]]]:
    """Siblings without blanks, those that stand for one another in repeats put together.

    A repeat is a sequence of names of any length that follows itself; short
    ones first, and again until none is left. Equal sequences are told by the
    difference of running hashes.
    """
    groups = [(k.name, [k]) for k in kids if not _is_blank(k)]
    while True:
        folded = _squares(_squares(groups, only=1))
        if len(folded) == len(groups):
            return groups
        groups = folded


def _squares(groups: list[tuple[str, list[Node]]], only: int = 0) -> list[tuple[str, list[Node]]]:
    n = len(groups)
    if n < 2:
        return groups
    prime, base = (1 << 61) - 1, 1_000_003
    sums, powers = [0], [1]
    for name, _ in groups:
        sums.append((sums[-1] * base + zlib.crc32(name.encode("utf-8", "surrogatepass")) + 1) % prime)
        powers.append(powers[-1] * base % prime)
    following, place_of = [0] * n, {}
    for i in range(n - 1, -1, -1):
        following[i] = place_of.get(groups[i][0], n) - i
        place_of[groups[i][0]] = i

    def told(i: int, length: int) -> int:
        return (sums[i + length] - sums[i] * powers[length]) % prime

    out, i = [], 0
    while i < n:
        length = following[i]
        j = i + length
        if (only and length != only) or j + length > n or told(i, length) != told(j, length):
            out.append(groups[i])
            i += 1
            continue
        repeat = [(name, list(ones)) for name, ones in groups[i:j]]
        while j + length <= n and told(i, length) == told(j, length):
            for (_, ones), (_, more) in zip(repeat, groups[j : j + length]):
                ones.extend(more)
            j += length
        out += repeat
        i = j
    return out


def _joint(a: Node, b: Node, same_page: bool) -> Node:
    """What fits either of two nodes of one name, without their children."""
    out = Node(a.name)
    out.repeats, out.optional = a.repeats or b.repeats, a.optional or b.optional
    out.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    out.chars, out.link_chars = a.chars + b.chars, a.link_chars + b.link_chars
    # The slot's text as long as it is always the same, then 0.
    out.seen = a.seen if a.seen == b.seen else 0
    out.count = a.count + b.count
    out.contents = sorted({*a.contents, *b.contents})[:FIXED_ON]
    return out


def merge(a: Node, b: Node, same_page: bool = False) -> Node:
    """The pattern that fits whatever either fits; both have the same name."""
    whole = _joint(a, b, same_page)
    waiting = [(a.kids, b.kids, whole)]
    while waiting:
        left, right, out = waiting.pop()
        for one, other in _pairs(left, right):
            if one is None or other is None:
                kid = one or other
                kid.optional = True
            else:
                kid = _joint(one, other, same_page)
                waiting.append((one.kids, other.kids, kid))
            out.kids.append(kid)
    return whole


def _pairs(left: list[Node], right: list[Node]) -> list[tuple[Node | None, Node | None]]:
    """Siblings of both, matched in order of a longest common subsequence of names."""
    # What both begin and end with is matched as it stands.
    n, m = len(left), len(right)
    head = 0
    while head < min(n, m) and left[head].name == right[head].name:
        head += 1
    tail = 0
    while tail < min(n, m) - head and left[n - 1 - tail].name == right[m - 1 - tail].name:
        tail += 1
    out = list(zip(left[:head], right[:head]))
    ends = list(zip(left[n - tail :], right[m - tail :]))
    left, right = left[head : n - tail], right[head : m - tail]
    n, m = len(left), len(right)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if left[i].name == right[j].name else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and left[i].name == right[j].name:
            out.append((left[i], right[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append((left[i], None))
            i += 1
        else:
            out.append((None, right[j]))
            j += 1
    return out + ends


def _purposes(said: str) -> set[str]:
    """What a class or id of an element names: it as a whole, and its last part.

    Of "sidebar-left" the last part is "sidebar", as "left" only says where.
    """
    out = set()
    parts = [part for part in re.split(r"[^a-z]+", said) if part]
    if not parts or (len(parts) > 1 and parts[0] in STATES):
        return out
    out.add(parts[-1])
    while len(parts) > 1 and parts[-1] in PLACES:
        parts.pop()
        out.add(parts[-1])
    return out


def _tag_of(name: str) -> str:
    return re.split(r"[.#@!]", name, maxsplit=1)[0]


@lru_cache(maxsize=1 << 14)
def _aside_names(name: str) -> frozenset[str]:
    """The names that make an element an aside; the tag counts as one."""
    parts = re.split(r"([.#@!])", name)
    if parts[0] in WHOLE_TAGS:
        return frozenset()
    found = {parts[0]} & ASIDE_TAGS
    for mark, said in zip(parts[1::2], parts[2::2]):
        found |= _purposes(said) & ASIDE_NAMES if mark in ".#" else {said} & ASIDE_ROLES if mark == "@" else set()
    return frozenset(found)


def is_aside(name: str) -> bool:
    """Whether an element is a menu, header, footer, sidebar, notice, advert, form or comments by its name."""
    return bool(_aside_names(name))


@lru_cache(maxsize=1 << 14)
def _rank(name: str) -> int:
    """How surely an element is the article: 3 by tag, 2 main part, 1 by name, 0 not."""
    parts = re.split(r"([.#@!])", name)
    said = set(re.split(r"[^a-z]+", " ".join(parts[2::2])))
    if parts[0] == "article" or "articlebody" in said or "@article" in name:
        return 3
    if parts[0] == "main" or "@main" in name:
        return 2
    return int(bool(said & ARTICLE_NAMES))


class _Paths:
    """Numbers for paths of names from the root, so that a deep path takes one step more than its parent's."""

    def __init__(self) -> None:
        self.numbers: dict[tuple[int, str], int] = {}
        self.steps: list[tuple[int, str]] = [(-1, "")]

    def below(self, parent: int, name: str) -> int:
        number = self.numbers.get((parent, name))
        if number is None:
            number = self.numbers[parent, name] = len(self.steps)
            self.steps.append((parent, name))
        return number

    def names(self, number: int) -> list[str]:
        out = []
        while number > 0:
            number, name = self.steps[number]
            out.append(name)
        return out[::-1]


def _located(pattern: Node) -> tuple[_Paths, list[tuple[Node, int, int]]]:
    """All nodes in order, each with the number of its path and its parent's place in the list."""
    paths, out = _Paths(), []
    waiting = [(pattern, 0, -1)]
    while waiting:
        node, path, parent = waiting.pop()
        out.append((node, path, parent))
        waiting.extend([(k, paths.below(path, k.name), len(out) - 1) for k in reversed(node.kids)])
    return paths, out


def _spared(nodes: list[tuple[Node, int, int]]) -> set[int]:
    """Paths of elements that are asides by name but hold most of the text outside links.

    A menu, header or form that holds more than half of it is what the page is
    wrapped in. Readers' texts are not spared while an element outside of
    asides holds an article.
    """
    inside, held = [], []
    for node, _, parent in nodes:
        inside.append(is_aside(node.name) or (parent >= 0 and inside[parent]))
        held.append(node.chars - node.link_chars if node.name == "#" else 0)
    article = False
    by_path: dict[int, int] = {}
    readers = set()
    for place in range(len(nodes) - 1, -1, -1):
        node, path, parent = nodes[place]
        if parent >= 0:
            held[parent] += held[place]
        article = article or bool(not inside[place] and held[place] and node.name != "#" and _rank(node.name))
        names = _aside_names(node.name)
        if names:
            by_path[path] = by_path.get(path, 0) + held[place]
            if names <= READER_NAMES:
                readers.add(path)
    return {p for p, chars in by_path.items() if 2 * chars > held[0] and not (article and p in readers)}


def _fixed(slot: Node) -> int:
    """The mark of a slot's text if it is the same on enough different pages, or 0."""
    return slot.seen if len(slot.contents) >= FIXED_ON else 0


class _Region:
    """What the elements of one path hold outside of asides."""

    def __init__(self) -> None:
        self.varies = self.chars = self.count = self.pages = 0

    def per_page(self) -> float:
        return self.varies / self.pages

    def each(self) -> float:
        return self.varies / self.count


def _regions(paths: _Paths, nodes: list[tuple[Node, int, int]], spare: set[int]) -> list[int]:
    """Paths of the elements that hold the article, the leading one first; none for the whole page.

    What varies from page to page and is no link decides. An element counts in
    place of what stands in it, unless a surer name in it holds all the same
    text. The leading path has the longest element, so that a group of many
    short ones does not hide a long one. Beside it count all others whose text
    varies; a group of several on a page, which may be teasers, from a share of
    ``BESIDE`` on. Paths that miss half of what varies on the host are not
    where its article stands.
    """
    found: dict[int, _Region] = {}
    gone = []
    for node, path, parent in nodes:
        gone.append((parent >= 0 and gone[parent]) or (is_aside(node.name) and path not in spare))
    varies, chars = [0] * len(nodes), [0] * len(nodes)
    inner: list[dict[int, tuple[int, int]]] = [{} for _ in nodes]
    for place in range(len(nodes) - 1, -1, -1):
        node, path, parent = nodes[place]
        if gone[place]:
            continue
        if node.name == "#":
            varies[place], chars[place] = 0 if _fixed(node) else node.chars - node.link_chars, node.chars
        rank = _rank(node.name) if node.name != "#" else 0
        if rank and chars[place] and _tag_of(node.name) not in ("html", "body"):
            one = found.setdefault(path, _Region())
            one.varies, one.chars = one.varies + varies[place], one.chars + chars[place]
            one.count, one.pages = one.count + node.count, max(one.pages, node.pages)
            surer = False
            if len(inner[place]) == 1:
                (only, held), = inner[place].items()
                surer = _rank(paths.steps[only][1]) > rank and (held[0] == varies[place] > 0 or held[1] == chars[place])
            if not surer:
                inner[place] = {path: (varies[place], chars[place])}
        if parent >= 0:
            varies[parent] += varies[place]
            chars[parent] += chars[place]
            if not inner[parent]:
                inner[parent] = inner[place]
            elif inner[place]:
                both = dict(inner[parent])
                for p, (v, c) in inner[place].items():
                    both[p] = (both.get(p, (0, 0))[0] + v, both.get(p, (0, 0))[1] + c)
                inner[parent] = both
            inner[place] = {}
    kept = set(inner[0])
    for path in inner[0]:
        above = paths.steps[path][0]
        while above > 0 and above not in kept:
            above = paths.steps[above][0]
        if above > 0:
            kept.discard(path)
    ranked = [(found[p].each(), _rank(paths.steps[p][1]), found[p].chars, paths.names(p), p) for p in kept]
    order = [entry[-1] for entry in sorted(ranked, reverse=True)]
    if not order:
        return []
    least = BESIDE * found[order[0]].each()
    order = [p for p in order if p == order[0] or found[p].varies
             and (found[p].count <= found[p].pages or found[p].per_page() >= least)]
    return order if 2 * sum(found[p].varies for p in order) >= varies[0] else []


def plan(pattern: Node) -> dict:
    """Where the article stands in pages of this pattern.

    ``regions`` are the paths of the elements that hold it, the leading one
    first; without any, the whole page is the region. ``spare`` lists elements
    that are not asides in spite of their names. ``drop`` has slots to leave
    out, in their places in the pattern, each with its name, whether links go
    there, the mark of a text that goes, and its number of children.
    """
    paths, nodes = _located(pattern)
    spare = _spared(nodes)
    regions = _regions(paths, nodes, spare)
    return {
        "regions": [paths.names(p) for p in regions], "spare": [paths.names(p) for p in sorted(spare)],
        "drop": _dropped(nodes, set(regions)),
    }


def _dropped(nodes: list[tuple[Node, int, int]], regions: set[int]) -> list | None:
    """Slots to leave out, by what varies around them.

    If the page is the region, slots that are mostly links go, and those always
    the same on different pages. Inside a named region, text that varies shows
    where the article begins and ends. Repeated links go that stand before or
    behind all of it, on different pages; links within it stay. A text always
    the same goes, unless it is a heading or label with article text to come.
    """
    whole = not regions
    state: list[tuple[bool, bool, bool, bool]] = []
    for node, path, parent in nodes:
        inside, listed, heading, label = state[parent] if parent >= 0 else (whole, whole, False, False)
        tag = _tag_of(node.name)
        heading, label = heading or tag in HEADINGS, label or (inside and tag in LABELS)
        listed = listed or (inside and node.repeats)
        state.append((inside or path in regions, listed, heading, label))
    links, fixed = [0] * len(nodes), [0] * len(nodes)
    article = []
    for place, (node, _, _) in enumerate(nodes):
        inside, _, heading, _ = state[place]
        if node.name == "#" and inside and not heading and 2 * node.link_chars <= node.chars and not _fixed(node):
            article.append(place)
    first, last = (article[0], article[-1]) if article else (len(nodes), -1)
    for place, (node, _, _) in enumerate(nodes):
        inside, listed, heading, label = state[place]
        if node.name != "#" or not inside:
            continue
        linked = 2 * node.link_chars > node.chars
        if whole:
            links[place], fixed[place] = int(linked), _fixed(node)
            continue
        around = listed and not heading and not first < place < last
        links[place] = int(linked and around and len(node.contents) >= FIXED_ON)
        fixed[place] = 0 if label and place < last else _fixed(node)
    # Only what leads to such a slot is kept.
    needed = [bool(a or b) for a, b in zip(links, fixed)]
    for place in range(len(nodes) - 1, 0, -1):
        needed[nodes[place][2]] |= needed[place]
    if not needed[0]:
        return None
    return [
        [node.name, links[place], fixed[place], len(node.kids) if needed[place] else 0]
        for place, (node, _, parent) in enumerate(nodes) if parent < 0 or needed[parent]
    ]


class Place:
    """A place in a host's pattern, with what goes there."""

    __slots__ = ("name", "links", "fixed", "kids")

    def __init__(self, row: list):
        self.name, self.links, self.fixed = row[:3]
        self.kids: list[Place] = []


def _trie(paths: list[list[str]]) -> dict:
    """Paths by their steps; the last step holds a mark under an empty name."""
    root: dict = {}
    for names in paths:
        at = root
        for name in names:
            at = at.setdefault(name, {})
        at[""] = True
    return root


class Cutter:
    """A plan made ready for many pages."""

    def __init__(self, where: dict) -> None:
        self.whole = not where["regions"]
        self.leading = _trie(where["regions"][:1])
        self.regions, self.spare = _trie(where["regions"]), _trie(where["spare"])
        self.drop = _rebuilt(where["drop"], Place, lambda p: p.kids) if where["drop"] else None

    def cut(self, page: Node) -> str | None:
        """The blocks of a page's regions, one per line; None if it lacks the leading region.

        A text in a slot to drop goes only if it is mostly links or the fixed
        text itself.
        """
        blocks: list[str] = []
        met, none = self.whole, {}
        waiting = [(page, self.whole, self.drop, self.leading, self.regions, self.spare)]
        while waiting:
            node, inside, place, leading, regions, spare = waiting.pop()
            if is_aside(node.name) and "" not in spare:
                continue
            inside, met = inside or "" in regions, met or "" in leading
            if node.name == "#":
                words = " ".join(node.text.split())
                drop = place and (place.links and _mostly_links(node, words) or place.fixed and place.fixed == _mark(words))
                if inside and words and not drop:
                    blocks.append(words)
                continue
            places = _placed(node.kids, place.kids) if place and place.kids else none
            waiting.extend([
                (k, inside, places.get(id(k)), leading.get(k.name, none), regions.get(k.name, none), spare.get(k.name, none))
                for k in reversed(node.kids)
            ])
        return "\n".join(blocks) if met else None


def cut(page: Node, where: dict) -> str | None:
    return Cutter(where).cut(page)


def _placed(kids: list[Node], slots: list[Place]) -> dict[int, Place]:
    """The place in the pattern of each child, by ``id``.

    The groups of a page are a subsequence of those of its host's pattern;
    each goes to the first place left, which is what aligning does.
    """
    out, at = {}, 0
    by_name: dict[str, list[int]] = {}
    for n, slot in enumerate(slots):
        by_name.setdefault(slot.name, []).append(n)
    for name, ones in groups_of(kids):
        places = by_name.get(name, ())
        here = bisect_left(places, at)
        if here < len(places):
            at = places[here] + 1
            out |= {id(one): slots[places[here]] for one in ones}
    return out


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """On how many pages of a batch each token of a host stands; an empty token counts the pages."""
    for batch in batches:
        counts: Counter = Counter()
        for host, page in zip(batch["host"], batch["page"]):
            counts.update((host, t) for t in {"", *tokens_of_page(page)})
        rows = [(host, token, n) for (host, token), n in counts.items()]
        yield pd.DataFrame(rows, columns=["host", "token", "pages"]).astype({"host": "str", "token": "str", "pages": "int64"})


def tokens_of_page(page: str) -> set[str]:
    return {t for _, _, closing, tag, said in _Scanner(page).tags() if tag and not closing for t in tokens_of(said)}


def common_tokens(rows: DataFrame) -> DataFrame:
    """``host``, ``known``: the classes, ids, roles and properties that name elements of a host.

    A token must stand on ``COMMON`` of the host's pages, so that there are at
    most so many per page times its inverse, and on ``FIXED_ON`` pages or all
    of them. Names made of others, such as an id of each page, would keep pages
    from being aligned and let the pattern grow with their number.
    """
    counts = rows.mapInPandas(_tokens, "host string, token string, pages bigint")
    counts = counts.groupBy("host", "token").agg(F.sum("pages").alias("pages"))
    counts = written(counts, "wrapper_tokens")
    totals = counts.where("token = ''").select("host", F.col("pages").alias("all_pages"))
    least = F.greatest(F.col("all_pages") * COMMON, F.least(F.col("all_pages"), F.lit(FIXED_ON)))
    told = F.collect_list(F.when((F.col("token") != "") & (F.col("pages") >= least), F.col("token")))
    known = counts.join(totals, "host").groupBy("host").agg(F.array_sort(told).alias("known"))
    return written(known.select(F.col("host").alias("known_host"), F.to_json("known").alias("known")), "wrapper_names")


def _patterns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One pattern per host of a batch, of all its pages."""
    for batch in batches:
        seen: dict[str, Node] = {}
        names: dict[str, frozenset] = {}
        for host, page, known in zip(batch["host"], batch["page"], batch["known"]):
            if host not in names:
                names[host] = frozenset(json.loads(known))
            own = fold(parse(page, names[host]))
            seen[host] = merge(seen[host], own) if host in seen else own
        yield pd.DataFrame({"host": list(seen), "pattern": [json.dumps(p.as_list()) for p in seen.values()]}, dtype="str")


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """The pattern of the rows of one host (and part)."""
    patterns = sorted(rows["pattern"])
    whole = Node.from_list(json.loads(patterns[0]))
    for other in patterns[1:]:
        whole = merge(whole, Node.from_list(json.loads(other)))
    out = rows.iloc[:1].copy()
    out["pattern"] = json.dumps(whole.as_list())
    return out


def host_of(url: Column) -> Column:
    """The host of an address in lower case; an empty string if there is none."""
    return F.lower(F.regexp_extract(text_or_empty(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _named_rows(pages: DataFrame, url: str, page: str, keep: dict[str, Column]) -> DataFrame:
    """``host``, ``page``, the columns of ``keep``, and the names ``known`` on the host."""
    rows = pages.select(
        *[c.alias(n) for n, c in keep.items()],
        host_of(F.col(url)).alias("host"), text_or_empty(F.col(page)).alias("page"),
    )
    known = common_tokens(rows.select("host", "page"))
    # A hot host is a hot key of this join; adaptive execution splits it.
    return rows.join(known, rows["host"] == known["known_host"]).drop("known_host")


def _inferred(rows: DataFrame, parts: int) -> DataFrame:
    found = rows.select("host", "page", "known").mapInPandas(_patterns, "host string, pattern string")
    part = F.pmod(F.xxhash64("pattern"), F.lit(parts)).alias("part")
    some = found.select("host", part, "pattern")
    some = some.groupBy("host", "part").applyInPandas(_merged, "host string, part bigint, pattern string")
    return some.drop("part").groupBy("host").applyInPandas(_merged, "host string, pattern string")


def wrappers(pages: DataFrame, url: str = "url", page: str = "html", parts: int = 64) -> DataFrame:
    """``host``, ``pattern``: the wrapper of every host, from all its pages.

    A hot host reaches the last task as at most ``parts`` patterns, whose names
    are bounded by ``common_tokens``.
    """
    return _inferred(_named_rows(pages, url, page, {}), parts)


def main_text(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", parts: int = 64
) -> DataFrame:
    """Per row: ``page_id``, ``url``, ``text``, ``n_chars``, ``region``.

    The text is cut by the wrapper of the page's host; a page that lacks the
    host's region is cut by its own pattern.

    Null and empty pages have an empty text. Pages without a host, null
    addresses included, share one wrapper. Copies of a row get the same text.
    Elements may be nested without end, and a tag that never ends is text. No
    rows give no rows. Other columns are not looked at.
    """
    rows = _named_rows(pages, url, page, {"page_id": F.col(page_id), "url": F.col(url)})
    found = written(_inferred(rows, parts), "wrappers")

    def plans(patterns: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(plan(Node.from_list(json.loads(p)))) for p in patterns], dtype="str")

    where = found.select(F.col("host").alias("plan_host"), F.pandas_udf(plans, "string")("pattern").alias("plan"))
    where = written(where, "wrapper_plans")

    def texts(page_column: pd.Series, known_column: pd.Series, plan_column: pd.Series) -> pd.Series:
        ready: dict[tuple[str, str], tuple[frozenset, Cutter]] = {}
        out = []
        for one, known, chosen in zip(page_column, known_column, plan_column):
            if (known, chosen) not in ready:
                ready[known, chosen] = frozenset(json.loads(known)), Cutter(json.loads(chosen))
            names, cutter = ready[known, chosen]
            tree = parse(one, names)
            text = cutter.cut(tree)
            out.append(cut(tree, plan(fold(tree))) if text is None else text)
        return pd.Series(out, dtype="str")

    joined = rows.join(where, rows["host"] == where["plan_host"])
    text = F.coalesce(F.pandas_udf(texts, "string")("page", "known", "plan"), F.lit(""))
    leading = F.get(F.from_json("plan", "regions array<array<string>>")["regions"], F.lit(0))
    region = F.concat(F.lit("/"), F.array_join(F.coalesce(leading, F.array()), "/"))
    cuts = joined.select("page_id", "url", text.alias("text"), region.alias("region"))
    return cuts.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "region")
