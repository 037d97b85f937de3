"""A page as a tree of block elements and the texts between them; pages are taken as browsers take them, with what is missing or misplaced put right."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

# Elements of HTML by what they mean for a text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol p plaintext pre search section summary table tbody td tfoot th thead tr ul xmp".split()
)
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
#: Elements whose text isn't part of an article, whatever it says.
FRAME = frozenset("aside audio button canvas datalist dialog fieldset footer form head iframe input math menu meter nav noembed noframes noscript object optgroup option output progress script search select style svg template textarea title video".split())
FLOW = frozenset("blockquote caption dd dt figcaption figure h1 h2 h3 h4 h5 h6 li p pre td th tr tbody thead tfoot".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
#: Words of a class or id that name parts of the frame.
NAMES = frozenset(
    "ad ads adslot adsense advert adverts advertisement advertisements advertising banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer discussion disqus footer gdpr hidden login masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup privacy promo promotion recommended related reply replies respond share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription toolbar topbar".split()
)
HEADERS = frozenset("header site-header page-header main-header global-header top-header".split())
_IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
_SHUT_BY_BLOCK = BLOCKS - frozenset("html body tbody thead tfoot tr td th caption frameset legend li dd dt".split())
_SAME = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tfoot"), "thead": ("tbody", "thead", "tfoot"), "tfoot": ("tbody", "thead", "tfoot"), "option": ("option",), "optgroup": ("optgroup",)}
#: What an end tag, or the implied end of an element, doesn't reach beyond.
_WALLS = frozenset("table td th caption object template html".split())
_LISTS = frozenset("ul ol menu dir dl table".split())

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)?))?")
_PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in RAW}


@lru_cache(4096)
def _named(words: str) -> bool:
    """Whether a class or id names a part of the frame: as a whole, or by one of its words."""
    return any(part.lower() in NAMES for part in _PARTS.findall(words))


@dataclass
class Page:
    """parent, tag (what it means) and label of each block element in page order (0: the root); mark: 1 if a name says that it is frame, 2 if its element does.

    Of each text: ``at``, the block that holds it, ``texts`` with single
    spaces, and ``links`` in it. children: of each block, its blocks (their
    numbers) and texts (-1 - number) in order.
    """

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    label: list[str] = field(default_factory=list)
    mark: list[int] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    at: list[int] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    links: list[list[str]] = field(default_factory=list)

    def add(self, parent: int, tag: str, label: str, mark: int) -> int:
        n = len(self.tag)
        self.parent.append(parent)
        self.tag.append(tag)
        self.label.append(label)
        self.mark.append(mark)
        self.children.append([])
        if parent >= 0:
            self.children[parent].append(n)
        return n


class _Builder:
    def __init__(self):
        self.page = Page()
        self.stack: list[tuple[str, int]] = []  # (tag, its block, or -1 for an inline element)
        self.open: dict[str, list[int]] = {}  # where on the stack a tag is open
        self.walls: list[int] = []
        self.blocks: list[int] = []  # where on the stack blocks are
        self.muted: list[int] = []  # where on the stack inline elements of the frame are
        self.words: list[str] = []
        self.links: list[str] = []
        self.push("html", "html", 0)

    def push(self, tag: str, label: str, mark: int, means: str | None = None) -> None:
        block = tag in BLOCKS
        here = len(self.stack)
        if block:
            self.flush()
            node = self.page.add(self.stack[self.blocks[-1]][1] if self.blocks else -1, means or tag, label, max(mark, 2 if self.muted else 0))
            self.blocks.append(here)
        else:
            node = -1
            if mark:
                self.muted.append(here)
        self.stack.append((tag, node))
        self.open.setdefault(tag, []).append(here)
        if tag in _WALLS:
            self.walls.append(here)

    def close(self, to: int) -> None:
        """Leave the element at this place of the stack and all within it."""
        while len(self.stack) > to:
            here = len(self.stack) - 1
            tag, node = self.stack[-1]
            if node >= 0:
                self.flush()
                self.blocks.pop()
            self.stack.pop()
            self.open[tag].pop()
            for marks in (self.walls, self.muted):
                if marks and marks[-1] == here:
                    marks.pop()

    def place(self, tag: str, above: int) -> int:
        """Where the tag was opened last, if that is above a place of the stack; else -1."""
        at = self.open.get(tag)
        return at[-1] if at and at[-1] > above else -1

    def wall(self, tag: str) -> int:
        """The place that the end of ``tag`` doesn't reach: parts of a table end within their table only, others within their cell."""
        if tag in ("tr", "td", "th", "tbody", "thead", "tfoot", "caption"):
            return self.place("table", -1)
        if tag in _WALLS:
            return -1
        return self.walls[-1]

    def flush(self) -> None:
        if self.words:
            text = " ".join("".join(self.words).split())
            if text:
                node = self.stack[self.blocks[-1]][1]
                self.page.children[node].append(-1 - len(self.page.texts))
                self.page.at.append(node)
                self.page.texts.append(text)
                self.page.links.append(self.links)
                self.links = []
            self.words = []
        if self.links:
            self.links = []

    def text(self, raw: str) -> None:
        if not self.muted:
            self.words.append(unescape(raw) if "&" in raw else raw)

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "br" or tag == "wbr":
            if tag == "br":
                self.text(" ")
            return
        if tag == "hr":
            self.flush()
            return
        if tag in VOID:
            return
        if tag == "html" or (tag == "body" and self.open.get("body")) or (tag == "head" and len(self.stack) > 1):
            return  # there is one of each
        if tag == "body" or (self.open.get("head") and tag not in _IN_HEAD):
            self.close(1)
        if tag in _SHUT_BY_BLOCK:
            p = self.place("p", self.walls[-1])
            if p >= 0:
                self.close(p)
        if tag in HEADINGS and self.blocks and self.stack[self.blocks[-1]][0] in HEADINGS:
            self.close(self.blocks[-1])
        if tag in _SAME:
            wall = max([self.wall(tag), *(self.place(x, -1) for x in _LISTS if tag in ("li", "dd", "dt"))])
            for other in _SAME[tag]:
                at = self.place(other, wall)
                if at >= 0:
                    self.close(at)
        if tag == "a" and "href" in attributes and not self.muted:
            self.links.append(attributes["href"])
        means, mark = tag, 0
        if attributes:
            role = attributes.get("role", "").lower()
            names = " ".join(attributes[k] for k in ("class", "id") if attributes.get(k))
            if role in ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in attributes.get("style", "").lower().replace(" ", ""):
                mark = 2
            elif tag == "article" and not self.open.get("article"):
                mark = int(not {"comment", "reply"}.isdisjoint(names.split()))
            elif names and tag not in ("html", "body", "main") and tag not in HEADINGS and _named(names):
                mark = 1
            if tag in ("div", "section") and not mark:
                means = "main" if role == "main" else "article" if "articlebody" in attributes.get("itemprop", "").lower() or role == "article" else "header" if not HEADERS.isdisjoint(names.lower().split()) else tag
        if tag in FRAME:
            mark = max(mark, 1 if tag == "form" else 2)
        label = tag
        if tag in BLOCKS and attributes:
            kind = " ".join(sorted(re.sub(r"\d+", "0", attributes.get("class", "")).split()))
            label = f"{tag}.{kind}.{attributes.get('role', '')}"
        self.push(tag, label, mark, means)

    def end(self, tag: str) -> None:
        if tag == "br":
            return self.text(" ")
        if tag in ("html", "body"):
            return None  # what follows still belongs to the body
        if tag in BLOCKS:
            at = self.place(tag, self.wall(tag))
            if at < 0 and tag in HEADINGS and self.blocks and self.stack[self.blocks[-1]][0] in HEADINGS:
                at = self.blocks[-1]
        else:
            at = self.place(tag, -1 if tag in _WALLS else self.walls[-1] if tag in FRAME else self.blocks[-1])
        if at >= 1:
            self.close(at)
        return None


def parse(html: str | None) -> Page:
    """The tree of a page, in time that grows with its length."""
    build = _Builder()
    html = html or ""
    at, end = 0, len(html)
    while at < end:
        tag = html.find("<", at)
        if tag < 0:
            build.text(html[at:])
            break
        if tag > at:
            build.text(html[at:tag])
        found = _NAME.match(html, tag)
        if found is None:
            nxt = html[tag + 1 : tag + 2]
            if html.startswith("<!--", tag):
                shut = html.find("-->", tag + 2)
                at = end if shut < 0 else shut + 3
            elif nxt in ("!", "?", "/") and nxt:
                shut = html.find(">", tag)
                at = end if shut < 0 else shut + 1
            else:
                build.text("<")
                at = tag + 1
            continue
        name, at = found.group(1).lower(), found.end()
        attributes: dict[str, str] = {}
        while at < end and html[at] != ">":
            part = _ATTRIBUTE.match(html, at)
            if part is None:  # only blanks or slashes are left before the end of the tag
                shut = html.find(">", at)
                at = end if shut < 0 else shut
                break
            value = part.group(2) or part.group(3) or part.group(4) or ""
            attributes.setdefault(part.group(1).lower(), unescape(value) if "&" in value else value)
            at = part.end()
        at += 1
        if html[tag + 1] == "/":
            build.end(name)
            continue
        build.start(name, attributes)
        if name in RAW:  # all of these are frame or head: their text is dropped
            shut = _END[name].search(html, at)
            at = end if shut is None else shut.start()
    build.close(1)
    build.flush()
    return build.page


@dataclass
class Article:
    """Texts of a page that may be its article (their numbers), and whether the page says where its article is; roots: the blocks that hold it."""

    texts: list[int]
    said: bool
    roots: set[int]


def article_of(page: Page) -> Article:
    """The texts within the page's articles, else within its main part, else all; without what is marked as frame.

    The name of a class or id doesn't count where it would take the only
    article with it. Of a header within the article the headings stay.
    """
    n = len(page.tag)
    holds = [t in ("article", "main") for t in page.tag]

    def frames(names: bool, spared: set[int]) -> list[bool]:
        out = [False] * n
        inside = [False] * n  # an article or main part
        for i in range(n):
            p = page.parent[i]
            up = p >= 0
            inside[i] = (up and inside[p]) or holds[i]
            own = page.mark[i] == 2 or (names and page.mark[i] == 1 and i not in spared) or (page.tag[i] == "header" and not (up and inside[p]))
            out[i] = own or (up and out[p])
        return out

    frame = frames(True, set())
    roots = [i for i in range(n) if holds[i] and not frame[i]]
    if not roots and any(holds):
        spared: set[int] = set()
        for i in range(n):
            if holds[i] and page.mark[i] == 0:
                while i >= 0 and i not in spared:
                    spared.add(i)
                    i = page.parent[i]
        frame = frames(True, spared)
        roots = [i for i in range(n) if holds[i] and not frame[i]]
    headed = [False] * n  # within a header of the article
    for i in range(n):
        p = page.parent[i]
        headed[i] = page.tag[i] == "header" or (p >= 0 and headed[p])
    headline = [False] * n
    for i in range(n):
        p = page.parent[i]
        headline[i] = page.tag[i] in HEADINGS or (p >= 0 and headline[p])
    fine = [k for k, i in enumerate(page.at) if not frame[i] and (not headed[i] or headline[i])]
    for kind in ("article", "main"):
        top = [False] * n
        for i in range(n):
            p = page.parent[i]
            top[i] = (p >= 0 and top[p]) or (page.tag[i] == kind and not frame[i])
        some = [k for k in fine if top[page.at[k]]]
        if some:
            return Article(some, True, {i for i in range(n) if top[i] and not (page.parent[i] >= 0 and top[page.parent[i]])})
    return Article(fine, False, {0})
