"""A small element tree for the per-page helper inside the extraction job's
``mapInPandas`` tasks, built by the standard ``html.parser``. It serves
selectors by class; single-tag pages are read natively (``nativehtml``).
Elements are indexed by tag with pre-order numbers, so ``find`` scans only
elements of the wanted tag inside the subtree.

Contract (SURVEY X8): first match in document order; text of descendants
concatenated in order; character references decoded; comments and
script/style text excluded; void elements; a new ``p`` (or another block
start tag) closes an open ``p``, a new ``li`` closes an open ``li``; an end
tag closes up to its matching open element and is ignored otherwise.
"""

from __future__ import annotations

from bisect import bisect_right
from html.parser import HTMLParser

from newsflow.operators.markup import tidy

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset(("script", "style", "template"))
CLOSES_P = frozenset(("address article aside blockquote details dialog div dl fieldset figcaption figure "
                      "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table "
                      "ul").split())
SCOPE = frozenset(("html", "table", "td", "th", "caption", "button", "template", "object", "marquee", "applet"))
LIST_SCOPE = SCOPE | {"ul", "ol"}


class Element:
    """An element; ``seq`` is its pre-order number and ``end`` the number of
    its last descendant, so subtree membership is a range test against the
    per-tag index kept by the document root."""
    __slots__ = ("tag", "attrs", "children", "parent", "seq", "end", "doc")

    def __init__(self, tag: str, attrs: dict, parent: Element | None, seq: int = 0, doc=None):
        self.tag = tag
        self.attrs = attrs
        self.children: list = []
        self.parent = parent
        self.seq = seq
        self.end = seq
        self.doc = doc

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def get(self, name: str):
        return self.attrs.get(name)

    def iter(self):
        """Descendant elements in document order (pre-order)."""
        stack = list(reversed([c for c in self.children if isinstance(c, Element)]))
        while stack:
            el = stack.pop()
            yield el
            stack.extend(reversed([c for c in el.children if isinstance(c, Element)]))

    def _texts(self):
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, Element):
                if node.tag not in RAW_TEXT:
                    stack.extend(reversed(node.children))
            else:
                yield node

    def text(self) -> str:
        """``get_text()``."""
        return "".join(self._texts())

    def text_stripped(self) -> str:
        """``get_text(strip=True)``: every text node stripped, empties dropped."""
        return "".join(t.strip() for t in self._texts() if t.strip())

    def _candidates(self, tag: str):
        """Descendants with this tag, in document order (from the tag index)."""
        idx = self.doc.index.get(tag) if self.doc is not None else None
        if idx is None:
            return
        seqs, els = idx
        for k in range(bisect_right(seqs, self.seq), len(els)):
            el = els[k]
            if el.seq > self.end:
                return
            yield el

    def find(self, tag: str, cls: str | None = None) -> Element | None:
        for el in self._candidates(tag):
            if matches(el, tag, cls):
                return el
        return None

    def find_all(self, tag: str, cls: str | None = None) -> list[Element]:
        return [el for el in self._candidates(tag) if matches(el, tag, cls)]


class _Document(Element):
    __slots__ = ("index", "count")

    def __init__(self):
        super().__init__("[document]", {}, None, 0, None)
        self.doc = self
        self.index: dict[str, tuple[list[int], list[Element]]] = {}
        self.count = 0


def matches(el: Element, tag: str, cls: str | None) -> bool:
    if el.tag != tag:
        return False
    if cls is None:
        return True
    if " " in cls.strip():
        return " ".join(el.classes) == " ".join(cls.split())
    return cls in el.classes


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Document()
        self.stack: list[Element] = [self.root]

    def _close_from(self, i: int) -> None:
        last = self.root.count
        for el in self.stack[i:]:
            el.end = last
        del self.stack[i:]

    def _open_index(self, tag: str, scope: frozenset) -> int:
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t == tag:
                return i
            if t in scope:
                return -1
        return -1

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            i = self._open_index("p", SCOPE)
            if i > 0:
                self._close_from(i)
        if tag == "li":
            i = self._open_index("li", LIST_SCOPE)
            if i > 0:
                self._close_from(i)
        doc = self.root
        doc.count += 1
        parent = self.stack[-1]
        el = Element(tag, {k: (v if v is not None else "") for k, v in attrs}, parent, doc.count, doc)
        parent.children.append(el)
        seqs, els = doc.index.setdefault(tag, ([], []))
        seqs.append(el.seq)
        els.append(el)
        if tag not in VOID:
            self.stack.append(el)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag:
            self._close_from(len(self.stack) - 1)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._close_from(i)
                return

    def handle_data(self, data):
        kids = self.stack[-1].children
        if kids and isinstance(kids[-1], str):       # adjacent text is one node (as in bs4)
            kids[-1] += data
        else:
            kids.append(data)

    def finish(self) -> Element:
        self._close_from(0)
        return self.root


def parse(html: str | None) -> Element:
    """The tree of a page. Incomplete markup is cleaned up first (``tidy``), so
    truncated tags and open quotes cost linear time."""
    b = _Builder()
    if html:
        b.feed(tidy(html))
        b.close()
    return b.finish()
