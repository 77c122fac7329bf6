"""Main text of web pages by classifying flat text blocks.

The standard library's HTML parser cuts a page into blocks of text at block
level tags. A block is described by its words and link density, those of its
neighbours, the kind of elements it stands in and what their class or id names
say. A small decision tree (Gini, fitted here on the labelled pages below)
tells article blocks from the rest.

Defined results: a null or empty page has an empty text; truncated and badly
nested markup is read as far as it goes; no block is too long; pages are
judged one by one, so repeated rows get equal results; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.operators.markup import tidy

# Elements whose start or end ends a block of text.
BLOCK_TAGS = frozenset("""address article aside blockquote body button center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
search section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Never text of the page.
SILENT = frozenset("script style noscript template title textarea select option button svg math iframe object canvas audio video".split())
FURNITURE = frozenset("nav header footer aside form menu dialog fieldset search".split())
CONTENT = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Parts of class and id names, and of roles.
NOISE_NAME = re.compile(r"""(?:^|[\s_-])(?:ads?|advert\w*|adbox|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|side-?bar|aside|widgets?|
    footer|foot|header|masthead|topbar|toolbar|cookies?|consent|notices?|gdpr|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|
    related|recommend\w*|comments?|commentlist|replies|reply|respond|disqus|pagination|pager|tags?|meta|copyright|legal|search|skip|alert|
    navigation|complementary|contentinfo|dialog)(?=$|[\s_-])""", re.I | re.X)
TEXT_NAME = re.compile(r"(?:^|[\s_-])(?:article\w*|content|entry|post|story|body|text|main|prose)(?=$|[\s_-])", re.I)
# Names that only look like furniture: an article's own header, and layout flags.
OWN_NAME = re.compile(r"(?:article|entry|post|story|page|content|main)[_-]{0,2}(?:header|head|heading|title|text)(?=$|[\s_-])"
                      r"|(?:^|(?<=\s))(?:no|has|with|without|hide|show)-[\w-]+", re.I)
COMMENT_NAME = re.compile(r"(?:^|[\s_-])comments?(?=$|[\s_-])", re.I)
HIDDEN_STYLE = re.compile(r"display\s*:\s*none", re.I)
SPACE = re.compile(r"\s+")

STRETCH = (0.05, 0.2, 0.5, 2.0, 5.0, 20.0, 100.0)
FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after",
            "in_content", "in_furniture", "noise_name", "text_name", "heading", "list_item")


class Blocks(HTMLParser):
    """Collects (text, linked characters, context) of a page's blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, float, tuple[int, ...]]] = []
        self.open: list[tuple[str, int]] = []         # open block elements and the marks they carry
        self.marks: list[int] = [0] * 7               # content, furniture, noise, text name, heading, list item, silent
        self.parts: list[str] = []
        self.linked = self.anchor = 0

    def cut(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.found.append((text, min(1.0, self.linked / len(text)), tuple(int(m > 0) for m in self.marks[:6])))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.anchor += 1
        elif tag == "br":
            self.parts.append(" ")
        if tag in BLOCK_TAGS:
            self.cut()
            if tag == "p":
                self.leave("p", BLOCK_TAGS - {"p"})
            elif tag in ("li", "tr", "td", "th", "dd", "dt", "option"):
                self.leave(tag, frozenset(("ul", "ol", "menu", "table", "tbody", "dl", "select")))
        if tag in VOID or tag not in BLOCK_TAGS and tag not in SILENT:
            return
        names = OWN_NAME.sub(" post ", " ".join(v for k, v in attrs if v and k in ("class", "id", "role")))
        noise = NOISE_NAME if tag not in ("html", "body", "article", "main") else COMMENT_NAME
        hidden = any(k == "hidden" or k == "style" and v and HIDDEN_STYLE.search(v) for k, v in attrs)
        furniture = tag in FURNITURE and not (tag == "header" and self.marks[0])   # an article's header holds its title
        bits = [tag in CONTENT, furniture, bool(names) and bool(noise.search(names)),
                bool(names) and bool(TEXT_NAME.search(names)), tag in HEADINGS, tag == "li", tag in SILENT or hidden]
        mask = sum(1 << i for i, b in enumerate(bits) if b)
        self.open.append((tag, mask))
        self.count(mask, 1)

    def count(self, mask: int, by: int) -> None:
        if mask:
            for i in range(7):
                if mask >> i & 1:
                    self.marks[i] += by

    def leave(self, tag: str, stop: frozenset = frozenset()) -> None:
        """Ends the innermost open ``tag``, and all inside it, unless an
        element in ``stop`` is in between."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                for _, mask in self.open[at:]:
                    self.count(mask, -1)
                del self.open[at:]
                return
            if self.open[at][0] in stop:
                return

    def handle_endtag(self, tag):
        if tag == "a":
            self.anchor = max(0, self.anchor - 1)
        if tag in BLOCK_TAGS:
            self.cut()
            self.anchor = 0 if tag != "a" and tag in ("li", "p", "nav", "ul", "div") else self.anchor
        if tag in BLOCK_TAGS or tag in SILENT:
            self.leave(tag)

    def handle_data(self, data):
        if self.marks[6]:
            return
        self.parts.append(data)
        if self.anchor:
            self.linked += len(data.strip())


def blocks_of(html: str | None) -> list[tuple[str, float, tuple[int, ...]]]:
    if not html:
        return []
    parser = Blocks()
    parser.feed(tidy(html))
    parser.close()
    parser.cut()
    return parser.found


def features_of(blocks: list[tuple[str, float, tuple[int, ...]]]) -> np.ndarray:
    words = np.array([b[0].count(" ") + 1 for b in blocks], float)
    links = np.array([b[1] for b in blocks], float)
    pad = lambda x, n: np.concatenate(([0.0] * max(n, 0), x, [0.0] * max(-n, 0)))
    before = [pad(x, 1)[:-1] for x in (words, links)]
    after = [pad(x, -1)[1:] for x in (words, links)]
    return np.column_stack([words, links, *before, *after, np.array([b[2] for b in blocks], float)])


# The labelled table: small pages, and for each of their blocks in order 1
# (article) or 0. Its rows are the blocks' features.
LABELLED = (
    ("""<body><header><a href=/>The Daily</a></header><nav><ul><li><a href=/a>News</a></li><li><a href=/b>Sport</a></li></ul></nav>
     <article><h1>Council votes on bridge</h1><p>The council voted on Monday to repair the old bridge, after a long debate about its cost.</p>
     <p>No.</p><p>Work starts in <a href=/may>May</a>.</p><ul><li>Cost: two million</li><li>Time: one year</li></ul></article>
     <aside><h2>Most read</h2><p><a href=/x>Ten things to know about the bridge</a></p></aside><footer>Copyright The Daily, all rights reserved.</footer></body>""",
     "000111111000"),
    ("""<body><div class=topbar><a href=/>Home</a> <a href=/login>Log in</a></div><div class="cookie-notice">We use cookies to give you the best experience on
     our pages and to measure how they are used. <a href=/c>More</a></div><div class="entry-content"><h2>A walk in the hills</h2><p>We left early, when the
     valley was still in fog, and climbed for two hours.</p><p>Then rain.</p><blockquote>The hills do not wait, said our guide.</blockquote></div>
     <div id=comments><h3>2 comments</h3><div class=comment><p>What a lovely walk, I did the same tour last year with my family and we liked it a lot.</p></div>
     <div class=comment><p>Nice</p></div></div><div class=sidebar><p>About the author: she writes about hills, valleys and long walks in the rain.</p></div>
     <div class=footer>Contact <a href=/i>Imprint</a></div></body>""", "00" + "1111" + "00000"),
    ("""<body><table><tr><td><a href=/1>One</a></td><td><a href=/2>Two</a></td><td><a href=/3>Three</a></td></tr></table>
     <div><p>Engineers have measured the flow of the river for thirty years, and their tables show how quickly it has changed since the dam was built upstream.</p>
     <p>Each spring the level rises by two metres within a week, which the old bridge was never made for, and the fields along the banks are flooded.</p>
     <p>The new plan keeps more water behind the dam in March and lets it go in May, when the ground is dry enough to take it without any harm.</p></div>
     <div><a href=/p>Previous</a> <a href=/n>Next</a></div><div>Printed on recycled paper</div></body>""", "000" + "111" + "00"),
    ("""<body><main><h1>Bread</h1><p>Flour, water, salt.</p><p>Mix. Wait. Bake for forty minutes until the crust is dark and sounds hollow.</p>
     <form><p>Sign up for our weekly letter about bread and get a free book of recipes for every season of the year.</p><label>Mail</label></form>
     <div class="ad-box"><p>Buy the best flour of the region now, for half the price, in all our shops and on the internet until Sunday.</p></div>
     <p>Enjoy.</p></main><footer><p>A site by bakers for bakers, since 1999, with no other aim than good bread on every table.</p></footer></body>""",
     "111" + "000" + "10"),
    ("""<body><div class="menu"><ul><li><a href=/>Start</a></li><li>Archive</li></ul></div><div class="article-body"><p>Prices rose.</p><p>By noon the market
     had calmed, and traders went back to their tables to count what they had lost since the morning.</p><pre>open 10 close 9</pre></div>
     <div class="related"><h4>Related</h4><ul><li><a href=/q>Prices fell last week on the same market</a></li></ul></div>
     <div class="share">Share this</div><div class="newsletter">Never miss a story, let us write to you each morning before the market opens.</div></body>""",
     "00" + "111" + "0000"),
    ("""<body><nav>You are here: <a href=/>Home</a> / Science</nav><article><header><h1>Moons</h1><p>By a staff writer</p></header><section><h2>First</h2><p>A moon
     was found.</p></section><figure><figcaption>The moon at night</figcaption></figure><div class="promo">Subscribe now and read all about moons, stars and planets for only one coin a month.</div>
     <section class="comments"><article><p>I have seen this moon from my garden and it was a very bright and beautiful sight indeed.</p></article></section>
     <p>It has no name yet.</p></article><div class="banner">Winter sale</div><div role="contentinfo">Publisher, street, town</div></body>""",
     "0" + "1111" + "1" + "00" + "1" + "00"),
    ("""<body><header><h1>My blog</h1><p>Thoughts on everything that I come across on my way to work, and back home in the evening.</p></header>
     <div id="post"><h2>Trains</h2><p>Late again.</p><p>They say the <a href=/w>weather</a> did it.</p></div>
     <div id="respond"><p>Leave a reply to tell us what you think about this story, your address will not be shown.</p></div>
     <footer><ul><li><a href=/a>About</a></li><li>Legal</li></ul></footer></body>""", "00" + "111" + "0" + "00"),
    ("""<body><div class="notice">This page has moved, please change your bookmarks as soon as you can, the old address will go.</div>
     <article><p>Short.</p><p>One two three four five six seven eight nine ten.</p><p><a href=/s>See all the documents of the inquiry</a></p></article>
     <div class="ad">Best offers today</div><footer>(c) site, a very long line of text that tells who made this page and when, and who may use it for what.</footer></body>""",
     "0" + "111" + "00"),
    ("""<body><div><span><a href=/1>Home</a> <a href=/2>Map</a> <a href=/3>Help</a> <a href=/4>Contact</a></span></div><div>The library opens its reading room
     to all visitors from Monday on, after two years of work on the roof, the floor and the windows of the great hall.</div><div>Visitors need a card, which is free for
     those who live in the town and costs a small sum for all others, as the director said on Friday.</div><div>Help us</div></body>""", "0" + "11" + "0"),
    ("<article><p>Hi there.</p></article>", "1"),
    ("<main><h1>Closed</h1></main>", "1"),
    ("<body>Just one line of plain text.</body>", "1"),
    ("<p>The letter was short, and nobody had expected that.</p><p>It said yes.</p>", "11"),
    ("""<div class="sidebar">Quick links</div><article><p>It is over.</p></article>""", "01"),
    ("""<article><h1>Notes</h1><p>Rain.</p></article><div>Partner site</div><div>Top</div>""", "11" + "00"),
    ("""<nav><a href=/>Home</a></nav><article><h2>Sources</h2><ul><li><a href=/1>The first report of the committee</a></li><li><a href=/2>Annex</a></li></ul></article>
     <p>Imprint</p>""", "0" + "111" + "0"),
    ("""<article><p><a href=/full>Read the whole decision</a></p><p>Done.</p></article><p><a href=/up>Back to top</a></p><p>Hosted by a friend of the house</p>""", "11" + "00"),
    ("""<div><a href=/>Start</a> <a href=/all>All</a></div><div><h1>Opening hours</h1><p>From Monday to Friday the office is open from nine to five.</p></div><div><a href=/i>Imprint</a></div>""",
     "0" + "11" + "0"),
)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    x, y = [], []
    for html, labels in LABELLED:
        blocks = blocks_of(html)
        if len(blocks) != len(labels):
            raise ValueError(f"{len(labels)} labels for {len(blocks)} blocks: {[b[0][:30] for b in blocks]}")
        x.append(features_of(blocks))
        y += [int(c) for c in labels]
    x, y = np.vstack(x), np.array(y)
    # Where the markup names a block's role, its length says nothing: the same
    # blocks count again with other lengths, so the tree cannot learn theirs.
    named = x[:, [FEATURES.index(f) for f in ("in_content", "in_furniture", "noise_name", "text_name")]].any(axis=1)
    lengths = [FEATURES.index(f) for f in ("words", "words_before", "words_after")]
    again = []
    for factor in STRETCH:
        more = x[named].copy()
        more[:, lengths] = np.ceil(more[:, lengths] * factor)
        again.append(more)
    return np.vstack([x, *again]), np.concatenate([y, *[y[named]] * len(STRETCH)])


def grow(x: np.ndarray, y: np.ndarray, depth: int) -> tuple | int:
    """A decision tree by Gini impurity: (feature, cut, below, above) or a class.
    Of equal splits the first feature and the smallest cut are taken."""
    if depth == 0 or len(np.unique(y)) == 1:
        return int(2 * y.sum() >= len(y))
    best = (np.inf, 0, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            gini = sum(m.sum() * (1 - (p := y[m].mean()) ** 2 - (1 - p) ** 2) for m in (low, ~low))
            if gini < best[0] - 1e-12:
                best = (gini, f, float(cut))
    if not np.isfinite(best[0]):
        return int(2 * y.sum() >= len(y))
    _, f, cut = best
    low = x[:, f] <= cut
    return f, cut, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


@lru_cache(1)
def tree(depth: int = 8) -> tuple:
    return grow(*labelled_table(), depth)


def classify(x: np.ndarray, node: tuple | int) -> np.ndarray:
    if not isinstance(node, tuple):
        return np.full(len(x), node)
    f, cut, below, above = node
    low = x[:, f] <= cut
    out = np.empty(len(x), int)
    out[low], out[~low] = classify(x[low], below), classify(x[~low], above)
    return out


def main_text(html: str | None) -> str:
    blocks = blocks_of(html)
    if not blocks:
        return ""
    return "\n".join(b[0] for b, keep in zip(blocks, classify(features_of(blocks), tree()), strict=True) if keep)


def extract(pages: DataFrame, html: str = "html", out: str = "main_text") -> DataFrame:
    """``pages`` with the string column ``out``."""
    def texts(htmls: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in htmls], dtype=object)
    return pages.withColumn(out, F.pandas_udf(texts, "string")(F.col(html)))
