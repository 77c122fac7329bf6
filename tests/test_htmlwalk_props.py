"""Cleaning up incomplete markup leaves complete markup as it is."""
from hypothesis import given, settings
from hypothesis import strategies as st

from newsflow.operators import htmlwalk as H

TAGS = ["div", "p", "span", "a", "h1", "li", "ul", "b", "br", "article", "time", "header"]
text = st.text(alphabet=list("ab é<>&;# \n\t\"'=/"), max_size=8).map(
    lambda t: t.replace("<", "< ").replace("&", "&amp; "))
entity = st.sampled_from(["&amp;", "&lt;", "&gt;", "&quot;", "&#39;", "&nbsp;", "&eacute;", "&#233;"])
attr_val = st.text(alphabet=list("ab c-_1>/&"), max_size=6)
attr = st.tuples(st.sampled_from(["class", "href", "id", "data-x"]), attr_val,
                 st.sampled_from(['"', "'", ""])).map(
    lambda t: f'{t[0]}={t[2]}{t[1]}{t[2]}' if t[2] or (t[1] and all(c not in t[1] for c in " >/'\"=&")) else t[0])


@st.composite
def markup(draw, depth=0):
    parts = []
    for _ in range(draw(st.integers(0, 4))):
        kind = draw(st.sampled_from(["text", "entity", "open", "close", "void", "comment", "script", "elem"]))
        tag = draw(st.sampled_from(TAGS))
        attrs = " ".join(draw(st.lists(attr, max_size=2)))
        sp = " " if attrs else ""
        if kind == "text":
            parts.append(draw(text))
        elif kind == "entity":
            parts.append(draw(entity))
        elif kind == "open":
            parts.append(f"<{tag}{sp}{attrs}>")
        elif kind == "close":
            parts.append(f"</{tag}>")
        elif kind == "void":
            parts.append(f"<{tag}{sp}{attrs}/>")
        elif kind == "comment":
            parts.append(f"<!-- {draw(text)} <p>x</p> -->")
        elif kind == "script":
            parts.append('<script>var s = "</p><div>";</script>')
        elif depth < 3:
            parts.append(f"<{tag}{sp}{attrs}>{draw(markup(depth + 1))}</{tag}>")
    return "".join(parts)


def shape(el):
    if isinstance(el, str):
        return el
    return (el.tag, tuple(sorted(el.attrs.items())), tuple(shape(c) for c in el.children))


def plain_parse(html):
    b = H._Builder()
    b.feed(html)
    b.close()
    return b.finish()


@settings(max_examples=300, deadline=None)
@given(markup())
def test_tidy_changes_no_complete_markup(html):
    assert shape(H.parse(html)) == shape(plain_parse(html))


@settings(max_examples=200, deadline=1000)
@given(markup(), st.integers(1, 60))
def test_truncated_pages_parse(html, cut):
    H.parse(html[:-cut])
    H.parse(html + '<a href="' + "x" * cut)


def test_long_quoted_values_belong_to_their_tag():
    for n in (3_000, 5_000, 1_000_000):
        for quote in "\"'":
            html = f"<div class={quote}c{quote} data-x={quote}<b>{'x' * n}</p>{quote}><p>in</p></div><p>out</p>"
            root = H.parse(html)
            assert shape(root) == shape(plain_parse(html))
            assert root.find("div", "c").text() == "in" and root.text() == "inout"


def test_quotes_are_followed_in_linear_time():
    import time
    for html in ("<a " + "\"<a '\" " * 50_000, "<a b=\"<" * 50_000 + ">", "<a b='<x>" * 50_000 + "\"", "<a \"<b '" * 50_000 + ">", "<title><script" * 50_000 + ">",
                 "<title>" * 50_000, "<textarea><a x=\"" * 50_000):
        t = time.time()
        H.parse(html)
        assert time.time() - t < 5


def test_comment_marks_in_raw_text_end_no_page():
    for raw in ('<script>var s="<!--";</script>', "<style><!-- p{} </style>", "<SCRIPT>a<b</SCRIPT >", "<title>a <!-- b</title>", "<textarea><!-- <p></textarea>"):
        root = H.parse(raw + "<article><p>text</p></article>")
        assert root.find("article").text() == "text"
    assert H.parse("<p>a</p><!--><p>b</p><!-- open <p>c</p>").text() == "ab"
