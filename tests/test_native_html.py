"""Native extraction against the element tree."""
import html as stdlib_html
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from newsflow import sites as S
from newsflow.operators import extract as X
from newsflow.operators import nativehtml as N
from newsflow.plans import bindings as B

CFG = next(iter(B.pages_profiles().values()))


def decoded(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    return [r[0] for r in df.select(N.decode_references(F.col("t"))).collect()]


def test_all_named_references_decode(spark):
    texts = [f"x&{n}y &{n}" for n in html5] + [f"&{n.rstrip(';')}" for n in html5]
    assert decoded(spark, texts) == [stdlib_html.unescape(t) for t in texts]


def test_numbers_and_odd_references_decode(spark):
    numbers = [*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x10FFFF, 0x110000, 10 ** 12]
    texts = [f"a&#{n};b" for n in numbers] + [f"&#x{n:x};&#X{n:X}g" for n in numbers] + [f"&#{n:09d} " for n in numbers]
    texts += ["&", "&&", "&;", "&#;", "&#x;", "&#xg;", "&amp;lt;", "&amp;amp;amp;", "&notit;", "&notin;", "&copy2", "&COPYx", "&unknown;", "a & b", "&" + "x" * 40 + ";",
              "&lt;b&gt;", "&ampamp;", "caf&eacute; &ndash; l&rsquo;&eacute;t&eacute;", "", "no reference", "&\tamp;", "&é;"]
    assert decoded(spark, texts) == [stdlib_html.unescape(t) for t in texts]


def page(draw):
    ref = lambda: draw.choice(["&eacute;", "&amp;", "&hellip;", "&rsquo;", "&#233;", "&copy", "&nbsp;", "&lt;", "&notin;", "&", "&x;", " ", "w", "été", "a < b", "1>0"])
    attr = lambda: draw.choice(["", ' title="a>b"', " data-x='1>2 <p>'", ' alt="it\'s"', " data-y=x", " hidden", ' title="</p>"'])
    text = lambda: "".join(ref() for _ in range(draw.randrange(0, 5)))
    inline = lambda: draw.choice([text(), f"<b{attr()}>{text()}</b>", f"<img{attr()}>", "<br/>", "<!-- <p> > -->", f"<a{attr()} href='x'>{text()}</a>"])
    para = lambda: f"<p{attr()}>" + "".join(inline() for _ in range(draw.randrange(0, 4))) + draw.choice(["</p>", "</P >"])
    href = lambda: draw.choice([' href="/a?x=1&amp;y=2"', " href='/q&eacute;>'", " href=/bare&copy;", "", ' data-href="no" href="yes"', ' title="href=no>" href="t"'])
    card = lambda: f"<li{attr()}>{text()}<a{attr()}{href()}>{text()}</a><a href='second'>2</a></li>"
    junk = lambda: draw.choice(["", "<script>var a='<p>&eacute;</p><h1>';</script>", "<style>p>a{}</style>", "<!-- <h1>no</h1> -->", "<template><h1>t</h1></template>"])
    return (f"{junk()}<nav{attr()}><ul>" + "".join(card() for _ in range(draw.randrange(0, 4))) + f"</ul></nav>{junk()}<h1{attr()}>{inline()}{text()}</h1>"
            f"<article{attr()}>{junk()}" + "".join(para() for _ in range(draw.randrange(0, 4))) + f"</article>{junk()}<time>{text()}</time>")


def test_native_equals_the_tree(spark):
    draw = random.Random(11)
    pages = [page(draw) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string").coalesce(1)
    fields = N.page_fields(F.col("html"), CFG)
    rows = df.select("i", N.page_links(F.col("html"), CFG).alias("links"), *[v.alias(k) for k, v in fields.items()]).collect()
    for r in rows:
        html = pages[r.i]
        assert [(x.card_no, x.href, x.failed) for x in r.links] == X.page_links(html, CFG), html
        title, date, body, _ = X.page_fields(html, CFG)
        assert (r.title_raw, r.date_text, r.body_raw) == (title, date, body), html


@pytest.mark.parametrize("html", ["<h1 title=\"a>b\">T</h1>", "<p data-x=\"1>2\">q <img alt=\"a>b\"> r</p>", "<h1>Caf&eacute; &ndash; l&rsquo;&eacute;t&eacute;</h1>"])
def test_quoted_marks_and_french_references(spark, html):
    html = f"<article>{html}<p>x</p><p>last</p></article>"
    df = spark.createDataFrame([(html,)], "html string")
    fields = df.select(*[v.alias(k) for k, v in N.page_fields(F.col("html"), CFG).items()]).first()
    title, _, body, _ = X.page_fields(html, CFG)
    assert (fields.title_raw, fields.body_raw) == (title, body)


def test_long_tags_take_linear_time(spark):
    import time
    texts = ["<p " + 'a="' * 100_000 + ">x</p>", "<p" + " x=" * 100_000 + ">x</p>", "<a " + "href" * 100_000, "&" * 200_000, "&amp" * 100_000, "<a b='" * 50_000]
    df = spark.createDataFrame([(f"<nav><li>{t}</li></nav><article>{t}</article>",) for t in texts], "html string").coalesce(1)
    t = time.time()
    df.select(N.page_links(F.col("html"), CFG), *N.page_fields(F.col("html"), CFG).values()).collect()
    assert time.time() - t < 30


def test_sites_have_class_selectors():
    assert not any(N.is_plain(s) for s in S.SITES) and not any(N.is_plain(p) for p in B.classed_profiles().values())
