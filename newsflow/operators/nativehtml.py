"""Native extraction for pages whose selectors are plain tags.

Where a site's selectors name no class, links, title and paragraphs are read
with regular expressions inside the JVM; no page leaves it. Elements with class
selectors need the element tree (``htmlwalk``), which reads the same text: all
character references of HTML 5 are decoded, named ones with and without their
semicolon and numeric ones, in one pass; a ``>`` inside a quoted attribute value
ends no tag; comments and the contents of script, style and template are no text.
"""

from __future__ import annotations

import html as stdlib_html
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow import sites as S
from newsflow.functions.dates import bind
from newsflow.functions.text import strip_ws

# The commonest references are tried first, the standard's table after them.
COMMON = {n: html5[n] for n in ("amp;", "nbsp;", "quot;", "lt;", "gt;", "eacute;", "rsquo;", "egrave;", "agrave;", "laquo;", "raquo;")}
#: Names that need no semicolon; of two that fit, the longer counts.
BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
#: Numbers below 160 do not all stand for themselves.
LOW = [stdlib_html.unescape(f"&#{n};") for n in range(160)]
_MARK, _SAYS = "\x02", "\x03"
#: The whole table as one string, which a plan holds at less cost than a map.
TABLE = _MARK + _MARK.join(f"{n}{_SAYS}{v}" for n, v in html5.items()) + _MARK

ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
SILENT = r"(?si)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
TEMPLATE = r"(?si)<template\b.*?(?:</template\s*>|\z)"     # found by selectors, but no text of what holds it
TAG = rf"<[a-zA-Z/!?]{ATTRIBUTES}(?:>|\z)"


def is_plain(cfg: S.Site) -> bool:
    """No selector names a class, and the body is made of paragraphs."""
    selectors = [cfg.container, cfg.card, cfg.link, cfg.title, cfg.date, *cfg.body]
    return all(s[1] is None for s in selectors) and cfg.link[0] == "a" and cfg.body_kind == "paragraphs" \
        and not cfg.title_child and not cfg.type_sel


def _start(tag: str) -> str:
    return rf"<{tag}(?:[\s/]{ATTRIBUTES})?>"


def _before(stop: str) -> str:
    """Text and whole tags up to ``stop``, so that nothing is found inside an
    attribute value. Possessive: Java runs it without recursion."""
    return rf"(?:[^<]++|(?!{stop})<(?:[a-zA-Z/!?]{ATTRIBUTES}(?:>|\z))?+)*+"


def element(html: Column, tag: str) -> Column:
    """Content of the first ``tag``; NULL without one."""
    content = rf"(?si)\A{_before(_start(tag))}{_start(tag)}({_before(rf'</{tag}\s*>')})"
    return F.get(F.regexp_extract_all(html, F.lit(content), F.lit(1)), 0)


def elements(html: Column, tag: str) -> Column:
    """Contents of all ``tag`` elements; one that is not closed ends at the next."""
    end = rf"</{tag}\s*>|<{tag}[\s/>]"
    return F.regexp_extract_all(html, F.lit(rf"(?si)\G{_before(_start(tag))}{_start(tag)}({_before(end)})"), F.lit(1))


def _named(piece: Column) -> Column:
    """The text of a piece that followed ``&`` and starts with a letter."""
    bare = "^(" + "|".join(BARE) + ")"

    def listed(name):
        return F.concat(F.lit(_MARK), name, F.lit(_SAYS))

    def value(name):
        return F.call_function("substring_index", F.call_function("substring_index", F.lit(TABLE), listed(name), F.lit(-1)), F.lit(_MARK), F.lit(1))

    def of(name):
        rest = lambda used: F.substr(piece, F.char_length(used) + 1)
        short = F.regexp_extract(piece, bare, 1)
        return F.when((name != "") & F.contains(F.lit(TABLE), listed(name)), F.concat(value(name), rest(name))).when(
            short != "", F.concat(value(short), rest(short))).otherwise(F.concat(F.lit("&"), piece))

    return bind(F.regexp_extract(piece, "^[A-Za-z0-9]{1,32};?", 0), of)


def _numbered(piece: Column) -> Column:
    """The text of a piece that followed ``&`` and starts with ``#``."""
    number = r"^#([0-9]+|[xX][0-9a-fA-F]+);?"

    def of(digits):
        hexed = F.lower(F.substring(digits, 1, 1)) == "x"
        plain = F.regexp_replace(digits, "^[xX]?0*", "")
        code = F.when(F.char_length(plain) > 7, F.lit(0x110000)).when(hexed, F.conv(plain, 16, 10).cast("int")).otherwise(plain.cast("int"))
        code = F.when(plain == "", F.lit(0)).otherwise(code)

        def char(c):
            low = F.get(F.split(F.lit(_MARK.join(LOW)), _MARK), c)
            none = (c % 0x10000 >= 0xFFFE) | c.between(0xFDD0, 0xFDEF)
            return (F.when(c < 160, low).when((c > 0x10FFFF) | c.between(0xD800, 0xDFFF), F.lit("\ufffd")).when(none, F.lit(""))
                    .otherwise(F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32")))

        return F.when(digits == "", F.concat(F.lit("&"), piece)).otherwise(F.concat(bind(code, char), F.regexp_replace(piece, number, "")))

    return bind(F.regexp_extract(piece, number, 1), of)


def _reference(piece: Column) -> Column:
    out = F.when(piece.startswith("#"), _numbered(piece))
    for name, char in COMMON.items():
        out = out.when(piece.startswith(name), F.concat(F.lit(char), F.substr(piece, F.lit(len(name) + 1))))
    return out.otherwise(_named(piece))


def decode_references(text: Column) -> Column:
    def joined(pieces):
        return F.concat(F.element_at(pieces, 1), F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), _reference), ""))
    return F.when(text.contains("&"), bind(F.split(text, "&"), joined)).otherwise(text)


def visible_text(fragment: Column) -> Column:
    """``get_text()``: text nodes in order, references decoded."""
    return decode_references(F.regexp_replace(F.regexp_replace(fragment, TEMPLATE, ""), TAG, ""))


def stripped_text(fragment: Column) -> Column:
    """``get_text(strip=True)``: every text node stripped, empties dropped."""
    nodes = F.transform(F.split(F.regexp_replace(fragment, TEMPLATE, ""), TAG), lambda n: strip_ws(decode_references(n)))
    return F.array_join(nodes, "")


def without_silent(html: Column) -> Column:
    return F.regexp_replace(html, SILENT, "")


LINK = rf"(?si)\A{_before(_start('a'))}({_start('a')})"
HREF = r"""(?si)^<a(?:[\s/]+(?!href[\s=])[^\s=>/]+(?:\s*=\s*(?:"[^"]*+"|'[^']*+'|[^\s>"']*+))?)*+[\s/]+href\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))"""


def page_links(html: Column, cfg: S.Site) -> Column:
    """X1 for one list page: array of (card_no, href, failed), ending at the
    first failure; a page without the container is one failed row, number 0."""
    none = F.array(F.struct(F.lit(0).cast("bigint").alias("card_no"), F.lit(None).cast("string").alias("href"), F.lit(True).alias("failed")))

    def card(content, i):
        def of_link(link):
            href = F.when(link.rlike(HREF), decode_references(F.concat(*[F.regexp_extract(link, HREF, g) for g in (1, 2, 3)])))
            failed = (link == "") | (href.isNull() if cfg.link_prefix else F.lit(False))
            return F.struct((i + 1).cast("bigint").alias("card_no"), F.when(~failed, href).alias("href"), failed.alias("failed"))
        return bind(F.regexp_extract(content, LINK, 1), of_link)

    def until_failure(rows):
        first = F.array_position(F.transform(rows, lambda r: r["failed"]), True)
        return F.when(first > 0, F.slice(rows, 1, first.cast("int"))).otherwise(rows)

    def of_container(box):
        cards = F.transform(elements(box, cfg.card[0]), card)
        return F.when(box.isNull(), none).otherwise(bind(cards, until_failure))

    return bind(element(without_silent(html), cfg.container[0]), of_container)


def page_fields(html: Column, cfg: S.Site) -> dict[str, Column]:
    """X4-X7 for one article page, as the raw field texts."""
    clean = without_silent(html)

    def paragraphs(box):
        def joined(ps):
            return F.when(F.size(ps) > 0, F.array_join(F.transform(F.slice(ps, 1, F.size(ps) - 1), stripped_text), " "))
        return bind(elements(box, "p"), joined)

    return {"title_raw": visible_text(element(clean, cfg.title[0])),
            "date_text": strip_ws(visible_text(element(clean, cfg.date[0]))),
            "body_raw": bind(element(clean, cfg.body[0][0]), paragraphs),
            "type_raw": F.lit(None).cast("string")}
