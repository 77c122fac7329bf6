"""Prepares raw HTML for ``html.parser`` so that its work stays linear.

The standard parser retries after every ``<`` that does not start a complete
tag, each time up to the end of the page. ``tidy`` leaves complete constructs
as they are, whatever the length of their quoted values, ends the page before a
construct that is cut off (as browsers do with a truncated tag or comment), and
turns every other ``<`` into ``&lt;``. The contents of script, style and the
like end at their end tag and hold no constructs; those of title and textarea
are text.
"""

from __future__ import annotations

import re

_CUT_OFF = re.compile(r"<[a-zA-Z/!?]")
_SHORT = re.compile(r"""</?[a-zA-Z](?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+')*+>""")
_START = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"<(script|style|xmp|iframe|noembed|noframes|title|textarea)(?=[\s/>])", re.I)
_PLAIN = re.compile(r"""[^<>"']*+""")
_COMMENT = re.compile(r"<!--(?:-?>|.*?--!?>)", re.S)
_TEXT = ("title", "textarea")


def _tag_end(html: str, at: int, failed: set[int]) -> int:
    """End of the tag that starts at ``at``; -1 if it is none. ``failed`` are the
    opening quotes from which no tag ends, so that none is followed twice."""
    passed, at = [], at + 1
    while True:
        at = _PLAIN.match(html, at).end()
        c = html[at:at + 1]
        if c == ">":
            return at + 1
        close = html.find(c, at + 1) if c in ('"', "'") and at not in failed else -1
        if close < 0:
            failed.update(passed)
            if c in ('"', "'"):
                failed.add(at)
            return -1
        passed.append(at)
        at = close + 1


def tidy(html: str) -> str:
    """No ``<`` of the result is part of an incomplete construct."""
    if m := _CUT_OFF.search(html, html.rfind(">") + 1):
        html = html[:m.start()]
    out, at, failed, unclosed = [], 0, set(), set()
    while (start := html.find("<", at)) >= 0:
        out.append(html[at:start])
        if not (m := _START.match(html, start)):
            end = -1
        elif html.startswith("<!--", start):
            m = _COMMENT.match(html, start)
            if not m:
                return "".join(out)
            out.append("<!-- -->")      # html.parser does not know all of a comment's ends
            at = m.end()
            continue
        elif m[0][1] in "!?":
            end = html.find(">", start) + 1 or -1
        else:
            m = _SHORT.match(html, start)
            end = m.end() if m else _tag_end(html, start, failed)
        if end < 0:
            out.append("&lt;")
            at = start + 1
            continue
        out.append(html[start:end])
        at = end
        if (m := _NAME.match(html, start)) and html[end - 2] != "/" and (name := m[1].lower()) not in unclosed:
            if close := re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, end):
                inner = html[end:close.start()]
                out.append(inner.replace("<", "&lt;") if name in _TEXT else inner)
                at = close.start()
            elif name in _TEXT:
                unclosed.add(name)
            else:
                break
    out.append(html[at:])
    return "".join(out)
