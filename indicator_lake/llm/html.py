"""One forward pass over HTML: texts, tags and raw contents, in time that follows the length of the page.

Rules of the HTML syntax that decide where a tag ends: a quote opens a value only behind an equals sign, a value
without quotes runs to white space or ``>``, and a tag, comment or raw element that never ends reaches to the end of
the page. No place of the page is looked at again after a failed try, so broken markup costs no more than sound one.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from functools import cache

TEXT, START, END, RAW = "text", "start", "end", "raw"

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|(?=>)))*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/>][^\s=/>]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?")


@cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])", re.I)


def tokens(html: str, raw: Collection[str]) -> Iterator[tuple[str, str, str]]:
    """(kind, tag name in lower case, text) of a page, in order.

    The text of a start tag is its attributes; that of a raw element (one whose tag is in ``raw``, holding no markup)
    its whole content, and no end tag follows it. Character references are left as they are; comments, declarations and
    a tag cut off at the end give nothing. A ``<`` that opens no tag is text.
    """
    at, begin, size = 0, 0, len(html)
    while at < size:
        here = html.find("<", at)
        if here < 0 or here + 1 == size:
            break
        following = html[here + 1]
        if following in "!?":
            if begin < here:
                yield TEXT, "", html[begin:here]
            mark = "-->" if html.startswith("<!--", here) else ">"
            end = html.find(mark, here + 2)
            begin = at = size if end < 0 else end + len(mark)
            continue
        if not (following.isascii() and (following.isalpha() or (following == "/" and html[here + 2 : here + 3].isascii() and html[here + 2 : here + 3].isalpha()))):
            at = here + 1
            continue
        if begin < here:
            yield TEXT, "", html[begin:here]
        tag = _TAG.match(html, here)
        if tag is None:
            return
        begin = at = tag.end()
        name = tag[2].lower()
        if tag[1]:
            yield END, name, ""
        elif name in raw:
            end = _end_of(name).search(html, at)
            yield START, name, tag[3]
            yield RAW, name, html[at : end.start() if end else size]
            closing = _TAG.match(html, end.start()) if end else None
            if closing is None:
                return
            begin = at = closing.end()
        else:
            yield START, name, tag[3]
    # a single < at the very end is a tag cut off
    rest = html[begin : size - 1] if begin < size and html[-1] == "<" else html[begin:]
    if rest:
        yield TEXT, "", rest


def attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag by lower-case name, the first of a name; one without a value is empty."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found
